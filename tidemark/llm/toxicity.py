"""Toxicity by a bidirectional gated recurrent network with attention pooling over text windows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import slices
from tidemark.llm.calibration import fit_logistic, logistic
from tidemark.llm.common import beside_text, labelled_sample, stored

WINDOW, STRIDE = 16, 8  # words of a window; neighbours overlap by half
DOCUMENTS = 1_500  # labelled documents of a class, at most about; three quarters to train on, the rest for calibration
WORDS, PREFIXES, TRIGRAMS = 4_096, 2_048, 4_096  # rows of the word, prefix and character tables
PREFIX = 5  # letters
PER_DOCUMENT = 4  # windows of a document that are trained on at once
DIM, HIDDEN = 8, 8
CACHE = 200_000  # distinct words whose network inputs a worker remembers
_EDGES = re.compile(rb"^[^0-9a-z\x80-\xff]+|[^0-9a-z\x80-\xff]+$")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words between ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def bare(word: bytes) -> bytes:
    """The word without punctuation around it; a word of nothing else stays."""
    return _EDGES.sub(b"", word) or word


class Lexicon:
    """What of a word the network sees: the word, its beginning, its hashed three-letter runs."""

    def __init__(self, odds: dict[bytes, float]):
        ranked = sorted(odds, key=lambda w: (-abs(odds[w]), w))
        self.word = {w: i + 1 for i, w in enumerate([w for w in ranked if not w.startswith(b"^")][: WORDS - 1])}
        self.prefix = {w[1:]: i + 1 for i, w in enumerate([w for w in ranked if w.startswith(b"^")][: PREFIXES - 1])}
        self.odds = odds

    def parts(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the word and prefix tables (0: none), and all words' trigrams with their number."""
        plain = [bare(w) for w in words]
        word = np.array([self.word.get(w, 0) for w in plain], np.int64)
        prefix = np.array([self.prefix.get(w[:PREFIX], 0) for w in plain], np.int64)
        raw = np.frombuffer(b"".join(b"^" + w + b"$" for w in plain), np.uint8).astype(np.int64)
        sizes = np.fromiter(map(len, plain), np.int64, len(plain))
        hashes = (raw[:-2] * 961 + raw[1:-1] * 31 + raw[2:]) * 2_654_435_761 % 4_294_967_291 % TRIGRAMS
        starts = np.cumsum(sizes + 2) - (sizes + 2)
        inside = np.ones(len(raw), bool)
        inside[starts[1:] - 1] = inside[starts[1:] - 2] = inside[-2:] = False
        return word, prefix, hashes[inside[: len(hashes)]], sizes


class Network:
    """Parameters as named arrays; forward over windows and the gradients of the logistic loss."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        inputs = 3 * DIM
        self.p = {
            "word": draw(WORDS, DIM), "prefix": draw(PREFIXES, DIM), "char": draw(TRIGRAMS, DIM),
            "wf": draw(inputs, 3 * HIDDEN), "wb": draw(inputs, 3 * HIDDEN), "uf": draw(HIDDEN, 3 * HIDDEN), "ub": draw(HIDDEN, 3 * HIDDEN),
            "bf": np.zeros(3 * HIDDEN, np.float32), "bb": np.zeros(3 * HIDDEN, np.float32),
            "wa": draw(2 * HIDDEN, HIDDEN), "va": draw(HIDDEN), "out": draw(2 * HIDDEN), "bias": np.zeros(1, np.float32),
        }
        self.p["word"][0] = self.p["prefix"][0] = 0

    def vectors(self, word: np.ndarray, prefix: np.ndarray, grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Inputs of words: word, prefix and the mean of the trigram vectors."""
        starts = np.cumsum(sizes) - sizes
        chars = np.add.reduceat(self.p["char"][grams], starts, axis=0) / sizes[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][word], self.p["prefix"][prefix], chars], axis=1)

    def projected(self, x: np.ndarray) -> np.ndarray:
        """What the words add to the gates of both directions."""
        return np.concatenate([x @ self.p["wf"] + self.p["bf"], x @ self.p["wb"] + self.p["bb"]], axis=1)

    def pass_over(self, gates: np.ndarray, index: np.ndarray, mask: np.ndarray, u: np.ndarray, backward: bool, keep: list | None = None) -> np.ndarray:
        """Hidden states (steps, windows, HIDDEN) of one direction; where the mask is 0 a state stays."""
        steps, n = index.shape
        h = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((steps, n, HIDDEN), np.float32)
        full = bool(mask.all())
        for t in range(steps - 1, -1, -1) if backward else range(steps):
            x = gates[index[t]]
            hu = h @ u
            zr = 1 / (1 + np.exp(-(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])))
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(x[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            new = c + z * (h - c)
            if not full:
                new = np.where(mask[t][:, None], new, h)
            if keep is not None:
                keep.append((t, h, hu, z, r, c))
            h = out[t] = new
        return out

    def logits(self, gates: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window; ``gates`` are words' projections, ``index`` (steps, windows) their rows."""
        half = 3 * HIDDEN
        kept: list[list | None] = [None, None] if keep is None else [[], []]
        states = np.concatenate([
            self.pass_over(gates[:, :half], index, mask, self.p["uf"], False, kept[0]),
            self.pass_over(gates[:, half:], index, mask, self.p["ub"], True, kept[1]),
        ], axis=2)
        hidden = np.tanh(states @ self.p["wa"])
        weight = hidden @ self.p["va"]
        weight = np.where(mask, weight, -1e9)
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        score = states @ self.p["out"]
        if keep is not None:
            keep |= {"kept": kept, "states": states, "hidden": hidden, "weight": weight, "score": score}
        return (weight * score).sum(0) + self.p["bias"]

    def gradients(self, parts: tuple, index: np.ndarray, mask: np.ndarray, label: np.ndarray, importance: np.ndarray) -> tuple[float, dict]:
        """Loss and gradient over windows of the words given by ``parts``."""
        p, half = self.p, 3 * HIDDEN
        word, prefix, grams, sizes = parts
        x = self.vectors(word, prefix, grams, sizes)
        kept: dict = {}
        logit = self.logits(self.projected(x), index, mask, kept)
        prob = 1 / (1 + np.exp(-logit))
        total = importance.sum()
        loss = float((importance * (np.logaddexp(0, logit) - label * logit)).sum() / total)
        d = (importance * (prob - label) / total).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["bias"][0] = d.sum()
        states, hidden, weight, score = (kept[k] for k in ("states", "hidden", "weight", "score"))
        g["out"] = np.einsum("tn,tnh->h", weight * d, states)
        dstates = (weight * d)[:, :, None] * p["out"]
        dweight = weight * (score - (weight * score).sum(0)) * d
        g["va"] = np.einsum("tn,tnh->h", dweight, hidden)
        dhidden = dweight[:, :, None] * p["va"] * (1 - hidden * hidden)
        g["wa"] = np.einsum("tnh,tnk->hk", states, dhidden)
        dstates = dstates + dhidden @ p["wa"].T
        dx = np.zeros_like(x)
        for side, (w, u, b) in enumerate((("wf", "uf", "bf"), ("wb", "ub", "bb"))):
            dgates = np.zeros((len(x), half), np.float32)
            dh = np.zeros((index.shape[1], HIDDEN), np.float32)
            for t, h, hu, z, r, c in reversed(kept["kept"][side]):
                dh = dh + dstates[t][:, side * HIDDEN : (side + 1) * HIDDEN]
                on = mask[t][:, None]
                dnew = np.where(on, dh, 0)
                dc = dnew * (1 - z) * (1 - c * c)
                dz = dnew * (h - c) * z * (1 - z)
                dr = dc * hu[:, 2 * HIDDEN :] * r * (1 - r)
                pre = np.concatenate([dz, dr, dc], axis=1)
                np.add.at(dgates, index[t], pre)
                dhu = np.concatenate([dz, dr, dc * r], axis=1)
                g[u] += h.T @ dhu
                dh = np.where(on, dnew * z, dh) + dhu @ p[u].T
            g[b] = dgates.sum(0)
            g[w] = x.T @ dgates
            dx += dgates @ p[w].T
        np.add.at(g["word"], word, dx[:, :DIM])
        np.add.at(g["prefix"], prefix, dx[:, DIM : 2 * DIM])
        np.add.at(g["char"], grams, np.repeat(dx[:, 2 * DIM :] / sizes[:, None].astype(np.float32), sizes, axis=0))
        g["word"][0] = g["prefix"][0] = 0
        return loss, g


def train(net: Network, lexicon: Lexicon, windows: list[list[bytes]], label: np.ndarray, epochs: int, seed: int) -> None:
    """Adam over shuffled windows, classes balanced; words are looked up once a batch."""
    rng = np.random.default_rng(seed)
    share = np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, (1 - label).sum())) * len(label)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), 256):
            some = order[at : at + 256]
            index, mask, distinct = indexed([windows[i] for i in some])
            _, grad = net.gradients(lexicon.parts(distinct), index, mask, label[some].astype(np.float32), share[some].astype(np.float32))
            step += 1
            rate = 0.02 if epoch < epochs - 2 else 0.005
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net.p[k] -= (rate * (first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6) + 1e-4 * net.p[k])).astype(np.float32)


def indexed(windows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(index, mask, words): windows as rows into their distinct words, padded to one length."""
    place: dict[bytes, int] = {}
    index = np.zeros((WINDOW, len(windows)), np.int64)
    mask = np.zeros((WINDOW, len(windows)), bool)
    for i, window in enumerate(windows):
        for t, word in enumerate(window):
            index[t, i] = place.setdefault(word, len(place))
        mask[: len(window), i] = True
    return index, mask, list(place)


def spans(n: int) -> list[tuple[int, int]]:
    """All overlapping windows of ``n`` words; the last one ends with the text."""
    if n <= WINDOW:
        return [(0, n)] if n else []
    starts = list(range(0, n - WINDOW + 1, STRIDE))
    if starts[-1] != n - WINDOW:
        starts.append(n - WINDOW)
    return [(a, a + WINDOW) for a in starts]


class Scorer:
    """Logits of all windows of texts, words' projections remembered."""

    def __init__(self, net: Network, lexicon: Lexicon):
        self.net, self.lexicon = net, lexicon
        self.clear()

    def clear(self) -> None:
        self.row: dict[bytes, int] = {}
        self.gates = np.zeros((0, 6 * HIDDEN), np.float32)

    def windows(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of all windows one after another, and their number by text."""
        if len(self.row) > CACHE:
            self.clear()
        flat = [w for words in texts for w in words]
        new = list(set(flat).difference(self.row))
        if new:
            self.row.update(zip(new, range(len(self.row), len(self.row) + len(new)), strict=True))
            self.gates = np.concatenate([self.gates, self.net.projected(self.net.vectors(*self.lexicon.parts(new)))])
        rows = np.fromiter(map(self.row.__getitem__, flat), np.int64, len(flat))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(sizes) - sizes
        number = np.where(sizes > WINDOW, -(-(sizes - WINDOW) // STRIDE) + 1, (sizes > 0).astype(np.int64))
        of = np.repeat(np.arange(len(texts)), number)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
        start = begin[of] + np.minimum(nth * STRIDE, np.maximum(sizes[of] - WINDOW, 0))
        length = np.minimum(sizes[of], WINDOW)
        out = np.empty(len(of), np.float32)
        step = np.arange(WINDOW)[:, None]
        for at in range(0, len(of), 8_192):
            part = slice(at, at + 8_192)
            mask = step < length[None, part]
            out[part] = self.net.logits(self.gates, rows[np.minimum(start[None, part] + step, len(rows) - 1)], mask)
        return out, number

    def features(self, texts: list[list[bytes]]) -> np.ndarray:
        """(highest logit, log of the number of windows, mean of the logits above zero) by text."""
        logit, number = self.windows(texts)
        out = np.zeros((len(texts), 3))
        has = number > 0
        if has.any():
            starts = (np.cumsum(number) - number)[has]
            out[has, 0] = np.maximum.reduceat(logit, starts)
            out[has, 2] = np.log1p(np.add.reduceat((logit > 0).astype(np.float64), starts))
        out[:, 1] = np.log1p(number)
        out[~has, 0] = -20.0
        return out


def word_odds(sample: DataFrame) -> dict[bytes, float]:
    """Log-odds of words and word beginnings by the share of documents of either class that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, labels = [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                plain = {bare(w) for w in set(words_of(text))}
                some = plain | {b"^" + w[:PREFIX] for w in plain}
                keys += some
                labels += [label] * len(some)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(labels, pa.int32())], names=["key", "label"])

    total = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    n1, n0 = total.get(1, 0), total.get(0, 0)
    seen = sample.select("label", "text").mapInArrow(run, "key binary, label int").groupBy("key").agg(F.sum("label").alias("a"), F.count_if(F.col("label") == 0).alias("b"))
    odds = F.ln((F.col("a") + 0.5) / (n1 + 1)) - F.ln((F.col("b") + 0.5) / (n0 + 1))
    kind = F.col("key").substr(1, 1) == F.lit("^").cast("binary")
    rows = []
    for is_prefix, most in ((False, WORDS), (True, PREFIXES)):
        of = seen.where((kind if is_prefix else ~kind) & (F.col("a") + F.col("b") >= 2)).select("key", odds.alias("odds"))
        rows += of.orderBy(F.desc(F.abs("odds")), "key").limit(most - 1).collect()
    return {bytes(r.key): r.odds for r in rows}


def chosen_windows(sample: DataFrame, pick) -> list:
    """(label, window) rows: of each document the windows whose numbers ``pick`` returns, few of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        choose = pick()
        for batch in batches:
            labels, found = [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                places = spans(len(words))
                for i in choose(label, words, places)[:PER_DOCUMENT] if places else []:
                    labels.append(label)
                    found.append(b" ".join(words[slice(*places[i])]))
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(found, pa.binary())], names=["label", "window"])

    return sample.select("label", "text").mapInArrow(run, "label int, window binary").collect()


def fit(sample: DataFrame) -> tuple[Network, Lexicon]:
    """A network trained on windows of labelled documents (label, text).

    A toxic document need not be toxic in every window. First its window with the highest sum of
    word odds stands for it, against spread windows of clean documents; then windows are chosen
    anew by the network itself, the highest of either class, and trained on.
    """
    odds = word_odds(sample)
    lexicon = Lexicon(odds)
    net = Network()
    for table, place, mark in (("word", lexicon.word, b""), ("prefix", lexicon.prefix, b"^")):
        for w, i in place.items():
            net.p[table][i, 0] = odds[mark + w] / 3

    def by_odds():
        def choose(label, words, places):
            value = np.array([odds.get(w, 0.0) + odds.get(b"^" + w[:PREFIX], 0.0) for w in map(bare, words)])
            sums = np.concatenate([[0], np.cumsum(value)])
            scores = [sums[b] - sums[a] for a, b in places]
            top = int(np.argmax(scores))
            return [top] if label else [top, *np.linspace(0, len(places) - 1, PER_DOCUMENT - 1).astype(int).tolist()]

        return choose

    def by_net():
        scorer = Scorer(net, lexicon)

        def choose(label, words, places):
            logit, _ = scorer.windows([words])
            order = np.argsort(-logit, kind="stable").tolist()
            return order[:1] if label else [*order[:2], *np.linspace(0, len(places) - 1, 2).astype(int).tolist()]

        return choose

    for turn, pick in enumerate((by_odds, by_net)):
        rows = sorted((r.label, bytes(r.window)) for r in chosen_windows(sample, pick))
        label = np.array([r[0] for r in rows])
        train(net, lexicon, [r[1].split() for r in rows], label, 8, turn)
    return net, lexicon


def toxicity_scores(docs: DataFrame, labels: DataFrame, columns: tuple[str, ...] = ("doc_id",), null_unfitted: bool = False) -> DataFrame:
    """``columns`` and score per row of ``docs`` (doc_id, text): how likely its label is 1.

    ``labels`` (doc_id, label) are the rows to learn from, 0 or 1; others and nulls are ignored, a
    document labelled both ways counts as 0. At most about ``DOCUMENTS`` of a class are used, by a
    hash of doc_id: three quarters train the network, the rest calibrates a logistic regression over a document's
    highest logit, weighted to the classes' shares of all labels. Every overlapping window of every
    whole text is scored; a text without words gets score 0. Rows stay as they are, repeated or
    with a null id. If no model can be fitted because a part of the sample lacks a class, every
    score is the share of label 1 among the labels, 0.5 without any, or null with ``null_unfitted``.
    """
    sample, share = labelled_sample(docs, labels, DOCUMENTS)
    sample = stored(sample, "labelled")
    learn = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)) > 0
    model = None
    if sample.where(learn).select("label").distinct().count() == 2 and sample.where(~learn).select("label").distinct().count() == 2:
        net, lexicon = fit(sample.where(learn))

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(net, lexicon)
            for batch in batches:
                x = scorer.features([words_of(t.as_py()) for t in batch.column(1)])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["label", "x"])

        rows = sample.where(~learn).select("label", "text").mapInArrow(measure, "label int, x array<double>").collect()
        y = np.array([r.label for r in rows], float)
        weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
        model = fit_logistic(np.array([r.x for r in rows]), y, weight)

    frame, place, schema = beside_text(docs, columns, "score double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net, lexicon) if model else None
        for batch in batches:
            done = 0
            for some in slices([t.as_py() or "" for t in batch.column(place)]):
                if model:
                    words = [words_of(t) for t in some]
                    found = np.where([bool(w) for w in words], logistic(model, scorer.features(words)), 0.0)
                else:
                    found = [None if null_unfitted else share] * len(some)
                kept = [c.slice(done, len(some)) for c in batch.columns[: len(columns)]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.float64())], names=[*columns, "score"])
                done += len(some)

    return frame.mapInArrow(score, schema)
