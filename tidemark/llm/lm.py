"""Perplexity by an interpolated modified Kneser-Ney bigram model in memory-mapped sorted arrays."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import blob, gathered, joined, mapped, put, shared_folder, summed
from tidemark.llm.bpe import slices

END = 0x454E44  # stands for the end of a text; words are their XXH64
BEGIN = (1 << 32) - 1  # the context of a text's first word
CACHE = 300_000  # distinct words whose numbers a worker remembers
FLUSH = 4_000_000  # tokens counted before they are dealt out
SHARD = 2_000_000  # training tokens for every shard of bigrams
WORDS = 1 << 20  # words of a shard of the word tables
MIX = np.uint64(0x9E3779B97F4A7C15)


def scattered(numbers: np.ndarray) -> np.ndarray:
    x = numbers.astype(np.uint64) * MIX
    return (x ^ (x >> np.uint64(29))) * MIX >> np.uint64(32)


class Words:
    """Texts as rows of a table of their distinct words, remembered across texts."""

    def __init__(self, describe: Callable[[np.ndarray], dict[str, np.ndarray]] | None = None):
        self.describe = describe
        self.clear()

    def clear(self) -> None:
        self.row: dict[bytes, int] = {}
        self.hash = np.zeros(0, np.uint64)
        self.facts: dict[str, np.ndarray] = {}
        self._add([], np.array([END], np.uint64))

    def _add(self, words: list[bytes], hashes: np.ndarray) -> None:
        self.row.update(zip(words, range(len(self.hash), len(self.hash) + len(words)), strict=True))
        self.hash = np.concatenate([self.hash, hashes])
        if self.describe:
            new = self.describe(hashes)
            self.facts = {k: np.concatenate([self.facts[k], v]) if self.facts else v for k, v in new.items()}

    def rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' words as rows one after another, each text ended by row 0, and their number."""
        if len(self.row) > CACHE:
            self.clear()
        split = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
        flat = [w for words in split for w in words]
        new = list(set(flat).difference(self.row))
        if new:
            digest = xxhash.xxh64_intdigest
            self._add(new, np.fromiter((digest(w) for w in new), np.uint64, len(new)))
        sizes = np.fromiter(map(len, split), np.int64, len(split)) + 1
        out = np.zeros(int(sizes.sum()), np.int64)
        inner = np.ones(len(out), bool)
        inner[np.cumsum(sizes) - 1] = False
        out[inner] = np.fromiter(map(self.row.__getitem__, flat), np.int64, len(flat))
        return out, sizes


class Vocabulary:
    """Words by sorted hash: their number (the place among all) and training count."""

    def __init__(self, folder: str, bits: int, sizes: list[int]):
        self.folder, self.bits = folder, bits
        self.base = np.concatenate([[0], np.cumsum(sizes)])
        self.total = int(self.base[-1])
        if self.total >= BEGIN:  # numbers are 32 bits of a bigram's key
            raise ValueError(f"{self.total} distinct words, at most {BEGIN - 1} can be numbered")
        self._open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, count), -1 and 0 for words that training lacks."""
        number, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        shard = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        order = np.argsort(hashes, kind="stable")
        ends = np.searchsorted(shard[order], np.arange((1 << self.bits) + 1))
        for s in np.flatnonzero(np.diff(ends)):
            if self.base[s] == self.base[s + 1]:
                continue
            if s not in self._open:
                self._open[s] = mapped(self.folder, f"words-{s}"), mapped(self.folder, f"counts-{s}")
            keys, counts = self._open[s]
            some = order[ends[s] : ends[s + 1]]
            at = np.minimum(np.searchsorted(keys, hashes[some]), len(keys) - 1)
            there = keys[at] == hashes[some]
            number[some[there]] = self.base[s] + at[there]
            count[some[there]] = counts[at[there]]
        return number, count


def shard_of(left: np.ndarray, right: np.ndarray, count: np.ndarray, tokens: int, shards: int) -> np.ndarray:
    """Where a bigram is kept: by its context, a frequent context over several shards by the word too."""
    parts = np.minimum(shards, 1 + 4 * shards * count // max(1, tokens)).astype(np.uint64)
    return ((scattered(left) + scattered(right) % parts) % np.uint64(shards)).astype(np.int64)


def contexts(numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What stands before each token: the token before it, BEGIN at a text's begin."""
    before = np.concatenate(([BEGIN], numbers[:-1]))
    before[np.cumsum(sizes) - sizes] = BEGIN
    return before


def count_words(texts: DataFrame, folder: str, bits: int) -> tuple[Vocabulary, int, int]:
    """The vocabulary of the training texts, and their tokens and texts."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size = Words(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, counts = summed(np.concatenate([h for h, _ in held]), np.concatenate([c for _, c in held]))
            shard = (keys >> np.uint64(64 - bits)).astype(np.int64)
            ends = np.searchsorted(shard, np.arange((1 << bits) + 1))
            some = np.flatnonzero(np.diff(ends))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([blob(keys[ends[s] : ends[s + 1]], "<u8") for s in some], pa.binary()), pa.array([blob(counts[ends[s] : ends[s + 1]], "<i8") for s in some], pa.binary())],
                names=["shard", "keys", "counts"],
            )

        for batch in batches:
            for some in slices([t.as_py() or "" for t in batch.column(0)], 1 << 22):
                rows, _ = words.rows(some)
                counts = np.bincount(rows, minlength=len(words.hash))
                seen = np.flatnonzero(counts)
                held.append((words.hash[seen], counts[seen]))
                size += len(seen)
                if size > FLUSH:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    def write(shard: int, blobs: list) -> Iterator[pa.RecordBatch]:
        keys, counts = summed(joined(blobs, "keys", "<u8"), joined(blobs, "counts", "<i8"))
        put(folder, f"words-{shard}", keys)
        put(folder, f"counts-{shard}", counts)
        ends = int(counts[keys == np.uint64(END)].sum())
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (shard, len(keys), int(counts.sum()), ends)], names=["shard", "n", "tokens", "ends"])

    dealt = texts.select("text").mapInArrow(deal, "shard int, keys binary, counts binary")
    found = gathered(dealt, 1 << bits, write, "shard long, n long, tokens long, ends long").collect()  # a row a shard
    sizes = [0] * (1 << bits)
    for r in found:
        sizes[r.shard] = r.n
    return Vocabulary(folder, bits, sizes), sum(r.tokens for r in found), sum(r.ends for r in found)


def discounts(n: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more from numbers of counts 1 to 4."""
    if n[0] == 0 or n[1] == 0:
        return np.array([0, 0.75, 0.75, 0.75])  # too few rows to estimate them
    y = n[0] / (n[0] + 2 * n[1])
    third = 3 - 4 * y * n[3] / n[2] if n[2] else 0.75
    return np.array([0, np.clip(1 - 2 * y * n[1] / n[0], 0.05, 1), np.clip(2 - 3 * y * n[2] / n[1], 0.05, 2), np.clip(third, 0.05, 3)])


def count_bigrams(texts: DataFrame, folder: str, words: Vocabulary, tokens: int, ends: int, shards: int) -> dict:
    """Write the bigrams' sorted keys and counts and the word tables; returns the totals."""
    vocabulary = (words.folder, words.bits, np.diff(words.base).tolist())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Vocabulary(*vocabulary)
        known = Words(lambda h: dict(zip(("number", "count"), book.find(h), strict=True)))
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            left, right = keys >> np.uint64(32), keys & np.uint64(BEGIN)
            # a context's training count, found once for each distinct one
            distinct, place = np.unique(left, return_inverse=True)
            shard = shard_of(left, right, counted(book, distinct, ends)[place], tokens, shards)
            order = np.argsort(shard, kind="stable")
            at = np.searchsorted(shard[order], np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(at)):
                some = order[at[s] : at[s + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int32()), pa.array([blob(np.diff(left[some], prepend=np.uint64(0)), "<u4")], pa.binary()), pa.array([blob(right[some], "<u4")], pa.binary()), pa.array([blob(counts[some], "<u4")], pa.binary())],
                    names=["shard", "left", "right", "counts"],
                )

        for batch in batches:
            for some in slices([t.as_py() or "" for t in batch.column(0)], 1 << 22):
                rows, sizes = known.rows(some)
                number = known.facts["number"][rows]
                held.append(contexts(number, sizes).astype(np.uint64) << np.uint64(32) | number.astype(np.uint64))
                size += len(rows)
                if size > FLUSH:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    kinds = ["shard", "kind", "ids", "a", "b", "c", "d"]
    schema = "shard int, kind int, ids binary, a binary, b binary, c binary, d binary"

    def write(shard: int, blobs: list) -> Iterator[pa.RecordBatch]:
        left = np.concatenate([np.cumsum(np.frombuffer(b["left"], "<u4").astype(np.uint64)) for b in blobs])
        keys, counts = summed(left << np.uint64(32) | joined(blobs, "right", "<u4").astype(np.uint64), joined(blobs, "counts", "<u4").astype(np.int64))
        put(folder, f"keys-{shard}", keys)
        put(folder, f"counts-{shard}", counts.astype(np.uint32) if not len(counts) or counts.max() < 1 << 32 else counts)
        left, right = keys >> np.uint64(32), keys & np.uint64(BEGIN)
        first = np.flatnonzero(np.concatenate(([True], left[1:] != left[:-1])))
        sums = [np.add.reduceat(x.astype(np.int64), first) for x in (counts, counts == 1, counts == 2, counts >= 3)]
        yield from table_rows(left[first], 0, sums)
        word, distinct = np.unique(right, return_counts=True)
        yield from table_rows(word, 1, [distinct, distinct * 0, distinct * 0, distinct * 0])
        yield one_row(-1, 2, [np.array([int((counts == k).sum())]) for k in (1, 2, 3, 4)], np.zeros(1))

    def table_rows(ids: np.ndarray, kind: int, values: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Blobs by shard of the word tables; the text's begin has shard -2."""
        part = np.where(ids == np.uint64(BEGIN), -2, (ids // np.uint64(WORDS)).astype(np.int64))
        at = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield one_row(int(part[a]), kind, [v[a:b] for v in values], ids[a:b])

    def one_row(shard: int, kind: int, values: list[np.ndarray], ids: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([kind], pa.int32()), pa.array([blob(ids, "<u4")], pa.binary()), *[pa.array([blob(v, "<i8" if shard < 0 else "<u4")], pa.binary()) for v in values]], names=kinds
        )

    def tables(shard: int, blobs: list) -> Iterator[pa.RecordBatch]:
        """Dense tables of a range of words: as contexts, and how many contexts they follow."""
        if shard < 0:
            rows = [np.array([np.frombuffer(b[k], "<i8").sum() for k in "abcd"]) for b in blobs]
            total = np.sum(rows, axis=0)
        else:
            size = min(WORDS, words.total - shard * WORDS)
            held = [np.zeros(size, np.int64) for _ in range(5)]
            for b in blobs:
                place = np.frombuffer(b["ids"], "<u4").astype(np.int64) - shard * WORDS
                for k, name in enumerate("abcd"):
                    if b["kind"] == 0 or k == 0:
                        held[4 if b["kind"] else k][place] += np.frombuffer(b[name], "<u4")
            for name, rows in zip(("total", "n1", "n2", "n3", "follows"), held, strict=True):
                put(folder, f"{name}-{shard}", rows)
            total = np.array([(held[4] == k).sum() for k in (1, 2, 3, 4)] + [(held[4] == 1).sum(), (held[4] == 2).sum(), (held[4] >= 3).sum(), held[4].sum()])
        total = np.resize(np.concatenate([total, np.zeros(8, np.int64)]), 8)
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["shard", "total"])

    dealt = texts.select("text").mapInArrow(deal, "shard int, left binary, right binary, counts binary")
    written = gathered(dealt, shards, write, schema)
    pieces = -(-words.total // WORDS) + 2
    found = {r.shard: np.array(r.total) for r in gathered(written, pieces, tables, "shard long, total array<long>").collect()}  # a row a shard
    over = sum((v for s, v in found.items() if s >= 0), np.zeros(8, np.int64))
    return {
        "pairs": discounts(found.get(-1, np.zeros(8)).tolist()),
        "singles": discounts(over[:4].tolist()),
        "begin": found.get(-2, np.zeros(8, np.int64))[:4],
        "kinds": over[4:7],
        "bigrams": int(over[7]),
    }


def counted(book: Vocabulary, numbers: np.ndarray, ends: int) -> np.ndarray:
    """Training counts by word number (sorted); the text's begin counts as often as its end."""
    out = np.full(len(numbers), ends, np.int64)
    for s in range(len(book.base) - 1):
        a, b = np.searchsorted(numbers, [book.base[s], book.base[s + 1]])
        if b > a:
            out[a:b] = mapped(book.folder, f"counts-{s}")[numbers[a:b].astype(np.int64) - book.base[s]]
    return out


class Model:
    """The model as its workers see it: small totals, and arrays that are mapped, not read."""

    def __init__(self, folder: str, vocabulary: tuple, tokens: int, ends: int, shards: int, totals: dict):
        self.folder, self.tokens, self.ends, self.shards, self.totals = folder, tokens, ends, shards, totals
        self.book = Vocabulary(*vocabulary)
        self._open: dict[tuple, np.ndarray] = {}
        single, kinds = totals["singles"], totals["kinds"]
        self.rest = float((single[1:] * kinds).sum() / totals["bigrams"]) if totals["bigrams"] else 1.0
        self.unseen = self.rest / (self.book.total + 1)
        self.words = Words(self.describe)

    def array(self, name: str, shard: int) -> np.ndarray:
        if (name, shard) not in self._open:
            self._open[name, shard] = mapped(self.folder, f"{name}-{shard}")
        return self._open[name, shard]

    def describe(self, hashes: np.ndarray) -> dict[str, np.ndarray]:
        """By word: number, training count, continuation probability, and as a context its total and back-off."""
        number, count = self.book.find(hashes)
        p, total, back = np.full(len(hashes), self.unseen), np.zeros(len(hashes)), np.ones(len(hashes))
        single, pair = self.totals["singles"], self.totals["pairs"]
        order = np.argsort(number, kind="stable")
        part = number[order] // WORDS
        at = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        for a, b in zip(at[:-1], at[1:], strict=True):
            if part[a] < 0:
                continue
            some = order[a:b]
            rows, shard = number[some] - part[a] * WORDS, int(part[a])
            follows = self.array("follows", shard)[rows]
            p[some] += np.maximum(follows - single[np.minimum(follows, 3)], 0) / max(1, self.totals["bigrams"])
            total[some] = self.array("total", shard)[rows]
            mass = sum(pair[k] * self.array(f"n{k}", shard)[rows] for k in (1, 2, 3))
            back[some] = np.where(total[some] > 0, mass / np.maximum(total[some], 1), 1.0)
        return {"number": number, "count": count, "p": p, "total": total, "back": back}

    def pair_counts(self, left: np.ndarray, right: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Training counts of bigrams of known words."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        keys, first, place = np.unique(keys, return_index=True, return_inverse=True)
        shard = shard_of(keys >> np.uint64(32), keys & np.uint64(BEGIN), count[first], self.tokens, self.shards)
        out = np.zeros(len(keys), np.int64)
        order = np.argsort(shard, kind="stable")
        at = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(at)):
            some = order[at[s] : at[s + 1]]
            if not os.path.exists(f"{self.folder}/keys-{s}.npy"):
                continue  # no bigram of training fell into this shard
            held = self.array("keys", int(s))
            where = np.minimum(np.searchsorted(held, keys[some]), len(held) - 1)
            there = held[where] == keys[some]
            out[some[there]] = self.array("counts", int(s))[where[there]]
        return out[place]

    def scores(self, texts: list[str]) -> dict[str, np.ndarray]:
        """Per text: tokens, known tokens, base score and model score (log10)."""
        rows, sizes = self.words.rows(texts)
        fact = {k: v[rows] for k, v in self.words.facts.items()}
        left = contexts(fact["number"], sizes)
        start = np.cumsum(sizes) - sizes
        begin = self.totals["begin"]
        shift = lambda name, at_begin: np.where(left == BEGIN, at_begin, np.concatenate(([0], fact[name][:-1])))
        total = shift("total", float(begin[0]))
        back = shift("back", float((self.totals["pairs"][1:] * begin[1:]).sum() / begin[0]) if begin[0] else 1.0)
        p = back * fact["p"]
        ask = np.flatnonzero((fact["number"] >= 0) & (left >= 0) & (total > 0))
        if len(ask):
            count = self.pair_counts(left[ask], fact["number"][ask], shift("count", self.ends)[ask])
            p[ask] += np.maximum(count - self.totals["pairs"][np.minimum(count, 3)], 0) / total[ask]
        base = np.log10((fact["count"] + 1) / (self.tokens + self.book.total + 1))
        return {
            "n_tokens": sizes,
            "n_known": np.add.reduceat((fact["count"] > 0).astype(np.int64), start),
            "base_score": np.add.reduceat(base, start),
            "score": np.add.reduceat(np.log10(p), start),
        }


def lm_scores(docs: DataFrame, learn: Column) -> DataFrame:
    """One row (doc_id, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs`` (doc_id, text).

    The model learns from the rows where ``learn`` is true. Tokens are the words between ASCII white
    space, A-Z lower-cased, and one end; null text is empty, and so is only its end. ``score`` is the
    log10 probability of a text by an interpolated modified Kneser-Ney bigram model over all
    training tokens, nothing pruned; ``base_score`` is that of add-one unigrams. Rows stay as they
    are, repeated or with a null id; without training rows every token has probability one.

    Counts are summed in each task, dealt by hash in sorted blobs and merged; a context that many
    tokens share is dealt by its followers too. The arrays lie in the shared folder, which has to
    be mounted, and workers map them.
    """
    texts = docs.where(F.coalesce(learn, F.lit(False))).select("text")
    folder = shared_folder(docs, "lm")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(1, (size >> 25).bit_length())
    words, tokens, ends = count_words(texts, f"{folder}/words", bits)
    shards = max(1, -(-tokens // SHARD))
    totals = count_bigrams(texts, f"{folder}/pairs", words, tokens, ends, shards)
    made = (f"{folder}/pairs", (words.folder, words.bits, np.diff(words.base).tolist()), tokens, ends, shards, totals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*made)
        for batch in batches:
            done = 0
            for some in slices([t.as_py() or "" for t in batch.column(1)], 1 << 22):
                found = model.scores(some)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(some)), pa.array(found["n_tokens"]), pa.array(found["n_known"]), pa.array(np.full(len(some), tokens)), pa.array(found["base_score"]), pa.array(found["score"])],
                    names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )
                done += len(some)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
