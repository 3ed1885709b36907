"""Operators on texts against brute force, with awkward rows among the documents."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import suffix_dedup
from tidemark.llm.bpe import WordBpe, bpe_round_trip
from tidemark.llm.lm import BEGIN, Vocabulary, lm_scores
from tidemark.llm.packing import best_fit, lower_bound, pack_documents
from tidemark.llm.simhash import simhash_groups
from tidemark.llm.suffix_dedup import Anchors, remove_repeats
from tidemark.llm.suffix_sort import repeated_starts, suffix_array

COPY = "the quick brown fox jumps over the lazy dog and runs away from the small grey cat by the old stone wall"
TEXTS = [
    (1, COPY),
    (2, COPY),
    (2, COPY),  # a repeated row
    (3, COPY.replace("grey", "gray")),
    (4, ""),
    (5, None),
    (6, " \t\n\x0b\x0c\r "),
    (None, "a text without an id, Straße ÀÉ 日本語 😀"),
    (7, "word"),
    (8, "two words"),
    (9, "x" * 5000),
    (10, "ab " * 3000),
    (11, COPY.upper() + "\n\n" + COPY),
    (12, "<|endoftext|> ΑΣ  double  space \u00a0 \u3000 it's <|startoftext|>"),
]
MORE = "doc_id long, text string, lang string, fp long, key string, shard int, score double, kept string, piece int"


@pytest.fixture(scope="module")
def docs(spark):
    """Columns that clash with names inside the operators stand beside the texts."""
    return spark.createDataFrame([(i, t, "en", 1, "k", 2, 0.5, "z", 3) for i, t in TEXTS], MORE).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], MORE)


def simple_fingerprint(text, width=3):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").encode().split()]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    bits = Counter(b for g in grams for b in range(64) if xxhash.xxh64_intdigest(g, 42) >> b & 1)
    return sum(1 << b for b, n in bits.items() if 2 * n > len(grams))


def test_simhash(docs):
    got = simhash_groups(docs).collect()
    prints = {i: simple_fingerprint(t) for i, t in TEXTS}
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(i), f"{prints[i]:016x}") for i, _ in TEXTS)
    ids = [i for i in prints if i is not None]
    link = {i: {j for j in ids if (prints[i] ^ prints[j]).bit_count() <= 2} for i in ids}
    for r in got:
        if r.doc_id is not None:
            seen, todo = {r.doc_id}, [r.doc_id]
            while todo:
                todo += (more := link[todo.pop()] - seen)
                seen |= more
            assert r.component_id == min(seen)


def test_simhash_chain(spark):
    """Links at two bits make one group of a chain, none at three bits."""
    from tidemark.llm.common import components
    from tidemark.llm.simhash import near_pairs

    fps = [0b0, 0b11, 0b1111, 0b111111, 0b111111 | 7 << 20, -1, (1 << 63) - 1]
    pairs = near_pairs(spark.createDataFrame([(x,) for x in fps], "fp long"))
    root = {r.node: r.root for r in components(pairs).collect()}
    assert len({root[x] for x in fps[:4]}) == 1 and fps[4] not in root
    assert root[-1] == root[(1 << 63) - 1] != root[0]


def test_components_of_a_long_path(spark):
    from tidemark.llm.common import components

    n = 300
    edges = spark.range(n).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    star = spark.range(1000, 1500).select(F.lit(2000).cast("long").alias("u"), F.col("id").alias("v"))
    got = {r.node: r.root for r in components(edges.union(star)).collect()}
    assert set(got.values()) == {0, 1000} and sum(v == 0 for v in got.values()) == n + 1
    assert components(edges.limit(0)).isEmpty()


def test_bpe_equals_the_library(docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = {(r.doc_id, bytes(r.ids), r.decoded) for r in bpe_round_trip(docs, path).collect()}
    for i, text in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (i, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)) in got


def test_bpe_word_sizes():
    """Side by side or alone, words of every size merge alike."""
    bpe = WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    words = ["in" * n + "the" * (n % 3) for n in range(1, 33)]
    symbols, sizes = bpe.symbols(words)
    tokens, number = bpe.merge(symbols, sizes)
    ends = np.cumsum(number)
    begin = np.cumsum(sizes) - sizes
    for k, (b, n) in enumerate(zip(begin, sizes, strict=True)):
        alone = bpe._merge_long(symbols[b : b + n])
        assert tokens[ends[k] - number[k] : ends[k]].tolist() == alone[alone >= 0].tolist()


def test_packing(docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    for capacity in (7, 64, 1024):
        rows = pack_documents(docs, path, 2, capacity).collect()
        want = Counter()
        for i, text in TEXTS:
            ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
            first = len(ids) % capacity or capacity
            cuts = [0, *range(first, len(ids), capacity), len(ids)]
            want.update((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
        bins = defaultdict(list)
        for r in rows:
            bins[r.sequence_id].append((r.offset, r.length))
        for pieces in bins.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= capacity
        assert lower_bound(np.array([r.length for r in rows]), capacity) <= len(bins) <= sum(r.length for r in rows) / capacity * 1.1 + 2


def test_lower_bound_never_exceeds_a_packing():
    rng = np.random.default_rng(0)
    for _ in range(60):
        capacity = int(rng.integers(5, 60))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(0, 40)))
        bins, offsets, fill = best_fit(lengths, capacity)
        assert lower_bound(lengths, capacity) <= len(fill)
        assert not len(lengths) or (fill.max() <= capacity and fill.sum() == lengths.sum())
    assert lower_bound(np.array([6, 6, 6]), 10) == 3  # above half: one each


def test_exchange_keeps_every_piece(docs):
    from tidemark.llm.packing import pack, token_pieces

    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = token_pieces(docs, path, 2, 64).drop("ids")
    rows = pack(pieces, 64, group=4).collect()
    assert len(rows) == pieces.count()
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 64


def brute_spans(texts, width):
    seen = Counter(t[p : p + width] for t in texts for p in range(len(t) - width + 1))
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - width + 1):
            if seen[t[p : p + width]] > 1:
                gone[p : p + width] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone[:-1].astype(int), [0]))))
        yield list(zip(edge[::2].tolist(), edge[1::2].tolist())), bytes(np.frombuffer(t, np.uint8)[~gone[: len(t)]])


@pytest.mark.parametrize("part", [1 << 19, 2000, 1])
def test_repeats(docs, monkeypatch, part):
    monkeypatch.setattr(suffix_dedup, "PART", part)
    raw = [(t or "").encode() for _, t in TEXTS]
    for width in (400, 40):
        want = Counter((i, len(t), tuple(s), k) for (i, _), t, (s, k) in zip(TEXTS, raw, brute_spans(raw, width), strict=True))
        rows = remove_repeats(docs, width).collect()
        assert Counter((r.doc_id, r.n_bytes, tuple((s["first"], s["last"]) for s in r.spans), bytes(r.kept)) for r in rows) == want


@pytest.mark.parametrize("part", [1 << 19, 3000, 1])
def test_repeats_of_a_hot_passage(spark, monkeypatch, part):
    """One passage in different surroundings, in periodic text and cut at its edges; every bound gives the same spans."""
    monkeypatch.setattr(suffix_dedup, "PART", part)
    rng = np.random.default_rng(3)
    noise = lambda n: bytes(rng.integers(97, 123, n).tolist()).decode()
    passage = " ".join(noise(int(n)) for n in rng.integers(1, 9, 40))
    texts = [noise(rng.integers(0, 60)) + passage[rng.integers(0, 3) :][: 150 - k % 9] + noise(rng.integers(0, 60)) for k in range(60)]
    texts += ["ab" * 150 + passage[:80], "ab" * 149 + "b" + passage, passage * 2, "a" * 300, "a" * 301 + "b"]
    raw = [t.encode() for t in texts]
    want = {i: (s, k) for i, (s, k) in enumerate(brute_spans(raw, 60))}
    rows = remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5), 60).collect()
    assert {r.doc_id: ([(s["first"], s["last"]) for s in r.spans], bytes(r.kept)) for r in rows} == want


def test_no_sort_exceeds_its_part(spark, monkeypatch):
    """Whatever share of the rows holds a passage, what one key gathers stays within the bound."""
    monkeypatch.setattr(suffix_dedup, "PART", 20_000)
    cut, sizes = suffix_dedup.repeated, []

    def seen(strings, *rest):
        sizes.append(strings.groupBy("key").agg(F.sum(F.length("text")).alias("b")).agg(F.max("b")).first()[0])
        return cut(strings, *rest)

    monkeypatch.setattr(suffix_dedup, "repeated", seen)
    rng = np.random.default_rng(4)
    noise = lambda: bytes(rng.integers(97, 123, 500).tolist()).decode()
    passage = noise()
    texts = [noise() + passage + noise() for _ in range(300)]
    remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5), 400).collect()
    assert sizes[0] > 20_000 >= sizes[-1]


def test_suffix_array_by_groups():
    rng = np.random.default_rng(1)
    for _ in range(400):
        text = [*rng.integers(1, rng.integers(2, 6), rng.integers(0, 40)).tolist(), 0]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_repeated_starts():
    rng = np.random.default_rng(2)
    for _ in range(300):
        letters = [b"ab", b"ab \n", b"abcdefg ", b"\x00\xff a"][rng.integers(4)]
        width = int(rng.integers(3, 12))
        base = bytes(rng.choice(list(letters), 30).tolist())
        strings = [base[rng.integers(10) :][: rng.integers(15, 30)].ljust(width, b"a") for _ in range(rng.integers(1, 5))]
        owned = [int(rng.integers(1, len(s) - width + 2)) for s in strings]
        seen = Counter(s[p : p + width] for s, n in zip(strings, owned, strict=True) for p in range(n))
        want = [[p for p in range(n) if seen[s[p : p + width]] > 1] for s, n in zip(strings, owned, strict=True)]
        assert [x.tolist() for x in repeated_starts(strings, owned, width)] == want


def test_anchor_strings_cover_all_starts():
    rng = np.random.default_rng(3)
    text = bytes(rng.integers(97, 100, (1 << 17) + 5000).astype(np.uint8))
    anchors = Anchors(400)
    covered = np.zeros(len(text) - 399, int)
    for base, raw in anchors.chunks(text):
        _, start, number = anchors.strings(raw)
        for a, n in zip(start, number, strict=True):
            covered[base + a : base + a + n] += 1
    assert (covered == 1).all()


def test_language_model(docs):
    learn = F.col("doc_id") != 3
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in TEXTS]
    train = [t for (i, _), t in zip(TEXTS, tokens, strict=True) if i is not None and i != 3]
    count = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["begin", *t], t))
    n, v = sum(count.values()), len(count)

    def discount(counts):
        m = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        if not m[0] or not m[1]:
            return [0, 0.75, 0.75, 0.75]
        y = m[0] / (m[0] + 2 * m[1])
        clip = lambda x, most: min(max(x, 0.05), most)
        return [0, clip(1 - 2 * y * m[1] / m[0], 1), clip(2 - 3 * y * m[2] / m[1], 2), clip(3 - 4 * y * m[3] / m[2], 3) if m[2] else 0.75]

    follows = Counter(w for _, w in pairs)
    one, two = discount(follows.values()), discount(pairs.values())
    rest = sum(one[min(c, 3)] for c in follows.values()) / len(pairs)
    total, mass = Counter(), Counter()
    for (a, _), c in pairs.items():
        total[a] += c
        mass[a] += two[min(c, 3)]

    def p(a, w):
        low = max(follows[w] - one[min(follows[w], 3)], 0) / len(pairs) + rest / (v + 1)
        if not total[a]:
            return low
        return max(pairs[a, w] - two[min(pairs[a, w], 3)], 0) / total[a] + mass[a] / total[a] * low

    got = {r.doc_id: r for r in lm_scores(docs, learn).collect()}
    assert sum(p("begin", w) for w in count) + mass["begin"] / total["begin"] * rest / (v + 1) == pytest.approx(1)
    for (i, _), t in zip(TEXTS, tokens, strict=True):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in count for w in t), n)
        assert r.score == pytest.approx(sum(math.log10(p(a, w)) for a, w in zip(["begin", *t], t)))
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t))


def test_language_model_without_training(docs):
    assert {(r.train_tokens, r.score, r.base_score) for r in lm_scores(docs, F.lit(False)).collect()} == {(0, 0.0, 0.0)}


def test_empty_tables(nothing):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert simhash_groups(nothing).isEmpty()
    assert bpe_round_trip(nothing, public_tokenizers.path("word_bpe_49k.json")).isEmpty()
    assert pack_documents(nothing, path).isEmpty()
    assert remove_repeats(nothing).isEmpty()
    assert lm_scores(nothing, F.lit(True)).isEmpty()


def test_digests_of_the_queries(docs):
    assert hashlib.sha256(b"").hexdigest() == docs.select(F.sha2(F.lit(b""), 256)).first()[0]


def test_more_words_than_numbers():
    """Word numbers fill 32 bits of a key, of which the last stands for a text's begin."""
    assert Vocabulary("", 1, [BEGIN - 2, 1]).total == BEGIN - 1
    with pytest.raises(ValueError, match="distinct words"):
        Vocabulary("", 1, [BEGIN - 1, 1])
