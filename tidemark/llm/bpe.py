"""Byte-pair encoding and decoding, merges found by a segment tree over adjacent pair ranks."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

NONE = np.int64(1) << 62  # a pair that does not merge
POSITION = 16  # low bits of a tree key hold the pair's position
LOCKSTEP = 64  # words of at most so many symbols are merged side by side
CACHE = 400_000  # distinct pieces of text whose tokens a worker remembers
SLICE = 1 << 20  # characters of text worked on at once

# Fixed value: Unicode's White_Space, which the vocabulary's patterns call \s.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_ODD = re.compile("[\\x1c-\\x1f]")  # space for str.split, not for the patterns
_SPACES = re.compile(f"[{SPACE}]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the rest from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordBpe:
    """Lower-casing byte-pair encoder with word ends, from a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        self.rank_of = dict(zip(keys.tolist(), range(len(pairs)), strict=True))
        letters = byte_letters()
        self.inner = np.array([vocab.get(c, -1) for c in letters], np.int64)
        self.last = np.array([vocab.get(c + self.end, -1) for c in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", SPACE))
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}

    # -- one word: symbols to tokens ------------------------------------------------

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words' bytes, each word's last one with the word's end, and their number by word.

        Bytes that the vocabulary lacks are dropped. No word is empty.
        """
        coded = [w.encode("utf-8", "surrogatepass") for w in words]
        raw = np.frombuffer(b"".join(coded), np.uint8)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        ends = np.cumsum(sizes) - 1
        found = self.inner[raw]
        found[ends] = self.last[raw[ends]]
        if len(found) and found.min() < 0:
            sizes = np.add.reduceat(found >= 0, ends - sizes + 1, dtype=np.int64)
            found = found[found >= 0]
        return found, sizes

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the words, whose symbols stand one after another, and their number by word.

        Every word is merged leftmost lowest rank first until no pair merges.
        """
        ends = np.cumsum(sizes)
        starts = ends - sizes
        out = symbols.copy()
        for i in np.flatnonzero(sizes > LOCKSTEP):
            out[starts[i] : ends[i]] = self._merge_long(symbols[starts[i] : ends[i]])
        low, width = 2, 4
        while low <= LOCKSTEP:
            some = np.flatnonzero((sizes >= low) & (sizes <= min(width, LOCKSTEP)))
            for at in range(0, len(some), 20_000):
                part = some[at : at + 20_000]
                held = np.arange(width) < sizes[part, None]
                places = (starts[part, None] + np.arange(width))[held]
                out[places] = self._merge_side_by_side(symbols[places], sizes[part], held, width)
            low, width = width + 1, width * 2
        before = np.concatenate(([0], np.cumsum(out >= 0)))
        return out[out >= 0], before[ends] - before[starts]

    def _merge_side_by_side(self, symbols: np.ndarray, sizes: np.ndarray, held: np.ndarray, width: int) -> np.ndarray:
        """Words of at most ``width`` symbols, a segment tree each, one merge of every word at a time.

        Returns the symbols' places with the tokens that begin there, -1 elsewhere.
        """
        n = len(sizes)
        symbol = np.full((n, width), -1, np.int64)
        symbol[held] = symbols
        after = np.broadcast_to(np.arange(1, width + 1), (n, width)).copy()
        after[np.arange(n), sizes - 1] = width
        before = np.broadcast_to(np.arange(-1, width - 1), (n, width)).copy()
        tree = np.full((n, 2 * width), NONE, np.int64)
        has = (np.arange(width - 1) + 1) < sizes[:, None]
        rank = self.rank(symbol[:, :-1], symbol[:, 1:])
        leaves = np.where(has & (rank < NONE), rank << POSITION | np.arange(width - 1), NONE)
        tree[:, width : 2 * width - 1] = leaves
        level = width
        while level > 1:
            level //= 2
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            root = tree[rows, 1]
            at = root & ((1 << POSITION) - 1)
            gone = after[rows, at]
            then = after[rows, gone]
            symbol[rows, at] = made = self.made[root >> POSITION]
            symbol[rows, gone] = -1
            after[rows, at] = then
            more = then < width
            before[rows[more], then[more]] = at[more]
            self._set(tree, width, rows, gone, None)
            key = np.full(len(rows), NONE)
            key[more] = self.rank(made[more], symbol[rows[more], then[more]])
            self._set(tree, width, rows, at, key)
            prior = before[rows, at]
            some = prior >= 0
            self._set(tree, width, rows[some], prior[some], self.rank(symbol[rows[some], prior[some]], made[some]))
            rows = rows[tree[rows, 1] < NONE]
        return symbol[held]

    @staticmethod
    def _set(tree: np.ndarray, width: int, rows: np.ndarray, at: np.ndarray, rank: np.ndarray | None) -> None:
        """New ranks of the pairs that begin ``at``, carried up to the roots."""
        node = at + width
        tree[rows, node] = NONE if rank is None else np.where(rank < NONE, rank << POSITION | at, NONE)
        for _ in range(width.bit_length() - 1):
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def _merge_long(self, word: np.ndarray) -> np.ndarray:
        """One long word by a segment tree in plain lists; keys are (rank, position) as one integer."""
        symbol = word.tolist()
        n = len(symbol)
        width = 1 << (n - 1).bit_length()
        shift, top = n.bit_length(), 1 << 80
        rank_of, made = self.rank_of, self.made
        tree = [top] * (2 * width)
        for i in range(n - 1):
            rank = rank_of.get(symbol[i] << 32 | symbol[i + 1])
            if rank is not None:
                tree[width + i] = rank << shift | i
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, key: int) -> None:
            node = i + width
            tree[node] = key
            while node > 1:
                node >>= 1
                key = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == key:
                    break
                tree[node] = key

        def pair(i: int, j: int) -> int:
            rank = rank_of.get(symbol[i] << 32 | symbol[j])
            return top if rank is None else rank << shift | i

        while tree[1] < top:
            rank, at = tree[1] >> shift, tree[1] & ((1 << shift) - 1)
            gone = after[at]
            then = after[gone]
            symbol[at], symbol[gone], after[at] = int(made[rank]), -1, then
            put(gone, top)
            if then < n:
                before[then] = at
            put(at, pair(at, then) if then < n else top)
            if before[at] >= 0:
                put(before[at], pair(before[at], at))
        return np.array(symbol, np.int64)

    # -- texts ----------------------------------------------------------------------

    def pieces(self, text: str) -> list[str]:
        """The normalised text without its white space; special tokens stand alone."""
        if self.cut is None:
            return self._plain(text)
        found: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            found.extend([part] if i % 2 else self._plain(part))
        return found

    @staticmethod
    def _plain(text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if _ODD.search(text):
            return [p for p in _SPACES.sub(" ", text).replace("Σ", "σ").lower().split(" ") if p]
        return text.replace("Σ", "σ").lower().split()

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode what is not remembered yet, all at once."""
        new = [p for p in pieces if p not in self.ids]
        found = [() if p in self.special else self.words.findall(p) for p in new]
        tokens, sizes = self.merge(*self.symbols([w for words in found for w in words]))
        until = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(list(map(len, found)), dtype=np.int64)].tolist()
        raw, names = tokens.astype("<u4").tobytes(), list(map(self.names.__getitem__, tokens.tolist()))
        begin = 0
        for piece, end in zip(new, until, strict=True):
            if piece in self.special:
                self.ids[piece], self.texts[piece] = np.array([self.special[piece]], "<u4").tobytes(), piece
            else:
                self.ids[piece], self.texts[piece] = raw[4 * begin : 4 * end], " ".join(names[begin:end])
            begin = end

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """For each text its ids (little-endian unsigned 32 bit) and the text they decode to."""
        if len(self.ids) > CACHE:
            self.ids, self.texts = {}, {}
        split = [self.pieces(text) for text in texts]
        self.learn({p for pieces in split for p in pieces})
        ids, names = self.ids.__getitem__, self.texts.__getitem__
        for pieces in split:
            yield b"".join(map(ids, pieces)), " ".join(filter(None, map(names, pieces)))


def slices(texts: list[str], limit: int = SLICE) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``limit`` characters; a longer text is a list of its own."""
    some: list[str] = []
    size = 0
    for text in texts:
        if some and size + len(text) > limit:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) per row of ``docs`` (doc_id, text).

    ``ids`` are little-endian unsigned 32-bit token ids by the vocabulary file at ``path``, ``decoded``
    is their decoding, special tokens included: the tokens' names with a space between. Null text is
    empty and gives no ids and an empty text; words of any length are merged whole. Rows stay as
    they are, repeated or with a null id; further columns are ignored. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(path)
        for batch in batches:
            done = 0
            for some in slices([t.as_py() or "" for t in batch.column(1)]):
                found = list(bpe.encode(some))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(some)), pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )
                done += len(some)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary, decoded string")
