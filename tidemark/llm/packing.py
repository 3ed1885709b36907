"""Packing documents into fixed-length sequences: best-fit decreasing, certified by lower bounds."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import byte_letters, slices
from tidemark.llm.common import stored

CACHE = 400_000  # distinct pieces of text whose tokens a worker remembers
GROUP = 16_384  # pieces that are packed together
# Fixed value: the pattern that cuts text before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_DOUBLED = re.compile(r" \s|\s |^\s|\s$|\0").search
ROUNDS = 4  # exchanges at most; every one keeps the better packing


class ChunkEncoder(dict):
    """Token ids of the text between spaces, remembered; the library encodes what is new.

    A lone space belongs to the word after it and no token reaches across it, so a text without
    doubled white space is the sum of its chunks. Any other text goes to the library whole.
    """

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = {c: b for b, c in enumerate(byte_letters())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.library = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = tuple(special)
        self.size = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
        for token, i in ranks.items():
            self.size[i] = len(token)

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, allowed_special="all"), "<u4").tobytes()

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks as one text, in which no token reaches from one to the next."""
        first = [c for c in chunks if not c.startswith(" ")]
        for some, mark in ((first, "\n"), ([c for c in chunks if c.startswith(" ")], "")):
            ids = np.array(self.library.encode_ordinary("".join([mark + c for c in some])), np.int64)
            ends = np.concatenate(([0], np.cumsum(self.size[ids])))
            until = np.cumsum([len(mark) + len(c.encode("utf-8", "surrogatepass")) for c in some], dtype=np.int64)
            at = np.searchsorted(ends, np.concatenate(([0], until))).tolist()
            raw = ids.astype("<u4").tobytes()
            skip = len(mark)
            for chunk, a, b in zip(some, at[:-1], at[1:], strict=True):
                self[chunk] = raw[4 * (a + skip) : 4 * b]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers, special tokens recognised."""
        if len(self) > CACHE:
            self.clear()
        split = [self.chunks(text) for text in texts]
        self.learn(list({c for chunks in split if chunks for c in chunks}.difference(self)))
        of = self.__getitem__
        for text, chunks in zip(texts, split, strict=True):
            yield self.whole(text) if chunks is None else b"".join(map(of, chunks))

    def chunks(self, text: str) -> list[str] | None:
        """The text cut before its spaces; None where chunks would not be independent."""
        if any(s in text for s in self.special):
            return None
        if _DOUBLED(text):
            return None
        chunks = text.replace(" ", "\0 ").split("\0")
        return chunks


def cut_points(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first holds what full pieces leave over."""
    first = tokens % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, tokens, capacity))]


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids) of each row of ``docs`` (doc_id, text); ids little-endian."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            keys = batch.column(0).to_pylist()
            done = 0
            for some in slices([t.as_py() or "" for t in batch.column(1)]):
                rows = []
                for key, raw in zip(keys[done : done + len(some)], encoder.encode(some), strict=True):
                    raw += end
                    rows += [(key, k, a, n, raw[4 * a : 4 * (a + n)]) for k, (a, n) in enumerate(cut_points(len(raw) // 4, capacity))]
                done += len(some)
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, as the best of three families of dual feasible functions."""
    if not len(lengths):
        return 0
    size = np.arange(capacity + 1)
    count = np.bincount(lengths, minlength=capacity + 1)
    best = -(-int((size * count).sum()) // capacity)
    for low in range(1, capacity // 2 + 1):  # large ones count whole, small ones not at all
        value = np.where(size > capacity - low, capacity, np.where(size < low, 0, size))
        best = max(best, -(-int((value * count).sum()) // capacity))
    for k in range(1, 101):  # rounding down to multiples of 1/k, exact multiples of 1/(k+1) kept
        part = (k + 1) * size
        value = np.where(part % capacity == 0, size * k, part // capacity * capacity)
        best = max(best, -(-int((value * count).sum()) // (capacity * k)))
    for low in range(1, capacity // 2 + 1):  # above half: what is left after pieces of the least size
        value = np.where(size * 2 > capacity, 2 * (capacity // low - (capacity - size) // low), np.where(size * 2 == capacity, capacity // low, 2 * (size // low)))
        value = np.where(size < low, 0, value)
        best = max(best, -(-int((value * count).sum()) // (2 * (capacity // low))))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece by best-fit decreasing, and the fill of each bin."""
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    fill: list[int] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by room left
    rooms = 0  # bit r: a bin with room r is open
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            at = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            room, at = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = at, fill[at]
        fill[at] += need
        left = room - need
        if left:
            if not free[left]:
                rooms |= 1 << left
            free[left].append(at)
    return bins, offsets, np.array(fill, np.int64)


def packer(turn: int, capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Packs one group; a bin's number holds the exchange and the group."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        lengths = frame["length"].to_numpy(np.int64)
        bins, offsets, fill = best_fit(lengths, capacity)
        proven = len(fill) <= lower_bound(lengths, capacity)
        number = (np.int64(turn) << 56) | (frame["_group"].to_numpy(np.int64) << 28) | bins
        return pd.DataFrame({"_row": frame["_row"], "length": lengths, "sequence_id": number, "offset": offsets, "_kept": proven | (fill[bins] == capacity), "_first": offsets == 0})

    return run


def pack(pieces: DataFrame, capacity: int, group: int = GROUP) -> DataFrame:
    """``pieces`` (with length from 1 to ``capacity``) with sequence_id and offset.

    Full pieces are sequences of their own. The others are dealt evenly into groups of about
    ``group`` and packed by best-fit decreasing. A group whose number of bins equals the lower
    bound of its pieces is settled. The others keep their full bins, exchange what is in the rest
    and are packed again, as long as that saves bins. Any number of rows with any lengths packs;
    an empty table gives no rows. Nothing is dropped: each piece is in one sequence.
    """
    pieces = stored(pieces, "pieces").withColumn("_row", F.monotonically_increasing_id())
    pieces = stored(pieces, "piece-rows")
    loose = pieces.where(F.col("length") < capacity).select("_row", F.col("length").cast("int").alias("length"))
    count = loose.count()
    settled: list[DataFrame] = []
    bins_before = None
    packed = None
    for turn in range(ROUNDS):
        groups = max(1, -(-count // group))

        dealt = loose.withColumn("_group", F.pmod(F.xxhash64("_row", F.lit(turn)), F.lit(groups)))
        tried = stored(dealt.groupBy("_group").applyInPandas(packer(turn, capacity), "_row long, length int, sequence_id long, offset long, _kept boolean, _first boolean"), f"packed-{turn}")
        open_bins, total, left = tried.agg(F.count_if(F.expr("_first and not _kept")), F.count_if("_first"), F.count_if(F.expr("not _kept"))).first()
        if bins_before is not None and total >= bins_before:
            break  # the exchange saved nothing: the packing before stands
        if packed is not None:
            settled.append(packed.where("_kept"))
        packed = tried
        if not left or groups == 1:
            break
        loose, count, bins_before = tried.where("not _kept").select("_row", "length"), left, open_bins
    settled.append(packed)
    placed = settled[0]
    for more in settled[1:]:
        placed = placed.unionByName(more)
    rest = pieces.where(F.col("length") < capacity).join(placed.select("_row", F.col("sequence_id") * 2 + 1, "offset").toDF("_row", "sequence_id", "offset"), "_row")
    full = pieces.where(F.col("length") >= capacity).withColumns({"sequence_id": F.col("_row") * 2, "offset": F.lit(0).cast("long")})
    return full.unionByName(rest).drop("_row")


def pack_documents(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids by the vocabulary file at ``path`` and ``end_id``; null text is empty,
    so every row has a piece. Longer ones are cut into pieces of ``capacity`` tokens, of which the
    first may be shorter. Rows with repeated or null doc_id are packed as rows of their own.
    """
    checksum = F.crc32("ids").alias("ids_crc32")
    pieces = token_pieces(docs, path, end_id, capacity).select("doc_id", "piece", "start", "length", checksum)
    return pack(pieces, capacity)

