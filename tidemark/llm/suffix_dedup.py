"""Removal of byte strings that occur more than once, by suffix sorting what can repeat."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import blob, gathered, joined, mapped, put, shared_folder, summed
from tidemark.llm.common import beside_text, stored
from tidemark.llm.suffix_sort import repeated_starts

CHUNK = 1 << 17  # window starts of a text worked on at once
SORT = 1 << 20  # bytes that are suffix-sorted at once, unless one anchor has more
FLUSH = 2_000_000  # anchors held before they are dealt out
PART = 1 << 19  # bytes of a key's strings beyond which they are cut and dealt anew
FAN = 4  # parts that a block of distances to the anchor is cut into
MULTIPLIER = 0x9E3779B97F4A7C15


@lru_cache(4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rise = np.cumprod(np.full(size, MULTIPLIER, np.uint64), dtype=np.uint64)
    fall = np.cumprod(np.full(size, pow(MULTIPLIER, -1, 1 << 64), np.uint64), dtype=np.uint64)
    letters = np.random.default_rng((5, 0)).integers(1, 1 << 63, 256).astype(np.uint64)
    return rise, fall, letters


def run_hashes(raw: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` bytes, from its content alone."""
    rise, fall, letters = _powers(1 << max(10, int(len(raw)).bit_length()))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(letters[raw] * rise[: len(raw)], dtype=np.uint64)))
    h = (sums[width:] - sums[:-width]) * fall[: len(raw) - width + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sliding(rows: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every ``width`` neighbours."""
    out, reach = rows, 1
    while 2 * reach <= width:
        out = pick(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


class Anchors:
    """A window's anchor is the least hash of the runs of ``kmer`` bytes in it.

    Equal windows have equal anchors, so starts are dealt by anchor: those in a row with one anchor
    are one string, from the first of them to the last one's window.
    """

    def __init__(self, width: int):
        self.width = width
        self.kmer = max(1, min(64, width // 4))
        self.inside = width - self.kmer + 1

    def chunks(self, text: bytes) -> Iterator[tuple[int, np.ndarray]]:
        """(first start, bytes) of parts of a text that share no start and cover all."""
        raw = np.frombuffer(text, np.uint8)
        for at in range(0, len(raw) - self.width + 1, CHUNK):
            yield at, raw[at : at + CHUNK + self.width - 1]

    def found(self, raw: np.ndarray) -> np.ndarray:
        """The anchors of a part, as often as they stand in it."""
        h = run_hashes(raw, self.kmer)
        low = sliding(h, self.inside, np.minimum)
        edge = np.zeros(self.inside - 1, np.uint64)  # a run is an anchor if it is the least of any window with it
        return h[h == sliding(np.concatenate([edge, low, edge]), self.inside, np.maximum)]

    def strings(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, first start, number of starts) of the strings of a part."""
        low = sliding(run_hashes(raw, self.kmer), self.inside, np.minimum)
        at = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1], [True])))
        return low[at[:-1]], at[:-1], np.diff(at)

    def cuts(self, raw: np.ndarray, anchor: int, owned: int, block: int) -> Iterator[tuple[int, int, int, int, int]]:
        """(first start, number of starts, block, begin and end of what their windows share) of the parts of a string.

        A window's distance is that from its start to its first anchor. Equal windows have equal
        distances; those of one block of distances all hold the bytes around the anchor that the
        block's outermost windows share.
        """
        starts = np.arange(owned)
        places = np.flatnonzero(run_hashes(raw, self.kmer) == np.uint64(anchor % (1 << 64)))
        place = places[np.searchsorted(places, starts)]
        part = (place - starts) // block
        edge = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (part[1:] != part[:-1]), [True])))
        first = edge[:-1]
        place, part = place[first], part[first]
        end = place - np.minimum((part + 1) * block, self.inside) + 1 + self.width
        return zip(first.tolist(), np.diff(edge).tolist(), part.tolist(), (place - part * block).tolist(), end.tolist(), strict=True)


class Sorted:
    """Sorted keys in shards by their upper bits."""

    def __init__(self, folder: str, bits: int, there: set[int]):
        self.folder, self.bits, self.there = folder, bits, there
        self._open: dict[int, np.ndarray] = {}

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), bool)
        shard = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        for s in np.unique(shard).tolist():
            if s in self.there:
                if s not in self._open:
                    self._open[s] = mapped(self.folder, f"keys-{s}")
                held, some = self._open[s], shard == s
                at = np.minimum(np.searchsorted(held, keys[some]), len(held) - 1)
                out[some] = held[at] == keys[some]
        return out


def repeated_anchors(docs: DataFrame, width: int, folder: str, bits: int) -> Sorted:
    """The anchors that stand at two places at least."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, held, size = Anchors(width), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            ends = np.searchsorted((keys >> np.uint64(64 - bits)).astype(np.int64), np.arange((1 << bits) + 1))
            some = np.flatnonzero(np.diff(ends))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([blob(keys[ends[s] : ends[s + 1]], "<u8") for s in some], pa.binary()), pa.array([blob(np.minimum(counts[ends[s] : ends[s + 1]], 2), "u1") for s in some], pa.binary())],
                names=["shard", "keys", "counts"],
            )

        for batch in batches:
            for text in batch.column(0):
                for _, raw in anchors.chunks(text.as_py() or b""):
                    held.append(anchors.found(raw))
                    size += len(held[-1])
                    if size > FLUSH:
                        yield from flush()
                        held, size = [], 0
        if held:
            yield from flush()

    def write(shard: int, rows: list) -> Iterator[pa.RecordBatch]:
        keys, counts = summed(joined(rows, "keys", "<u8"), joined(rows, "counts", "u1").astype(np.int64))
        keys = keys[counts > 1]
        if len(keys):
            put(folder, f"keys-{shard}", keys)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64())], names=["shard"])

    dealt = docs.select("raw").mapInArrow(deal, "shard int, keys binary, counts binary")
    return Sorted(folder, bits, {r.shard for r in gathered(dealt, 1 << bits, write, "shard long").collect()})


def digest(text: bytes) -> tuple[int, int]:
    """Two signed halves of the MD5 that stands for a text."""
    raw = hashlib.md5(text, usedforsecurity=False).digest()
    return int.from_bytes(raw[:8], "big", signed=True), int.from_bytes(raw[8:], "big", signed=True)


def anchored_strings(docs: DataFrame, width: int, known: Sorted) -> DataFrame:
    """A row (anchor, hi, lo, start, owned, string, text) for each string with a repeated anchor."""
    schema = "anchor long, hi long, lo long, start long, owned long, string binary, text binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(width)
        for batch in batches:
            rows, size = [], 0
            for raw_text in batch.column(0):
                text = raw_text.as_py() or b""
                whole = None
                for base, raw in anchors.chunks(text):
                    key, start, number = anchors.strings(raw)
                    for i in np.flatnonzero(known.has(key)).tolist():
                        whole = whole or digest(text)
                        a, n = base + int(start[i]), int(number[i])
                        part = text[a : a + n + width - 1]
                        rows.append((int(key[i].astype(np.int64)), *whole, a, n, hashlib.md5(part, usedforsecurity=False).digest(), part))
                        size += len(part)
                if size > 1 << 23:
                    yield batch_of(rows, schema)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows, schema)

    return docs.select("raw").mapInArrow(run, schema)


KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)], names=[n for n, _ in fields])


FOUND = "string binary, first binary, last binary"


def intervals(starts: np.ndarray) -> tuple[bytes, bytes]:
    """Runs of successive starts, as blobs of their first and last ones."""
    edge = np.flatnonzero(np.diff(starts) > 1)
    return blob(starts[np.concatenate(([0], edge + 1))], "<i8"), blob(starts[np.concatenate((edge, [len(starts) - 1]))], "<i8")


def runs_of(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[list[dict]]:
    """Successive rows that agree in ``name``."""
    group: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if group and row[name] != group[-1][name]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def sorter(width: int, whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Repeated starts of strings that come ordered by key; all strings of a key are sorted together.

    Equal strings are sorted once, with the number of their copies. A string alone with its key
    repeats whole if it has copies; if it has none, only ``whole`` strings, which may hold their
    anchor several times, can repeat in themselves.
    """

    def solve(held: list[dict]) -> list[tuple]:
        rows = []
        for row, starts in zip(held, repeated_starts([row["text"] for row in held], [row["owned"] for row in held], width), strict=True):
            if row["copies"] > 1:  # a string with copies repeats whole
                starts = np.arange(row["owned"])
            if len(starts):
                rows.append((row["string"], *intervals(starts)))
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        rows: list[tuple] = []
        size = 0
        for group in runs_of(batches, "key"):
            if len(group) == 1 and group[0]["copies"] > 1:
                rows.append((group[0]["string"], *intervals(np.arange(group[0]["owned"]))))
            elif len(group) > 1 or whole:
                held += group
                size += sum(len(row["text"]) for row in group)
            if size > SORT:
                rows += solve(held)
                held, size = [], 0
            if len(rows) > 10_000:
                yield batch_of(rows, FOUND)
                rows = []
        if held:
            rows += solve(held)
        if rows:
            yield batch_of(rows, FOUND)

    return run


PIECES = "parent binary, at long, anchor long, key long, string binary, owned long, copies long, text binary"


def pieces(strings: DataFrame, width: int, block: int) -> DataFrame:
    """The parts of strings whose key has too many of them, dealt by what the windows of a part share.

    A row for each part: its parent and the place in it, a key of the shared bytes, and its text,
    which a task gives once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, seen = Anchors(width), set()
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for parent, anchor, text, owned, copies in zip(*batch.columns, strict=True):
                parent, anchor, text, owned, copies = parent.as_py(), anchor.as_py(), text.as_py(), owned.as_py(), copies.as_py()
                for at, number, part, begin, end in anchors.cuts(np.frombuffer(text, np.uint8), anchor, owned, block):
                    mine = text[at : at + number + width - 1]
                    name = hashlib.md5(mine, usedforsecurity=False).digest()
                    new = name not in seen
                    if new:
                        if len(seen) > FLUSH // 8:
                            seen.clear()
                        seen.add(name)
                        size += len(mine)
                    size += 100
                    rows.append((parent, at, anchor, digest(b"%d " % part + text[begin:end])[0], name, number, copies, mine if new else None))
                    if size > 1 << 23:
                        yield batch_of(rows, PIECES)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows, PIECES)

    return strings.select("string", "anchor", "text", "owned", "copies").mapInArrow(run, PIECES)


def in_parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of starts of each parent, from those of its parts; rows come ordered by parent."""
    rows: list[tuple] = []
    for group in runs_of(batches, "parent"):
        at = np.repeat([row["at"] for row in group], [len(row["first"]) // 8 for row in group])
        first, last = joined(group, "first", "<i8") + at, joined(group, "last", "<i8") + at
        order = np.argsort(first)
        first, last = first[order], last[order]
        gap = first[1:] > last[:-1] + 1  # parts share no start
        rows.append((group[0]["parent"], blob(first[np.concatenate(([True], gap))], "<i8"), blob(last[np.concatenate((gap, [True]))], "<i8")))
        if len(rows) > 10_000:
            yield batch_of(rows, FOUND)
            rows = []
    if rows:
        yield batch_of(rows, FOUND)


def repeated(strings: DataFrame, width: int, block: int, whole: bool = True) -> DataFrame:
    """Repeated starts (string, first, last) of different strings (anchor, key, string, text, owned, copies).

    Equal windows have equal keys. The strings of a key are suffix-sorted in one task if they have
    at most ``PART`` bytes. Otherwise they are cut: their windows are dealt by block of distances to
    the anchor and by the bytes that all windows of the block share, equal parts once with the sum
    of their copies, and so on with smaller blocks. In a block of one distance, windows of one key
    are equal, so every key ends within the bound, whatever share of the rows holds its passage.
    """
    hot = stored(strings.groupBy("key").agg(F.sum(F.length("text")).alias("bytes")).where(F.col("bytes") > PART).select("key"), "hot-keys")
    rest = block > 1 and not hot.isEmpty()
    some = strings.join(hot, "key", "left_anti") if rest else strings
    some = some.repartition("key").sortWithinPartitions("key")
    found = some.select("key", "string", "text", "owned", "copies").mapInArrow(sorter(width, whole), FOUND)
    if not rest:
        return found
    block = -(-block // FAN)
    parts = stored(pieces(strings.join(hot, "key", "left_semi"), width, block), "pieces")
    below = parts.groupBy("key", "string").agg(
        F.first("anchor").alias("anchor"), F.first("text", True).alias("text"), F.first("owned").alias("owned"), F.sum("copies").alias("copies")
    )
    deeper = stored(repeated(stored(below, "distinct-pieces"), width, block, False), "repeated-pieces")
    back = parts.select("parent", "at", "string").join(deeper, "string").select("parent", "at", "first", "last")
    return found.unionByName(back.repartition("parent").sortWithinPartitions("parent").mapInArrow(in_parents, FOUND))


class Spans:
    """The removed spans of texts by their digest."""

    def __init__(self, folder: str, bits: int, there: set[int]):
        self.folder, self.bits, self.there = folder, bits, there
        self._open: dict[int, tuple] = {}

    def of(self, text: bytes) -> list[tuple[int, int]]:
        hi, lo = digest(text)
        shard = (hi % (1 << 64)) >> (64 - self.bits)
        if shard not in self.there:
            return []
        if shard not in self._open:
            self._open[shard] = tuple(mapped(self.folder, f"{name}-{shard}") for name in ("hi", "lo", "ends", "first", "last"))
        his, los, ends, first, last = self._open[shard]
        at = int(np.searchsorted(his, hi))
        while at < len(his) and his[at] == hi:
            if los[at] == lo:
                part = slice(int(ends[at]), int(ends[at + 1]))
                return list(zip(first[part].tolist(), last[part].tolist(), strict=True))
            at += 1
        return []


def write_spans(found: DataFrame, width: int, folder: str, bits: int) -> Spans:
    """Merge the covered bytes of each text (hi, lo) and keep them in shards by digest."""

    def write(shard: int, rows: list) -> Iterator[pa.RecordBatch]:
        number = [len(r["first"]) // 8 for r in rows]
        spread = lambda name: np.repeat(np.array([r[name] for r in rows], np.int64), number)
        hi, lo, start = spread("hi"), spread("lo"), spread("start")
        first, last = start + joined(rows, "first", "<i8"), start + joined(rows, "last", "<i8") + width
        order = np.lexsort((first, lo, hi))
        hi, lo, first, last = hi[order], lo[order], first[order], last[order]
        fresh = np.concatenate(([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])))
        text = np.cumsum(fresh) - 1
        step = int(last.max()) + 1
        reach = np.maximum.accumulate(last + text * step)  # a text's own ends: earlier texts lie below
        new = fresh | np.concatenate(([True], first[1:] + text[1:] * step > reach[:-1]))
        at = np.flatnonzero(new)
        put(folder, f"first-{shard}", first[at])
        put(folder, f"last-{shard}", (reach - text * step)[np.concatenate((at[1:] - 1, [len(first) - 1]))])
        put(folder, f"hi-{shard}", hi[fresh])
        put(folder, f"lo-{shard}", lo[fresh])
        put(folder, f"ends-{shard}", np.searchsorted(text[at], np.arange(int(text[-1]) + 2)))
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64())], names=["shard"])

    sharded = found.withColumn("shard", F.expr(f"cast(shiftrightunsigned(hi, {64 - bits}) as int)"))
    return Spans(folder, bits, {r.shard for r in gathered(sharded, 1 << bits, write, "shard long").collect()})


def whole_words(text: bytes, first: int, last: int) -> int:
    """Words of a stretch of a text, between ASCII white space; those that it cuts do not count."""
    words = len(text[first:last].split())
    if first and words and not text[first - 1 : first].isspace() and not text[first : first + 1].isspace():
        words -= 1
    if last < len(text) and words and not text[last - 1 : last].isspace() and not text[last : last + 1].isspace():
        words -= 1
    return words


def remove_repeats(docs: DataFrame, width: int = 400, columns: tuple[str, ...] = ("doc_id",), least_words: int = 0) -> DataFrame:
    """One row (``columns``, n_bytes, spans, kept) per row of ``docs`` (doc_id, text).

    Every byte covered by ``width`` bytes that also start anywhere else, in the same or another
    row, is removed; windows lie within one text, overlaps count, and the input decides, not what
    is left. ``spans`` are the maximal removed runs (first, last; last not included), ``kept`` the
    remaining bytes of the UTF-8 text. A run of fewer than ``least_words`` whole words stays. Null text is empty. All copies are removed, none is kept.
    Repeated rows are copies of each other; null ids are kept; an empty table gives no rows.

    Only strings around anchors that stand in two places can repeat. They are gathered by anchor,
    equal ones once with their number, and their suffixes are sorted (see ``suffix_array``), those
    of an anchor with too many of them in parts (see ``repeated``). Texts are never shuffled: the
    spans are written by the texts' digests and mapped by the tasks that read the texts again.
    """
    texts = docs.select(F.col("text").cast("binary").alias("raw"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("raw")), F.lit(0))).first()[0]
    bits = max(1, (size >> 26).bit_length())
    folder = shared_folder(docs, "repeats")
    known = repeated_anchors(texts, width, f"{folder}/anchors", bits)
    placed = stored(anchored_strings(texts, width, known), "strings")
    strings = placed.groupBy("anchor", "string").agg(F.first("text").alias("text"), F.first("owned").alias("owned"), F.count("*").alias("copies"))
    found = stored(repeated(stored(strings.withColumn("key", F.col("anchor")), "distinct-strings"), width, Anchors(width).inside), "repeated-starts")
    covered = placed.select("hi", "lo", "start", "string").distinct().join(found, "string").select("hi", "lo", "start", "first", "last")
    spans = write_spans(covered, width, f"{folder}/spans", bits)

    frame, place, schema = beside_text(docs, columns, "n_bytes long, spans array<struct<first:long,last:long>>, kept binary")
    span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size, done = [], 0, 0
            for i, value in enumerate(batch.column(place)):
                text = (value.as_py() or "").encode("utf-8", "surrogatepass")
                gone = spans.of(text) if len(text) >= width else []
                if least_words:
                    gone = [(a, b) for a, b in gone if whole_words(text, a, b) >= least_words]
                ends = [0, *[x for pair in gone for x in pair], len(text)]
                rows.append((len(text), [{"first": a, "last": b} for a, b in gone], b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))))
                size += len(text)
                if size > 1 << 23 or i + 1 == batch.num_rows:
                    n, s, k = zip(*rows, strict=True)
                    kept = [c.slice(done, len(rows)) for c in batch.columns[: len(columns)]]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(n, pa.int64()), pa.array(s, span), pa.array(k, pa.binary())], names=[*columns, "n_bytes", "spans", "kept"])
                    done += len(rows)
                    rows, size = [], 0

    return frame.mapInArrow(run, schema)
