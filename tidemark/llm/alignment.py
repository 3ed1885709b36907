"""Alignment of two tokenizations of a text by products of token-byte incidence matrices."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import byte_letters, slices
from tidemark.llm.common import stored
from tidemark.llm.packing import PATTERN

BLOCK = 1 << 19  # bytes of text, at least one group, whose matrices are multiplied at once
FREQUENT = 1 << 18  # no more id pairs than this hold 1/FREQUENT of all links each: these are broadcast

LINKS = "array<struct<a int, b int, n int>>"
SCHEMA = f"doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups string, links {LINKS}"


class Csr(NamedTuple):
    """A 0/1 matrix: row i has ones in the columns ``idx[ptr[i]:ptr[i + 1]]``."""

    ptr: np.ndarray
    idx: np.ndarray
    cols: int


def incidence(ends: np.ndarray) -> Csr:
    """Tokens by bytes: token i covers the bytes from the end before it to ``ends[i]``."""
    ptr = np.concatenate(([0], ends)).astype(np.int64)
    return Csr(ptr, np.arange(ptr[-1], dtype=np.int64), int(ptr[-1]))


def membership(group: np.ndarray, groups: int) -> Csr:
    """Tokens by groups: every token is in one."""
    return Csr(np.arange(len(group) + 1, dtype=np.int64), group.astype(np.int64), groups)


def transposed(m: Csr) -> Csr:
    rows = np.repeat(np.arange(len(m.ptr) - 1, dtype=np.int64), np.diff(m.ptr))
    order = np.argsort(m.idx, kind="stable")
    return Csr(np.concatenate(([0], np.cumsum(np.bincount(m.idx, minlength=m.cols)))), rows[order], len(m.ptr) - 1)


def product(left: Csr, right: Csr) -> tuple[Csr, np.ndarray]:
    """Gustavson's row products: row i is the sum of the rows of ``right`` that row i of ``left`` names.

    Returned with the value of each entry: how many of the rows named have it.
    """
    brought = np.diff(right.ptr)[left.idx]
    until = np.cumsum(brought)
    total = int(until[-1]) if len(until) else 0
    take = np.arange(total, dtype=np.int64) + np.repeat(right.ptr[left.idx] - until + brought, brought)
    rows = np.repeat(np.repeat(np.arange(len(left.ptr) - 1, dtype=np.int64), np.diff(left.ptr)), brought)
    key = rows * right.cols + right.idx[take]
    if total and (np.diff(key) < 0).any():
        key.sort()
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if total else np.zeros(0, np.int64)
    key, value = key[first], np.diff(np.append(first, total))
    ptr = np.searchsorted(key, np.arange(len(left.ptr), dtype=np.int64) * right.cols)
    return Csr(ptr, key % max(right.cols, 1), right.cols), value


class Alignment(NamedTuple):
    """Tokens of A and B by number: their groups, and the overlap links as two equally long arrays."""

    group_a: np.ndarray
    group_b: np.ndarray
    cuts: np.ndarray  # where both have an end: the end of each group
    link_a: np.ndarray
    link_b: np.ndarray


def align(ends_a: np.ndarray, ends_b: np.ndarray, block: int = BLOCK) -> Alignment:
    """Align two cuttings of the same bytes into tokens, both given by ascending byte offsets of their ends.

    Groups do not depend on each other, so matrices are made for about ``block`` bytes of whole groups.
    """
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    at, links = 0, []
    while len(cuts) and at < cuts[-1]:
        until = int(cuts[min(np.searchsorted(cuts, at + block), len(cuts) - 1)])
        (a, b), (c, d) = np.searchsorted(ends_a, (at, until), "right"), np.searchsorted(ends_b, (at, until), "right")
        overlap, _ = product(incidence(ends_a[a:b] - at), transposed(incidence(ends_b[c:d] - at)))
        links.append((np.repeat(np.arange(a, b), np.diff(overlap.ptr)), overlap.idx + c))
        at = until
    link_a, link_b = (np.concatenate(x) for x in zip(*links, strict=True)) if links else (np.zeros(0, np.int64),) * 2
    return Alignment(np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), cuts, link_a, link_b)


def shared_degrees(group_a: np.ndarray, group_b: np.ndarray, groups: int) -> np.ndarray:
    """For each token of A how many tokens of B share its group.

    These are the row sizes of the group-incidence product, taken from the product with a column of
    ones: a group of p and q tokens has p·q shared-group links, which are not written out.
    """
    of_group = transposed(membership(group_b, groups))
    return np.diff(of_group.ptr)[membership(group_a, groups).idx]


def shared_links(group_a: np.ndarray, group_b: np.ndarray, groups: int) -> Csr:
    """The shared-group links themselves, tokens of A by tokens of B."""
    return product(membership(group_a, groups), transposed(membership(group_b, groups)))[0]


class Tokenizers:
    """Both tokenizers with the byte length of every token."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        letters = {c: b for b, c in enumerate(byte_letters())}
        special = {t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if i not in special}
        self.a = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size_a = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.size_a[i] = len(token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.size_b = np.array([len(piece) for piece in self.bytes_b], np.int64)
        self.decimal = [f"{i}{end}" for i in range(max(len(self.size_a), len(self.size_b))) for end in ",|;"]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text by both; none where a text is empty or either's bytes are not those of space and text."""
        ids_a, ids_b = [], []
        for text, some_b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            raw = b" " + text.encode("utf-8", "surrogatepass")
            some_a = np.array(self.a.encode_ordinary(" " + text), np.int64) if text else np.zeros(0, np.int64)
            whole = bool(text) and int(self.size_a[some_a].sum()) == len(raw) and b"".join(map(self.bytes_b.__getitem__, some_b)) == raw
            ids_a.append(some_a if whole else some_a[:0])
            ids_b.append(np.array(some_b if whole else [], np.int64))
        return ids_a, ids_b


def written(tools: Tokenizers, ids_a: np.ndarray, ids_b: np.ndarray, found: Alignment) -> list[str]:
    """The tokens of all groups in order, A's before B's, each id with the mark that follows it."""
    count_a, count_b = (np.bincount(g, minlength=len(found.cuts)) for g in (found.group_a, found.group_b))
    place_a = np.arange(len(ids_a)) + (np.cumsum(count_b) - count_b)[found.group_a]
    place_b = np.arange(len(ids_b)) + np.cumsum(count_a)[found.group_b]
    code = np.empty(len(ids_a) + len(ids_b), np.int64)
    code[place_a], code[place_b] = 3 * ids_a, 3 * ids_b
    code[np.cumsum(count_a + count_b) - count_b - 1] += 1
    code[np.cumsum(count_a + count_b) - 1] += 2
    return list(map(tools.decimal.__getitem__, code.tolist()))


def described(tools: Tokenizers, texts: list[str]) -> list[pa.Array]:
    """The columns of SCHEMA after doc_id for some texts, aligned side by side as one."""
    by_doc_a, by_doc_b = tools.encode(texts)
    n_a, n_b = (np.array([len(x) for x in some], np.int64) for some in (by_doc_a, by_doc_b))
    ids_a, ids_b = np.concatenate(by_doc_a), np.concatenate(by_doc_b)
    found = align(np.cumsum(tools.size_a[ids_a]), np.cumsum(tools.size_b[ids_b]))
    doc = np.repeat(np.arange(len(texts)), n_a)
    docs = np.arange(len(texts) + 1)
    doc_of_group = np.empty(len(found.cuts), np.int64)
    doc_of_group[found.group_a] = doc
    doc_of_link = doc[found.link_a]
    shared = shared_degrees(found.group_a, found.group_b, len(found.cuts))

    names = written(tools, ids_a, ids_b, found)
    until = np.concatenate(([0], np.cumsum(n_a + n_b))).tolist()
    groups = ["".join(names[a:b])[:-1] for a, b in zip(until[:-1], until[1:], strict=True)]

    wide = len(tools.size_b)
    key = (doc_of_link * len(tools.size_a) + ids_a[found.link_a]) * wide + ids_b[found.link_b]
    key, times = np.unique(key, return_counts=True)
    pair = key % (len(tools.size_a) * wide)
    parts = [pa.array(x.astype(np.int32)) for x in (pair // wide, pair % wide, times)]
    starts = np.searchsorted(key, docs * (len(tools.size_a) * wide)).astype(np.int32)
    links = pa.ListArray.from_arrays(pa.array(starts), pa.StructArray.from_arrays(parts, names=["a", "b", "n"]))
    per_doc = [
        n_a,
        n_b,
        np.bincount(doc_of_group, minlength=len(texts)),
        np.bincount(doc_of_link, minlength=len(texts)),
        np.bincount(doc, weights=shared, minlength=len(texts)),
    ]
    return [*[pa.array(x.astype(np.int64)) for x in per_doc], pa.array(groups, pa.string()), links]


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_shared, groups, links) per row of ``docs`` (doc_id, text).

    A is the byte-level vocabulary at ``path_a`` and reads a space and the text, B the piece model at
    ``path_b``, which adds that space itself; special tokens' strings are plain text. Byte offsets where
    tokens of both end cut them into groups, written as ``a1,a2|b1;a3|b2``. ``n_links`` pairs of tokens
    overlap, ``n_shared`` share a group; ``links`` says how often each pair of ids overlaps.

    Null or empty texts, and texts that either tokenizer does not give back byte for byte, have no
    tokens: zeros, empty text, no links. Rows stay as they are, repeated or with a null id; further
    columns are ignored; an empty table gives no rows. Texts are cut nowhere. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = Tokenizers(path_a, path_b)
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups", "links"]
        for batch in batches:
            done = 0
            for some in slices([t.as_py() or "" for t in batch.column(1)]):
                keys = batch.column(0).slice(done, len(some)).cast(pa.int64())
                done += len(some)
                yield pa.RecordBatch.from_arrays([keys, *described(tools, some)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, count, best) of each id pair in ``links``: its links in all rows, and whether no pair of b has more."""
    counts = stored(
        aligned.select(F.inline("links")).groupBy("a", "b").agg(F.sum("n").alias("count")), "alignment-counts"
    )
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def link_scores(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """(row, n_best, count_sum) of the rows of ``aligned`` (row, links) that have links.

    ``n_best`` links are of a pair that is the best of its b, ``count_sum`` adds up the counts of all
    links' pairs. Pairs that hold 1/FREQUENT of all links or more, at most FREQUENT of them, are
    broadcast; a pair beyond them has fewer links than that, so the shuffle on pairs has no hot key.
    """
    total = counts.agg(F.sum("count")).first()[0] or 0
    is_frequent = F.col("count") * F.lit(FREQUENT) >= F.lit(total)
    frequent, others = F.broadcast(counts.where(is_frequent)), counts.where(~is_frequent)
    links = aligned.select("row", F.inline("links"))

    def summed(rows: DataFrame) -> DataFrame:
        best = F.sum(F.when(F.col("best"), F.col("n")).otherwise(0))
        return rows.groupBy("row").agg(best.alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))

    by_broadcast = summed(links.join(frequent, ["a", "b"]))
    by_shuffle = summed(links.join(frequent.select("a", "b"), ["a", "b"], "left_anti").join(others, ["a", "b"]))
    both = by_broadcast.unionByName(by_shuffle)
    return both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment_scores(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256) per row of ``docs``.

    See ``alignments`` for the rows and ``link_scores`` for the sums, which are over all rows of
    ``docs``. Rows without tokens have zeros and the empty text for ``groups_sha256``.
    """
    aligned = alignments(docs, path_a, path_b)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    rows = stored(aligned.select("*", digest).drop("groups").withColumn("row", F.monotonically_increasing_id()), "alignment")
    scores = link_scores(rows, stored(pair_counts(rows), "alignment-pairs"))
    sums = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared"]
    return rows.select(*kept, "groups_sha256", "row").join(scores, "row", "left").select(*kept, *sums, "groups_sha256")
