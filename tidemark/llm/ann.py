"""Nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking.

A table's code is the nearest signed axis after each of several pseudo-rotations. A query's
margin of a code is the sum, over the rotations, of the squared difference between its value along
its own nearest axis and that along the code's axis; it probes all codes up to one margin, which is
fitted so that a sample of queries finds a given share of what is truly nearest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored
from tidemark.llm.vectors import matrix, packed, unit, unpack, usable

TURNS = 3  # rounds of random signs and Hadamard transform
SAMPLE = 64  # queries of each length that the margin is fitted on, against all rows
SHARD = 65_536  # table entries compared in one group: a query gets k rows from each
ASKS = 65_536  # queries, at about most, of one group
TILE = 2_048  # rows of a block's side
PAIRS = 32  # pairs scored at once, for each row of a block's side
LONG = 0.95  # share of the norms above which a candidate meets every query ..
LONGER = 1.05  # .. if it is so much longer than the median
EVERY = 0  # the code of such candidates


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, kept orthonormal."""
    n, width, half = len(rows), rows.shape[1], 1
    while half < width:
        pair = rows.reshape(n, width // (2 * half), 2, half)
        rows = np.concatenate([pair[:, :, :1] + pair[:, :, 1:], pair[:, :, :1] - pair[:, :, 1:]], axis=2).reshape(n, width)
        half *= 2
    return rows / np.sqrt(width)


def axis_values(rows: np.ndarray, rotation: int) -> np.ndarray:
    """Each row's value along every signed axis after a pseudo-rotation."""
    rng = np.random.default_rng((11, rotation))
    for _ in range(TURNS):
        rows = hadamard(rows * rng.choice(np.array([-1.0, 1.0]), rows.shape[1]))
    return np.concatenate([rows, -rows], axis=1)


def signed_axes(size: int) -> int:
    return 2 << (size - 1).bit_length()


def directions(rows: np.ndarray) -> np.ndarray:
    """Unit vectors padded to a power of two."""
    n, size = rows.shape
    out = np.zeros((n, signed_axes(size) // 2))
    out[:, :size] = unit(rows)
    return out


def nearest_axes(high: np.ndarray, table: int, axes: int) -> np.ndarray:
    """(row, rotation): the signed axis next to each direction after each rotation of a table."""
    return np.stack([axis_values(high, table * axes + j).argmax(1) for j in range(axes)], axis=1)


def margins(high: np.ndarray, rotation: int) -> np.ndarray:
    """(signed axis, row): how much each axis of a rotation adds to a row's margin."""
    values = axis_values(high, rotation)
    return np.ascontiguousarray(np.square(values.max(1, keepdims=True) - values).T)


def by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """Blocks of rows (id, vec_id, embedding) of each length, and their matrix."""
    sizes = np.diff(batch.column(2).offsets.to_numpy())
    for size in np.unique(sizes).tolist():
        same = batch.filter(pa.array(sizes == size))
        for at in range(0, len(same), TILE):
            part = same.slice(at, TILE)
            yield size, part, matrix(part.column(2), size)


def lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def indexed(long: dict[int, float], tables: int, axes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row per vector: its number of components, them packed and a code for every table.

    ``first`` stands for the table and the first signed axis, ``code`` for all axes. Candidates of
    a norm above the one ``long`` has for their length have one code, which every query probes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part, rows in by_size(batch):
                high, width = directions(rows), signed_axes(size)
                first, code = np.zeros((2, len(rows), tables), np.int64)
                for table in range(tables):
                    near = nearest_axes(high, table, axes)
                    first[:, table] = 1 + table * width + near[:, 0]
                    for j in range(axes):
                        code[:, table] = code[:, table] * width + near[:, j]
                    code[:, table] += 1 + table * width**axes
                top = np.linalg.norm(rows, axis=1) > long[size]
                kept = ~top[:, None] | (np.arange(tables) == 0)
                first[top], code[top] = EVERY, EVERY
                codes = pa.StructArray.from_arrays([pa.array(first[kept].astype(np.int32)), pa.array(code[kept])], names=["first", "code"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.full(len(rows), size, np.int32)), pa.array(packed(rows), pa.binary()), lists(kept.sum(1), codes)],
                    names=["id", "vec_id", "size", "v", "codes"],
                )

    return run


def probed(limits: dict[int, float], tables: int, axes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, size, firsts) of each query: every table and first axis within the margin of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part, rows in by_size(batch):
                high = directions(rows)
                near = np.concatenate([margins(high, table * axes) <= limits[size] for table in range(tables)]).T
                near = np.concatenate([np.ones((len(rows), 1), bool), near], axis=1)  # EVERY comes first
                firsts = pa.array(np.nonzero(near)[1].astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.full(len(rows), size, np.int32)), lists(near.sum(1), firsts)], names=["id", "size", "firsts"])

    return run


def nearest_of_sample(sample: dict[int, tuple[np.ndarray, np.ndarray]], k: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The best ``k`` of a partition for each query of ``sample`` (ids and rows by length), by all products."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, pd.DataFrame] = {}
        for frame in frames:
            for size, part in frame.groupby("size"):
                own, q = sample.get(size, (np.zeros(0, np.int64), np.zeros((0, size))))
                score = q @ unpack(part["v"], size).T
                score[own[:, None] == part["id"].to_numpy()] = -np.inf
                near = np.argsort(-score, axis=1)[:, :k]
                ask = np.repeat(np.arange(len(own)), near.shape[1])
                found = part.iloc[near.ravel()].assign(q=own[ask], score=score[ask, near.ravel()])
                found = pd.concat([best[size], found]) if size in best else found
                found = found[found["score"] > -np.inf].sort_values("score", ascending=False)
                best[size] = found.groupby("q").head(k)
        for found in best.values():
            yield found[["q", "size", "v", "every", "score"]]

    return run


def fitted_margins(base: DataFrame, queries: DataFrame, sizes: list[int], k: int, tables: int, axes: int, recall: float) -> dict[int, float]:
    """For each length the least margin at which a sample of queries finds ``recall`` of its ``k`` nearest.

    The sample, ``SAMPLE`` queries a length by a hash of their number, meets all rows; it and its nearest,
    ``SAMPLE`` x ``k`` rows a length, are all that reaches the driver.
    """
    order = Window.partitionBy("size").orderBy(F.xxhash64("id"), "id")
    chosen = queries.select("id", "size", "v", F.row_number().over(order).alias("place")).where(F.col("place") <= SAMPLE).collect()
    sample = {s: (np.array([r["id"] for r in chosen if r["size"] == s]), unpack([r["v"] for r in chosen if r["size"] == s], s)) for s in {r["size"] for r in chosen}}
    rows = base.select("id", "size", "v", (F.col("codes")[0]["code"] == EVERY).alias("every"))
    truth = rows.mapInPandas(nearest_of_sample(sample, k), "q long, size int, v binary, every boolean, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"))
    truth = truth.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).drop("place").toPandas()
    limits = dict.fromkeys(sizes, 0.0)
    for size, part in truth.groupby("size"):
        own, q = sample[size]
        place = {i: n for n, i in enumerate(own.tolist())}
        ask, q, x = part["q"].map(place).to_numpy(), directions(q), directions(unpack(part["v"], size))
        need = np.full(len(part), np.inf)
        for table in range(tables):
            near = nearest_axes(x, table, axes)
            need = np.minimum(need, sum(margins(q, table * axes + j)[near[:, j], ask] for j in range(axes)))
        need[part["every"].to_numpy()] = 0
        limits[size] = float(np.sort(need)[int(np.ceil(recall * len(need))) - 1]) * (1 + 1e-9)
    return limits


FOUND_COLUMNS = ("q", "query_id", "c", "vec_id", "score")  # numbers of both rows beside their ids
FOUND = "q long, query_id long, c long, vec_id long, score double"


def in_row(row: np.ndarray) -> np.ndarray:
    """Each entry's place among those of its row, which stand together."""
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))[: len(row)]
    return np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))


class Best:
    """The best ``k`` candidates of a block of queries so far, each pair counted once."""

    def __init__(self, q: np.ndarray, x: np.ndarray, own: np.ndarray, ids: np.ndarray, row_of: np.ndarray, k: int):
        self.q, self.x, self.own, self.ids, self.row_of, self.k = q, x, own, ids, row_of, k
        self.found, self.pending, self.worst = [], 0, np.full(len(q), -np.inf)

    def meet(self, rows: np.ndarray, cols: np.ndarray) -> None:
        """Score pairs of a query and a candidate on the original vectors."""
        other = self.own[rows] != self.row_of[cols]
        rows, cols = rows[other], cols[other]
        for at in range(0, len(rows), TILE * PAIRS):
            row, col = rows[at : at + TILE * PAIRS], cols[at : at + TILE * PAIRS]
            score = np.einsum("ij,ij->i", self.q[row], self.x[col])  # alike wherever a pair is met
            near = score >= self.worst[row]
            self.found.append((row[near].astype(np.int32), col[near].astype(np.int32), score[near]))
            self.pending += int(near.sum())
            if self.pending > 2 * max(TILE, len(self.q)) * self.k:
                self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, col, score = (np.concatenate(one) for one in zip((np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0)), *self.found, strict=True))
        order = np.lexsort((col, row))
        once = order[np.concatenate(([True], (np.diff(row[order]) != 0) | (np.diff(col[order]) != 0)))[: len(order)]]
        row, col, score = row[once], col[once], score[once]
        order = np.lexsort((self.row_of[col], self.ids[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        place = in_row(row)
        self.worst[row[place == self.k - 1]] = score[place == self.k - 1]
        near = place < self.k
        self.found = [(row[near], col[near], score[near])]
        self.pending = 0
        return self.found[0]


def within(margin: list[np.ndarray], limit: float, so_far: np.ndarray, digits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a query and a sorted code whose margins sum up to ``limit``, axis by axis.

    Codes that agree in an axis are gone into with the queries that are still near, all others left out.
    """
    if len(margin) == 1:
        for at in range(0, len(digits), TILE):
            col, row = np.nonzero(margin[0][digits[at : at + TILE, 0]] + so_far <= limit)
            yield row, at + col
        return
    lead = digits[:, 0]
    start = np.flatnonzero(np.concatenate(([True], lead[1:] != lead[:-1])))[: len(lead)].tolist()
    for at, end in zip(start, [*start[1:], len(lead)], strict=True):
        total = so_far + margin[0][lead[at]]
        near = np.flatnonzero(total <= limit)
        if len(near):
            for row, col in within([m[:, near] for m in margin[1:]], limit, total[near], digits[at:end, 1:]):
                yield near[row], at + col


def search_group(k: int, limits: dict[int, float] | None = None, tables: int = 1, axes: int = 1) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The best ``k`` of one group for each query in it, by exact inner products.

    Queries meet only candidates with a code within their margin; a pair that meets in several tables counts once.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        asks, has = frame[frame["query"]], frame[~frame["query"]]
        if not len(asks) or not len(has):
            return pd.DataFrame({c: np.zeros(0, np.float64 if c == "score" else np.int64) for c in FOUND_COLUMNS})
        size = int(frame["size"].iloc[0])
        limit, width = (limits or {}).get(size, np.inf), signed_axes(size)
        q, x = unpack(asks["v"], size), unpack(has["v"], size)
        ids, own, row_of, asked = has["vec_id"].to_numpy(), asks["id"].to_numpy(), has["id"].to_numpy(), asks["vec_id"].to_numpy()
        of = np.repeat(np.arange(len(has)), [len(c) for c in has["codes"]])
        code = np.concatenate([np.asarray(c, np.int64) for c in has["codes"]])
        order = np.argsort(code, kind="stable")
        every, of, code = of[code == EVERY], of[order], code[order]
        of, code = of[code != EVERY], code[code != EVERY] - 1
        digits = np.stack([code // width**j % width for j in range(axes - 1, -1, -1)], axis=1)
        edge = np.searchsorted(code, np.arange(tables + 1) * width**axes)  # the tables' candidates stand together
        out = []
        for at in range(0, len(q), TILE):
            block = slice(at, at + TILE)
            best = Best(q[block], x, own[block], ids, row_of, k)
            rows = np.arange(len(best.q))
            for to in range(0, len(every), TILE):
                some = every[to : to + TILE]
                best.meet(np.repeat(rows, len(some)), np.tile(some, len(rows)))
            high = directions(best.q)
            for table in np.flatnonzero(np.diff(edge)).tolist():
                margin = [margins(high, table * axes + j) for j in range(axes)]
                for row, col in within(margin, limit, np.zeros(len(rows)), digits[edge[table] : edge[table + 1]]):
                    best.meet(row, of[edge[table] + col])
            row, col, score = best.settle()
            out.append(pd.DataFrame({"q": own[block][row], "query_id": asked[block][row], "c": row_of[col], "vec_id": ids[col], "score": score}))
        return pd.concat(out)

    return run


def nearest(vectors: DataFrame, is_query, k: int = 20, tables: int = 16, axes: int = 3, recall: float = 0.95) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found by inner product.

    ``vectors`` has (vec_id, embedding), ``is_query`` is a condition on vec_id; every other row is a
    candidate of the queries of its length. Ties go to the smaller vec_id. Vectors that are null,
    zero or hold null or non-finite components take no part, nor do rows with a null vec_id; rows
    that repeat a vec_id are each a candidate, of each other too, and each a query. A query that its probes give fewer than ``k`` is searched again
    among all candidates, so a short answer means that there are no more. An empty table gives no
    rows. Every row is indexed; scores are exact, only the candidates are found by hashing.

    A code has ``axes`` axes in each of ``tables`` tables. How far queries probe follows from the
    data: a sample of them must find ``recall`` of what is nearest among all rows.

    Hashing is by direction, whatever the norms. The longest candidates, a twentieth at most, can
    be near with a small cosine that probes would miss: every query is compared with them.

    Entries are dealt by table and first axis to groups of bounded size, a hot one over several of
    them; a group with many queries is copied, so that each copy has about ``ASKS`` of them at most.
    """
    valid = vectors.where(F.col("vec_id").isNotNull() & usable("embedding", F.size("embedding"))).select(F.monotonically_increasing_id().alias("id"), "vec_id", "embedding")
    valid = stored(valid, "valid")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    lengths = valid.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("count"), F.percentile_approx(norm, [0.5, LONG]).alias("norms"))
    lengths = lengths.collect()  # at most as many as the longest vector has components
    long = {r["size"]: max(r["norms"][0] * LONGER, r["norms"][1]) for r in lengths}
    count = sum(r["count"] for r in lengths)
    wanted = vectors.sparkSession.createDataFrame([(r["size"], min(k, r["count"] - 1)) for r in lengths], "size int, wanted int")
    schema = "id long, vec_id long, size int, v binary, codes array<struct<first: int, code: long>>"
    base = stored(valid.mapInArrow(indexed(long, tables, axes), schema), "index")
    limits = fitted_margins(base, base.where(is_query), list(long), k, tables, axes, recall)
    coded = base.select("id", "vec_id", "size", "v", F.inline("codes"))
    per_first = coded.groupBy("size", "first").count()  # at most tables x signed axes rows a length
    groups = max(1, -(-count * tables // SHARD))
    parts = stored(per_first.select("size", "first", F.ceil(F.col("count") / SHARD).cast("int").alias("parts")), "codes")
    shard = lambda part: F.pmod(F.xxhash64("first", part), F.lit(groups)).cast("int").alias("shard")
    held = coded.join(F.broadcast(parts), ["size", "first"]).select("id", "vec_id", "size", "v", "code", shard(F.pmod(F.xxhash64("id"), F.col("parts").cast("long")).cast("int")))
    held = held.groupBy("shard", "size", "id", "vec_id").agg(F.first("v").alias("v"), F.collect_list("code").alias("codes"), F.lit(False).alias("query"))

    def found(asked: DataFrame, limits: dict[int, float], tables: int) -> DataFrame:
        probes = asked.select("id", "vec_id", "embedding").mapInArrow(probed(limits, tables, axes), "id long, size int, firsts array<int>")
        probes = probes.select("id", "size", F.explode("firsts").alias("first")).join(F.broadcast(parts), ["size", "first"])
        probes = probes.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("id", "size", shard(F.col("part"))).distinct()
        asked_by = probes.groupBy("shard", "size").agg(F.ceil(F.count("*") / ASKS).cast("int").alias("sides"))
        sides = F.broadcast(stored(asked_by, "sides"))  # a row a group; groups without queries go
        asks = probes.join(base.select("id", "vec_id", "v"), "id").join(sides, ["shard", "size"])
        asks = asks.withColumns({"codes": F.array().cast("array<long>"), "query": F.lit(True), "side": F.pmod(F.xxhash64("id", F.lit("side")), F.col("sides").cast("long")).cast("int")})
        has = held.join(sides, ["shard", "size"]).withColumn("side", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
        pairs = has.unionByName(asks).groupBy("shard", "size", "side").applyInPandas(search_group(k, limits, tables, axes), FOUND)
        best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "c")
        return pairs.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    queries = valid.where(is_query)
    first = stored(found(queries, limits, tables), "nearest")
    had = first.groupBy(F.col("q").alias("id")).agg(F.count("*").alias("had"))
    short = queries.join(had, "id", "left").join(F.broadcast(wanted), F.size("embedding") == wanted["size"])
    short = stored(short.where(F.coalesce("had", F.lit(0)) < F.col("wanted")).select("id", "vec_id", "embedding"), "short")
    if short.isEmpty():
        return first.select("query_id", "rank", "vec_id", "score")
    again = found(short, dict.fromkeys(long, float("inf")), 1)  # every code of one table
    done = first.join(short.select(F.col("id").alias("q")), "q", "left_anti")
    return done.unionByName(again).select("query_id", "rank", "vec_id", "score")
