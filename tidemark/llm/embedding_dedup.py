"""Embedding near-duplicates: spherical k-means cells, blocked cosine products within cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, stored
from tidemark.llm.vectors import matrix, packed, unit, unpack, usable

SAMPLE = 20_000  # vectors, at most about, on which the centres are fitted
PER_CELL = 512  # distinct vectors a cell should have
MAX_CELLS = 4_096  # of vectors of one length; larger cells are only more blocks
BLOCK = 2_048  # vectors of a side of a block
TURNS = 8


def fit_centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Unit centres by spherical k-means; starts from spread rows of the sample."""
    rng = np.random.default_rng(7)
    centres = sample[rng.permutation(len(sample))[:cells]]
    for _ in range(TURNS):
        home = (sample @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centres)
    return centres


def deal(centres_of: dict[int, np.ndarray], threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each vector's home cell, and the cells that it visits, among those of its number of components.

    Let x be at home in o, y in c, and their cosine at least the threshold, so that their distance
    is at most d. x's margin x.(o-c) and y's margin y.(c-o) are not negative and sum to at most
    d |o-c|: one of them is at most half of that. Visiting each cell whose margin is so small
    brings every such pair together in one of its homes.
    """
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) / 2 + 1e-9

    def of_size(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
        centres = centres_of[size]
        apart = np.sqrt(np.maximum(0, 2 - 2 * (centres @ centres.T))) * reach + 1e-12
        rows = unit(matrix(batch.column(2), size))
        keys, weights = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for at in range(0, len(rows), 1_000):
            part = rows[at : at + 1_000]
            score = part @ centres.T
            home = score.argmax(1)
            near = score[np.arange(len(part)), home][:, None] - score <= apart[home]
            near[np.arange(len(part)), home] = True
            row, cell = np.nonzero(near)
            raw, visits = packed(part), [np.flatnonzero(n).astype(np.int32) for n in near]
            at_home = cell == home[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(row), size, np.int32)), pa.array(cell.astype(np.int32)), pa.array(keys[at + row]), pa.array(weights[at + row]), pa.array(home[row].astype(np.int32)), pa.array([raw[i] for i in row], pa.binary()), pa.array([visits[i] if h else None for i, h in zip(row, at_home, strict=True)], pa.list_(pa.int32()))],
                names=["size", "cell", "d", "weight", "home", "v", "visits"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            for size in np.unique(sizes).tolist():
                yield from of_size(batch.filter(pa.array(sizes == size)), size)

    return run


def compare(threshold: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Links of one block: by vector the weight of its partners and the least vector it is connected with."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        member, probe = frame[frame["member"]], frame[~frame["member"]]
        m, p, size = member["d"].to_numpy(), probe["d"].to_numpy(), int(frame["size"].iloc[0])
        if not len(m) or not len(p):
            return pd.DataFrame({"d": m[:0], "n": m[:0], "mate": m[:0]})
        link = unpack(probe["v"], size) @ unpack(member["v"], size).T >= threshold
        # a pair counts once: of one home, for the smaller vector; of two homes, here unless the
        # member also visits the probe's home and that is the smaller cell
        cell, home = int(member["home"].iloc[0]), probe["home"].to_numpy()
        link &= (home != cell)[:, None] | (p[:, None] < m[None, :])
        known = {c: i for i, c in enumerate(np.unique(home[home < cell]))}
        goes = np.zeros((len(known) + 1, len(m)), bool)
        for i, cells in enumerate(member["visits"]):
            goes[[known[c] for c in cells if c in known], i] = True
        link &= ~goes[[known.get(c, len(known)) for c in home]]
        far = np.iinfo(np.int64).max
        low_m, low_p = np.where(link.any(0), m, far), np.where(link.any(1), p, far)
        while True:
            new_m = np.minimum(low_m, np.where(link, low_p[:, None], far).min(0))
            new_p = np.minimum(low_p, np.where(link, new_m[None, :], far).min(1))
            if (new_m == low_m).all() and (new_p == low_p).all():
                break
            low_m, low_p = new_m, new_p
        out = pd.DataFrame({
            "d": np.concatenate([m, p]),
            "n": np.concatenate([probe["weight"].to_numpy() @ link, link @ member["weight"].to_numpy()]),
            "mate": np.concatenate([low_m, low_p]),
        })
        return out[out["n"] > 0]

    return run


def embedding_groups(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """One row (vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding).

    Links join vectors of cosine ``threshold`` or more, in double precision. Equal vectors are one
    node with a weight, so groups of copies cost one comparison; n_links counts the other rows.
    component_id is the smallest vec_id that links reach. Vectors that are null, zero or hold null or
    non-finite components have no link; vectors of other lengths are compared among themselves. Rows
    with a null vec_id are kept and never name a component of others. An empty table gives no rows.

    No link is lost: cells are only places to compare in, and every vector also visits the cells
    in which a partner can be (see ``deal``). The centres are fitted on a bounded sample; blocks
    have a bounded number of rows a side, whatever a cell's size.
    """
    keyed = vectors.select("vec_id", "embedding", F.when(usable("embedding", F.size("embedding")), F.md5(F.col("embedding").cast("string"))).alias("k"))
    distinct = keyed.where("k is not null").groupBy("k").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"), F.first("embedding").alias("embedding"))
    distinct = stored(stored(distinct, "vectors").withColumn("d", F.monotonically_increasing_id()), "vector-rows")
    counts = {r["size"]: r["count"] for r in distinct.groupBy(F.size("embedding").alias("size")).count().collect()}  # a row a length
    if not counts:
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    share = min(1.0, SAMPLE / sum(counts.values()))
    some = distinct.where(F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < int(share * (1 << 30))).select("embedding").toArrow()
    centres = {}
    for size, count in counts.items():
        of_size = some.filter(pc.equal(pc.list_value_length(some["embedding"]), size))["embedding"].combine_chunks()
        sample = unit(matrix(of_size, size)) if len(of_size) else np.eye(1, size)
        centres[size] = fit_centres(sample, max(1, min(MAX_CELLS, count // PER_CELL, len(sample))))
    dealt = distinct.select("d", "weight", "embedding").mapInArrow(deal(centres, threshold), "size int, cell int, d long, weight long, home int, v binary, visits array<int>")
    dealt = stored(dealt, "cells")
    # sides of a cell's blocks: homes are members, homes and visitors are probes; one row per cell
    sizes = dealt.groupBy("size", "cell").agg(F.count_if(F.col("home") == F.col("cell")).alias("homes"), F.count("*").alias("all"))
    sides = sizes.select("size", "cell", F.ceil(F.col("homes") / BLOCK).cast("int").alias("m"), F.ceil(F.col("all") / BLOCK).cast("int").alias("p")).where("m > 0")
    placed = dealt.join(F.broadcast(sides), ["size", "cell"])  # at most MAX_CELLS rows a length
    slot = lambda n: F.pmod(F.xxhash64("d"), F.col(n).cast("long")).cast("int")
    span = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    members = placed.where("home = cell").select("size", "cell", slot("m").alias("i"), F.explode(span("p")).alias("j"), "d", "weight", "home", "v", "visits", F.lit(True).alias("member"))
    probes = placed.select("size", "cell", F.explode(span("m")).alias("i"), slot("p").alias("j"), "d", "weight", "home", "v", F.lit(None).cast("array<int>").alias("visits"), F.lit(False).alias("member"))
    found = members.unionByName(probes).groupBy("size", "cell", "i", "j").applyInPandas(compare(threshold), "d long, n long, mate long")
    found = stored(found, "links")
    links = found.groupBy("d").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("d").alias("u"), F.col("mate").alias("v"))).withColumnRenamed("node", "d")
    rooted = distinct.select("d", "k", "weight", "least").join(links, "d", "left").join(roots, "d", "left").withColumn("root", F.coalesce("root", "d"))
    rooted = stored(rooted.select("k", "root", "least", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "rooted")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("name")), "root").select("k", "n_links", "name")
    component = F.coalesce("name", "vec_id")
    return keyed.select("vec_id", "k").join(named, "k", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
