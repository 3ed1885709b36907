"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import beside_text, components, stored

SEED = 42
BLOCK = 65_536  # shingles whose bits are counted at once


def fingerprint(text: str | None, width: int = 3) -> int:
    """Signed 64-bit SimHash over word shingles of ``width``; 0 for a text without words.

    A-Z is lower-cased, words end at ASCII white space, repeated shingles count each time, a text of
    fewer words is one shingle. A bit is 1 if more than half of the shingles' XXH64 have it.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(width, len(words)) - 1
    firsts, lasts = starts[: len(words) - span].tolist(), ends[span:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(firsts), BLOCK):
        hashes = np.fromiter((digest(whole[a:b], SEED) for a, b in zip(firsts[at : at + BLOCK], lasts[at : at + BLOCK], strict=True)), ">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(firsts)).view(">i8")[0])


def fingerprints(docs: DataFrame, width: int = 3, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` and fp of each row of ``docs`` (doc_id, text); null text counts as empty."""
    frame, place, schema = beside_text(docs, columns, "fp long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(text.as_py(), width) for text in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(fps, pa.int64())], names=[*columns, "fp"])

    return frame.mapInArrow(run, schema)


def near_pairs(fps: DataFrame, radius: int = 2) -> DataFrame:
    """(u, v): links that join all distinct fingerprints ``fp`` differing in at most ``radius`` bits.

    Every fingerprint emits all variants within half the radius. Two within the radius meet in a
    variant, and those that meet in one are within the radius of each other, so each is joined to
    the least of its variant. A variant has at most as many distinct fingerprints as its own
    ball has points (65 for radius 2): no group is larger, whatever the number of copies.
    Verified pairs only; pairs with a smaller common partner may be given through it.
    """
    if radius not in (0, 2):
        raise ValueError("radius 0 or 2: balls of half the radius meet only for even radii")
    ball = F.array("fp")
    if radius:
        ball = F.concat(ball, F.expr("transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))"))
    variants = fps.select("fp", F.explode(ball).alias("variant"))
    groups = variants.groupBy("variant").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1")
    pairs = groups.select(F.array_min("fps").alias("v"), F.explode("fps").alias("u")).where("u <> v").distinct()
    return pairs.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)


def rooted(fps: DataFrame, radius: int = 2) -> DataFrame:
    """(fp, root, first_id): of each fingerprint in ``fps`` (doc_id, fp) its component's name and its smallest doc_id."""
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    roots = components(near_pairs(nodes, radius)).withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def simhash_groups(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """One row (doc_id, fingerprint, component_id) per row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links of at most ``radius`` differing bits reach.
    Copies of a fingerprint are one node, so hot groups cost one row; texts without words share
    fingerprint zero. Null doc_ids are kept and get component null only if no copy has an id.
    Repeated rows stay repeated; an empty table gives no rows; further columns are ignored.
    """
    fps = stored(fingerprints(docs, width), "simhash")
    nodes = rooted(fps, radius)
    least = nodes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = nodes.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def simhash_survivors(docs: DataFrame, columns: tuple[str, ...], width: int = 3, radius: int = 2) -> DataFrame:
    """One whole row of each component: that of the smallest doc_id, then of the least digest of the row.

    Rows without an id come last; rows alike in all ``columns`` are one. Ids need not be unique.
    """
    mark = F.md5(F.to_json(F.struct(*[F.md5("text").alias("text") if c == "text" else F.col(c) for c in columns])))
    marked = docs.select(*columns, mark.alias("mark"))
    fps = stored(fingerprints(marked, width, ("doc_id", "mark")), "simhash")
    least = fps.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("first"))
    first = least.join(rooted(fps, radius).select("fp", "root"), "fp").groupBy("root").agg(F.min("first").alias("first"))
    first = first.select("first.mark")
    # rows without an id may be copies of each other in any number: these are merged before they are shuffled
    nameless = marked.where("doc_id is null").dropDuplicates(["mark"])
    return marked.where("doc_id is not null").unionByName(nameless).join(first, "mark", "left_semi").dropDuplicates(["mark"]).select(*columns)
