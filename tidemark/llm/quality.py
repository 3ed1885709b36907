"""Quality classifier by compression: zstandard dictionaries of good and of bad text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.calibration import fit_logistic, logistic
from tidemark.llm.common import beside_text, labelled_sample, stored

BLOCK = 512  # bytes compressed at once: long texts would otherwise teach the compressor themselves
LEVEL = 3
DICTIONARY = 65_536  # bytes
DOCUMENTS = 3_000  # labelled documents of a class, at most about; half for dictionaries, half for calibration
BLOCKS = 8_000  # blocks of a class that a dictionary is trained on
FEATURES = 6


def blocks(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return [raw[i : i + BLOCK] for i in range(0, max(1, len(raw)), BLOCK)]


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples to train on, their own last bytes."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


class Compressors:
    """Sizes of a text by the good and by the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = (zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False) for d in (good, bad))

    def features(self, text: str) -> tuple[float, ...]:
        """Normalised size difference by raw and by compressed size, compression ratio and their products."""
        parts = blocks(text)
        good = sum(len(self.good.compress(p)) for p in parts)
        bad = sum(len(self.bad.compress(p)) for p in parts)
        raw = max(1, sum(map(len, parts)))
        ratio, gain = (good + bad) / 2 / raw, (bad - good) / raw
        return gain, (bad - good) / (bad + good), ratio, ratio * ratio, raw**-0.5, gain * good / raw


def quality_scores(docs: DataFrame, labels: DataFrame, columns: tuple[str, ...] = ("doc_id",), null_unfitted: bool = False) -> DataFrame:
    """``columns`` and score per row of ``docs`` (doc_id, text): how likely its label is 1.

    ``labels`` (doc_id, label) are the rows to learn from, 0 or 1; others and nulls are ignored, a
    document labelled both ways counts as 0. At most about ``DOCUMENTS`` of a class are used, by a
    hash of doc_id. Half of them give a dictionary for each class; on the rest a logistic
    regression calibrates the difference of the compressed sizes, weighted to the classes' shares
    of all labels. Every whole text is scored block by block, null as empty; rows stay as they are,
    repeated or with a null id. If no model can be fitted because a part of the sample lacks a class,
    every score is the share of label 1 among the labels, 0.5 without any, or null with
    ``null_unfitted``.
    """
    sample, share = labelled_sample(docs, labels, DOCUMENTS)
    sample = stored(sample, "labelled")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(label, part) for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for part in blocks(text or "") if part]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["label", "part"])

    parts = stored(sample.where(half).select("label", "text").mapInArrow(cut, "label int, part binary"), "blocks")
    dictionaries = {}
    for label in (0, 1):
        of = parts.where(F.col("label") == label)
        found = [bytes(r.part) for r in of.orderBy(F.xxhash64("part"), "part").limit(BLOCKS).collect()]
        dictionaries[label] = build_dictionary(found) if found else b""
    model = None
    if dictionaries[0] and dictionaries[1]:
        rows = sample.where(~half).select("label", "text").mapInArrow(featurizer(dictionaries), "label int, x array<double>").collect()
        y = np.array([r.label for r in rows], float)
        if len(set(y)) == 2:
            weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
            model = fit_logistic(np.array([r.x for r in rows]), y, weight)

    frame, place, schema = beside_text(docs, columns, "score double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Compressors(dictionaries[1], dictionaries[0]) if model else None
        for batch in batches:
            if model:
                x = np.array([sizes.features(t.as_py() or "") for t in batch.column(place)]).reshape(-1, FEATURES)
                found = logistic(model, x)
            else:
                found = [None if null_unfitted else share] * batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(found, pa.float64())], names=[*columns, "score"])

    return frame.mapInArrow(score, schema)


def featurizer(dictionaries: dict[int, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Compressors(dictionaries[1], dictionaries[0])
        for batch in batches:
            x = [sizes.features(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    return run
