"""From broker records to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
EXTRA = "_extra"
LINEAGE = {
    "key": "kafka_key",
    "topic": "kafka_topic",
    "partition": "kafka_partition",
    "offset": "kafka_offset",
    "timestamp": "kafka_timestamp",
}
LINEAGE_FIELDS = [
    T.StructField("kafka_key", T.StringType()),
    T.StructField("kafka_topic", T.StringType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_timestamp", T.TimestampType()),
]
# Fixed value: where rows without a usable date land.
FALLBACK_DATE = "1900-01-01"


def message_text() -> Column:
    return F.col("value").cast("string")


def json_payload(text: Column, schema: T.StructType, corrupt: bool = False) -> Column:
    """Permissive parse; ``corrupt`` adds the whole text of messages that do not fit."""
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def extra_fields(text: Column, known: list[str]) -> Column:
    """Keys of the message that the schema lacks, as ``map<string,string>``."""
    parsed = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
    return F.map_filter(parsed, lambda k, _: ~k.isin(known))


def decode(
    records: DataFrame,
    schema: T.StructType,
    *,
    lineage: bool = False,
    corrupt: bool = False,
    extra: bool = False,
) -> DataFrame:
    """Parse ``value`` into columns, optionally beside the broker coordinates."""
    kept = []
    if lineage:
        casts = {"key": F.col("key").cast("string")}
        kept = [casts.get(source, F.col(source)).alias(name) for source, name in LINEAGE.items()]
    if extra:
        kept.append(extra_fields(message_text(), schema.fieldNames()).alias(EXTRA))
    payload = json_payload(message_text(), schema, corrupt).alias("data")
    parsed = records.select(payload, *kept)
    rest = [c for c in parsed.columns if c != "data"]
    return parsed.select("data.*", *rest)


def partition_day(source: str | Column) -> Column:
    """Literal date part of ISO text, or the fallback day."""
    text = F.col(source) if isinstance(source, str) else source
    return F.coalesce(F.try_to_date(text.cast("string")), F.lit(FALLBACK_DATE).cast("date"))


def is_fallback(day: str = "partition_date") -> Column:
    return F.col(day) == F.lit(FALLBACK_DATE).cast("date")


def instant(source: str | Column) -> Column:
    """ISO text, naive UTC or with offset, as a timestamp; null when unusable."""
    return F.try_to_timestamp(F.col(source) if isinstance(source, str) else source)
