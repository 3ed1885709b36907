import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import conform_id, key_id, key_op, key_partition, message_key, padded_id
from tidemark.functions.parse import CORRUPT, EXTRA, decode, instant, partition_day
from tidemark.operators.ingest import to_raw
from tidemark.sources.files import RECORD_SCHEMA
from tidemark.spec import load_spec, schema_of

SCHEMA = schema_of({"id": "string", "q": "integer", "p": "double"})


def records(spark, texts):
    data = [
        (b"k", None if t is None else bytearray(t.encode()), "t", 0, i, dt.datetime(2025, 1, 1), 0)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(data, RECORD_SCHEMA)


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"id":"a"}', ("a", None, None)),
        ('{"id":"a","zz":1}', ("a", None, None)),
        ('{"id":"a","q":"x","p":1.5}', ("a", None, 1.5)),
        ('{"id":"a","q":2.5}', ("a", None, None)),
        ('{"id":"a","q":99999999999}', ("a", None, None)),
        ('{"id":"a","p":"3.5"}', ("a", None, None)),
        ('{"id":5}', ("5", None, None)),
        ('{"id":{"k":1}}', ('{"k":1}', None, None)),
        ("not json", (None, None, None)),
        ('{"id":"a","q":1', (None, None, None)),
        ("[1,2]", (None, None, None)),
        ("null", (None, None, None)),
        ("", (None, None, None)),
        (None, (None, None, None)),
        ('{"ID":"a"}', (None, None, None)),
        ('{"id":"a","id":"b"}', ("b", None, None)),
        ("{'id':'a'}", ("a", None, None)),
        ('{"id":"a","q":null}', ("a", None, None)),
    ],
)
def test_permissive_parse(spark, text, expected):
    assert tuple(decode(records(spark, [text]), SCHEMA).first()) == expected


def test_corrupt_text_is_kept(spark, rows):
    texts = ['{"id":"a"}', "junk", '{"id":"b","q":"x"}', None]
    got = decode(records(spark, texts), SCHEMA, corrupt=True, lineage=True)
    assert rows(got, "kafka_offset", "id", CORRUPT) == sorted(
        [(0, "a", None), (1, None, "junk"), (2, "b", '{"id":"b","q":"x"}'), (3, None, None)], key=repr
    )


def test_unknown_fields_are_kept(spark):
    got = decode(records(spark, ['{"id":"a","x":1,"y":"z"}']), SCHEMA, extra=True).first()
    assert got[EXTRA] == {"x": "1", "y": "z"}


@pytest.mark.parametrize(
    "text, day",
    [
        ("2025-01-01T23:30:00-05:00", dt.date(2025, 1, 1)),
        ("2025-01-01T10:00:00.5", dt.date(2025, 1, 1)),
        ("2025-1-5", dt.date(2025, 1, 5)),
        (" 2025-02 ", dt.date(2025, 2, 1)),
        ("2025", dt.date(2025, 1, 1)),
        ("garbage", dt.date(1900, 1, 1)),
        ("", dt.date(1900, 1, 1)),
        ("2025-13-45", dt.date(1900, 1, 1)),
        (None, dt.date(1900, 1, 1)),
    ],
)
def test_partition_day(spark, text, day):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(partition_day("t")).first()[0] == day


def test_instant_reads_both_spellings(spark):
    df = spark.createDataFrame([("2025-01-01T00:00:01",), ("2025-01-01T00:00:01+00:00",), ("x",)], "t string")
    got = [r[0] for r in df.select(instant("t").cast("timestamp_ntz")).collect()]
    assert got == [dt.datetime(2025, 1, 1, 0, 0, 1)] * 2 + [None]


def test_second_order_shape(spark):
    text = '{"op":"U","change_ts":"2025-01-01T00:00:01+00:00","order_id":"a","total_amount":11.0}'
    got = to_raw(records(spark, [text]), load_spec("orders_v2")).first()
    assert got["partition_date"] == dt.date(1900, 1, 1) and got["order_date_parsed"] is None
    assert got["ingestion_ts"] is not None
    generic = to_raw(records(spark, [text]), load_spec("orders")).first()
    assert generic["partition_date"] == dt.date(2025, 1, 1)


def test_smoke_message_lands_in_the_fallback(spark):
    got = to_raw(records(spark, ['{"test":"hello"}']), load_spec("orders")).first()
    assert got["partition_date"] == dt.date(1900, 1, 1) and got["order_id"] is None


def test_keys(spark):
    df = spark.createDataFrame([("I", "a_b", "CUST0007", 7), ("D", "x", "none", 123456)], "op string, id string, c string, n int")
    got = df.select(
        message_key(F.col("op"), F.col("id")).alias("k"),
        conform_id(F.col("c"), "CUST", 5),
        padded_id("CUST", F.col("n"), 5),
    ).withColumn("o", key_op(F.col("k"))).withColumn("i", key_id(F.col("k")))
    assert [tuple(r) for r in got.collect()] == [
        ("I_a_b", "CUST00007", "CUST00007", "I", "a_b"),
        ("D_x", "none", "CUST123456", "D", "x"),
    ]


def test_partition_depends_on_the_id_alone(spark):
    df = spark.range(1000).select(key_partition(F.col("id"), 3).alias("p"), "id")
    assert {r[0] for r in df.select("p").distinct().collect()} == {0, 1, 2}
