import pytest
from pyspark.sql import functions as F

from tidemark.functions.parse import CORRUPT
from tidemark.operators import quality
from tidemark.operators.skew import profile
from tidemark.spec import load_spec, load_specs


def failures(df, rules, **kw):
    got = quality.evaluate(df, rules, **kw)
    return [set(r[quality.FAILED]) for r in got.orderBy(df.columns[0]).collect()]


def test_row_rules(spark):
    df = spark.createDataFrame(
        [
            (1, "I", "CUST00001", "INR", 500.0, 2, 250.0, "2025-01-03", "2025-01-01T10:00:00"),
            (2, "X", "C1", "USD", 5.0, 2, 250.0, "2025-01-10", "2025-01-01"),
            (3, "I", None, None, None, 3, 1.0, "soon", None),
            (4, "U", None, None, None, None, None, None, None),
        ],
        "n int, op string, customer_id string, currency string, amount double, quantity int, price double, due string, change_ts string",
    )
    rules = [
        {"id": "op", "type": "domain", "column": "op", "values": ["I", "U", "D"]},
        {"id": "present", "type": "not_null", "column": "customer_id"},
        {"id": "format", "type": "pattern", "column": "customer_id", "regex": r"^CUST\d{5}$"},
        {"id": "currency", "type": "domain", "column": "currency", "values": ["INR"]},
        {"id": "range", "type": "range", "column": "amount", "min": 100, "max": 100000},
        {"id": "product", "type": "product", "column": "amount", "factors": ["quantity", "price"], "tolerance": 0.01},
        {"id": "window", "type": "days_between", "column": "due", "from": "change_ts", "min": 1, "max": 7},
        {"id": "date", "type": "parseable", "column": "due"},
        {"id": "complete", "type": "required_on", "op": "I", "columns": ["customer_id", "amount"]},
    ]
    assert failures(df, rules) == [
        set(),
        {"op", "format", "currency", "range", "product", "window"},
        {"present", "date", "complete"},
        {"present"},
    ]


def test_malformed_rows_are_quarantined(spark, rows):
    df = spark.createDataFrame([("a", None), (None, "junk")], f"id string, {CORRUPT} string")
    rules = [{"id": "well_formed", "type": "well_formed"}]
    checked = quality.evaluate(df, rules)
    assert rows(quality.quarantined(checked), CORRUPT) == [("junk",)]
    assert rows(quality.trusted(checked), "id") == [("a",)]


@pytest.mark.parametrize("skewed", [True, False])
def test_rules_across_rows(spark, skewed):
    df = spark.createDataFrame([(i, "dup" if i < 40 else f"u{i}", "p1" if i % 2 else "gone") for i in range(60)] + [(60, "x", None)], "n int, k string, parent string")
    parent = spark.createDataFrame([("p1",), ("p1",)], "id string")
    rules = [
        {"id": "unique", "type": "unique", "columns": ["k"], "severity": "warn"},
        {"id": "exists", "type": "referential", "column": "parent", "parent": "parents", "parent_column": "id"},
    ]
    skew = profile(df, ["k"]) if skewed else None
    got = failures(df, rules, parents={"parents": parent}, skew=skew)
    assert len(got) == 61
    assert got == [({"unique"} if i < 40 else set()) | (set() if i % 2 or i == 60 else {"exists"}) for i in range(61)]


def test_severity_and_scorecard(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, 50), (3, None), (4, 500)], "n int, v int")
    rules = [
        {"id": "high", "type": "range", "column": "v", "min": 0, "max": 100, "severity": "error"},
        {"id": "low", "type": "range", "column": "v", "min": 10, "max": 1000, "severity": "warn"},
    ]
    checked = quality.evaluate(df, rules)
    assert rows(quality.quarantined(checked), "n") == [(4,)]
    flagged = quality.trusted(checked).filter(F.size(quality.FAILED) > 0)
    assert rows(flagged, "n") == [(1,)]
    assert rows(quality.scorecard(checked, rules), "rule_id", "checked", "failed", "pass_rate") == [
        ("high", 4, 1, 0.75), ("low", 4, 1, 0.75),
    ]


def test_threshold():
    quality.enforce(100, 5, 0.05)
    quality.enforce(0, 0, 0.0)
    with pytest.raises(quality.QualityThresholdExceeded):
        quality.enforce(100, 6, 0.05)


def test_bad_rules_are_rejected():
    for rule, message in [
        ({"id": "a", "type": "magic"}, "unknown type"),
        ({"id": "a", "type": "not_null", "column": "zz"}, "no column zz"),
        ({"id": "a", "type": "not_null", "column": "n", "severity": "fatal"}, "severity"),
    ]:
        with pytest.raises(ValueError, match=message):
            quality.check([rule], ["n"])
    with pytest.raises(ValueError, match="defined twice"):
        quality.check([{"id": "a", "type": "not_null", "column": "n"}] * 2, ["n"])


def test_configured_rules_fit_their_tables(spark):
    for spec in load_specs().values():
        quality.check(list(spec.rules), [*spec.columns, CORRUPT])


def test_configured_rules_accept_what_producers_send(spark):
    spec = load_spec("shipments")
    df = spark.createDataFrame(
        [("0A1B2C3D-4", "AB12CD34", "FedEx", "SHIPPED", "2025-01-04", "2025-01-01T10:00:00.5", "I", None)],
        "shipment_id string, order_id string, carrier string, status string, expected_delivery string, change_ts string, op string, _corrupt_record string",
    )
    orders = spark.createDataFrame([("AB12CD34",)], "order_id string")
    assert failures(df, list(spec.rules), parents={"orders": orders}) == [set()]
