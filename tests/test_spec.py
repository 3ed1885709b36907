import json

import pytest
from pyspark.sql import types as T

from tidemark.spec import load_schema, load_spec, load_specs, schema_of


def test_every_table_is_configured():
    specs = load_specs()
    assert set(specs) == {
        "customers", "suppliers", "products", "orders", "order_items", "shipments", "orders_v2"
    }
    for spec in specs.values():
        assert spec.primary_key[0] in spec.columns
        assert {"change_ts", "op"} <= set(spec.columns)
        assert all(spec.schema[c].nullable for c in spec.columns)
    assert specs["order_items"].schema["quantity"].dataType == T.IntegerType()
    assert specs["orders"].topic == "orders_cdc"
    assert specs["orders_v2"].mode == "patch"


def test_all_types():
    kinds = ["string", "double", "integer", "long", "boolean", "date", "timestamp", "decimal(18,2)"]
    schema = schema_of({f"c{i}": k for i, k in enumerate(kinds)})
    assert schema["c7"].dataType == T.DecimalType(18, 2)
    assert [f.dataType.simpleString() for f in schema.fields][2:4] == ["int", "bigint"]


def test_unknown_type_is_rejected():
    with pytest.raises(ValueError, match="unknown column type 'money'"):
        schema_of({"a": "money"})


def test_bare_array_file(tmp_path):
    path = tmp_path / "t.json"
    path.write_text(json.dumps([{"name": "a", "type": "string"}, {"name": "b", "type": "integer", "nullable": False}]))
    schema = load_schema(path)
    assert schema["a"].nullable and not schema["b"].nullable


def test_new_source_needs_only_a_file(tmp_path):
    (tmp_path / "returns.json").write_text(
        json.dumps({"primary_key": ["return_id"], "columns": {"return_id": "string", "change_ts": "string", "op": "string"}})
    )
    assert load_spec("returns", tmp_path).topic == "returns_cdc"
    with pytest.raises(ValueError, match="no config"):
        load_spec("nothing", tmp_path)
