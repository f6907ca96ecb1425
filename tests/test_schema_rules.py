"""Raw features against the schema, and the import that stops on a broken one."""

import json

import pytest
from pyspark.sql import functions as F

from poifuse import schema
from poifuse.catalog import schema_queries
from poifuse.operators import linking, schema_rules
from poifuse.plans import seed


def rules(spark, rows):
    raw = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "k int, value string, doc string")
    out = {i: [] for i in range(len(rows))}
    for r in schema_rules.raw_violations(raw).collect():
        assert r["doc"] == "x"
        out[r["k"]].append(r["rule"])
    return [sorted(out[i]) for i in range(len(rows))]


def test_every_rule_is_broken_once(spark):
    changes = schema_queries.CHANGES
    got = rules(spark, [json.dumps(schema_queries.changed(path, value)) for path, value, _ in changes])
    assert got == [sorted(expected) for _, _, expected in changes]
    names = {rule for _, _, expected in changes for rule in expected}
    assert len(names) > 70


def test_several_rules_and_odd_texts(spark):
    many = schema_queries.changed("properties.tags", ["A", 1, "b", "b"])
    many["properties"]["payment"] = {"cash": "maybe", "gold": 1}
    got = rules(spark, [json.dumps(many), None, "", "[]", "null", '"text"', "{}"])
    assert got[0] == ["properties.payment undeclared gold", "properties.payment.cash value", "properties.tags items", "properties.tags pattern", "properties.tags unique"]
    assert got[1] == got[2] == ["json"] and got[3] == got[4] == got[5] == ["type"]
    assert got[6] == ["geometry required", "properties required", "type required"]


def seed_rows(spark, names):
    rows = [(f"h{i}", n, None, {"street": "S", "number": "1", "city": "C", "postalcode": "60311", "district": None, "geolat": "50.1", "geolng": "8.6"}, None, None, i) for i, n in enumerate(names, 1)]
    return spark.createDataFrame(rows, schema.SEED_DDL + ", ord bigint")


def test_import_stops_on_a_broken_feature(spark):
    vocab = spark.createDataFrame([("bier", "Bier", 0)], "slug string, de string, ord int")
    assert seed.checked_import(seed_rows(spark, ["a", "b"]), vocab, "fr", "2024-01-01").count() == 2
    with pytest.raises(schema_rules.SchemaError, match="properties.name length"):
        seed.checked_import(seed_rows(spark, ["a", "n" * 201]), vocab, "fr", "2024-01-01")
    with pytest.raises(schema_rules.SchemaError, match="properties.created date"):
        seed.checked_import(seed_rows(spark, ["a"]), vocab, "fr", "1 May")


def test_results_by_feature(spark):
    rows = spark.createDataFrame([("a", 2, "p2"), ("a", 0, None), ("a", 1, "p1"), ("b", 0, "p0"), (None, 0, "x"), ("", 1, "y")], "feature_id string, ord int, place_id string")
    got = {r["feature_id"]: [x["place_id"] for x in r["results"]] for r in linking.results_by_feature(rows, ["place_id"]).collect()}
    assert got == {"a": [None, "p1", "p2"], "b": ["p0"]}
