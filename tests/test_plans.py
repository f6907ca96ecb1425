"""Small whole-job cases, and every registered query against its SQL twin."""

import datetime
import glob
import json
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from poifuse import schema
from poifuse.plans import refresh, seed
from poifuse.sources import readers, writers

SF = "/root/testdata/sf0.001"
REGIONS = [
    {"slug": "c", "path": "c.geojson", "prefix": "c", "iso3166_2": "DE-HE", "bbox": [8.0, 50.0, 8.2, 50.2]},
    {"slug": "d", "path": "d.geojson", "prefix": "d", "iso3166_2": "DE-HE", "bbox": [8.3, 50.0, 8.5, 50.2]},
]


def feature(region, ord_, lng, ident, name, sources, removed=None, kind=None, stamps=None, hours=None):
    return (region, ord_, lng, 50.1, ident, name, None, (None,) * 5, (hours,) if hours else None, None, None, sources, removed, kind,
            "2023-01-01", "2023-01-01", None, None, None, stamps)


def test_refresh_cases(spark):
    osm = lambda i: [("osm", i, 1)]
    existing = [
        feature("c", 0, 8.1, "tk_c_1", "Old Name", osm("node/1"), stamps={"name": "user"}),
        feature("c", 1, 8.1, "tk_c_2", "Same id again", osm("node/1")),
        feature("c", 2, 8.1, "tk_c_3", "Gone", osm("node/3")),
        feature("c", 3, 8.1, "tk_c_4", "Still there", osm("node/4")),
        feature("c", 4, 8.4, "tk_c_5", "Moved", osm("node/5")),
        feature("c", 5, 8.15, "tk_c_6", "Seed Corner", [("hopfenstop", "h", None)]),
        feature("c", 6, 8.1, "tk_c_7", "Frozen bar", osm("node/7"), kind="bar"),
        feature("c", 7, 8.1, "tk_c_8", "Fristo", osm("node/8")),
        feature("c", 8, 8.1, "tk_c_9", "Hybrid", [("osm", "node/9", 1), ("gmaps", "g", None)]),
    ]
    fresh = [
        feature("c", 0, 8.1, "tk_c_osm_n1", "New Name", osm("node/1"), stamps={"name": "osm"}),
        feature("c", 1, 8.15, "tk_c_osm_n20", "Seed Corner", osm("node/20"), stamps={"name": "osm"}),
        feature("c", 2, 8.12, "tk_c_osm_n21", "Brand new", osm("node/21"), stamps={"name": "osm"}),
        feature("c", 3, 8.4, "tk_c_osm_n22", "Elsewhere", osm("node/22"), stamps={"name": "osm"}),
    ]
    regions = readers.regions_table(spark, REGIONS)
    still = spark.createDataFrame([("c", "node/4")], "region string, osm_id string")
    failed = spark.createDataFrame([("c", "bar")], "region string, query_group string")
    tables = [spark.createDataFrame(rows, schema.FEATURE_DDL) for rows in (existing, fresh)]
    result = refresh.refresh_snapshot(*tables, regions, still, failed)
    rows = {r["id"]: r for r in result.features.collect()}
    assert set(rows) == {"tk_c_osm_n1", "tk_c_3", "tk_c_4", "tk_c_6", "tk_c_7", "tk_c_osm_n21", "tk_c_9"}
    assert rows["tk_c_osm_n1"]["name"] == "Old Name" and rows["tk_c_osm_n1"]["payment"] is not None
    assert rows["tk_c_3"]["osm_removed"] and not rows["tk_c_4"]["osm_removed"] and not rows["tk_c_7"]["osm_removed"]
    assert [s["id"] for s in rows["tk_c_6"]["sources"]] == ["h", "node/20"]
    assert not rows["tk_c_9"]["osm_removed"]
    counters = {r["region"]: r for r in result.counters().collect()}["c"]
    expected = {"added": 1, "updated": 1, "removed": 1, "kept_non_osm": 1, "linked_non_osm": 1, "cross_region_dropped": 2, "dropped_market": 1, "suppressed_dup": 0}
    assert {k: counters[k] for k in expected} == expected


def test_refresh_twice_is_stable(spark):
    fresh = [feature("c", 0, 8.1, "tk_c_osm_n1", "One", [("osm", "node/1", 1)], stamps={"name": "osm"})]
    regions = readers.regions_table(spark, REGIONS)
    none = spark.createDataFrame([], "region string, osm_id string"), spark.createDataFrame([], "region string, query_group string")
    new = spark.createDataFrame(fresh, schema.FEATURE_DDL)
    once = refresh.refresh_snapshot(new, new, regions, *none).features
    twice = refresh.refresh_snapshot(once, new, regions, *none).features
    assert [tuple(r) for r in once.collect()] == [tuple(r) for r in twice.collect()]


def test_seed_import(spark):
    vocab = spark.createDataFrame([("bier", "Bier", "g", 0), ("draussen", "Draußen", "g", 1)], "slug string, de string, `group` string, ord int")
    record = lambda i, lat: (i, f"h{i}", "Name", "", ("Weg", " 1 ", "Ort", "123", None, lat, "8.5"), None, [("Bier", (3,)), ("Draußen", None), ("Eis", (1,)), ("Bier", (-1,))])
    df = spark.createDataFrame([record(1, "50.1"), record(2, "x"), record(3, "50.2")], "ord bigint, " + schema.SEED_DDL)
    rows = seed.import_seed(df, vocab, "c", "2024-01-01").orderBy("ord").collect()
    assert [r["id"] for r in rows] == ["tk_fr_0001", "tk_fr_0003"]
    assert rows[0]["tags"] == ["bier", "draussen"] and rows[0]["address"]["number"] == "1" and rows[0]["address"]["postalcode"] is None


def test_files_round_trip(spark, tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()
    rows = [feature("c", i, 8.1, f"tk_c_{i}", f"N {i}", [("osm", f"node/{i}", 1)], stamps={"name": "osm"}, hours="24/7") for i in range(3)]
    df = spark.createDataFrame(rows, schema.FEATURE_DDL)
    document = writers.collections(df).collect()[0]["value"]
    (folder / "c.geojson").write_text(document)
    (folder / "_rest.geojson").write_text(document)
    back = readers.read_features(spark, str(folder))
    assert back.count() == 6 and {r["region"] for r in back.select("region").collect()} == {"c.geojson", "_rest.geojson"}
    assert back.filter("region = 'c.geojson'").select("sources_by_field").collect()[0][0] == {"name": "osm"}
    writers.write_features(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    review = spark.createDataFrame([("c", "f", 'a "b", c', "node/1", "n", 0.501, 3.46, 0.207)], readers.REVIEW_DDL)
    writers.write_match_review(review, str(tmp_path / "review"))
    again = readers.read_review(spark, str(tmp_path / "review")).collect()[0]
    assert (again["feature_name"], again["score"], again["distance_m"]) == ('a "b", c', 0.5, 3.5)


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5)
    if value.__class__.__name__ == "Decimal":
        return round(float(value), 5)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_sql_twin(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table(columns, cursor.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_a_region_is_one_document_over_many_files(spark, tmp_path):
    rows = [feature("a" if i % 3 else "b", i, 8.0 + i / 100, f"tk_a_{i:02d}", f"N {i}", [("osm", f"node/{i}", 1)]) for i in range(30)]
    df = spark.createDataFrame(rows, schema.FEATURE_DDL)
    path = tmp_path / "out"
    writers.write_collections(df, str(path))
    for region in "ab":
        files = sorted(p for p in (path / f"region={region}").iterdir() if p.name.startswith("part-"))
        document = json.loads("".join(p.read_text() for p in files))
        ids = [f["properties"]["id"] for f in document["features"]]
        assert ids == sorted(r[4] for r in rows if r[0] == region)
