"""Answers that are missing, ids that repeat, elements that are listed twice."""

from pyspark.sql import functions as F
from test_plans import REGIONS, feature

from poifuse import schema
from poifuse.operators import linking
from poifuse.plans import backfill, enrich, refresh
from poifuse.sources import readers

ELEMENT = "type string, id bigint, version int, lat double, lon double, center struct<lat:double,lon:double>, tags map<string,string>, region string, query_group string, mirror int, ord int"
KIOSK = {"shop": "kiosk", "name": "K"}


def element(region, number, lng, group="kiosk", tags=KIOSK):
    return ("node", number, 1, 50.1, lng, None, tags, region, group, 0, number or 0)


def refreshed(spark, existing, elements, lookup=(), **extra):
    tables = spark.createDataFrame(existing, schema.FEATURE_DDL), spark.createDataFrame(elements, ELEMENT)
    found = spark.createDataFrame(list(lookup), ELEMENT)
    out = refresh.refresh_from_answers(*tables, readers.regions_table(spark, REGIONS), found, "2024-01-01", **extra)
    return {(r["region"], r["id"]): r for r in out.features.collect()}


def test_groups_without_any_answer_keep_their_rows(spark):
    osm = lambda i: [("osm", f"node/{i}", 1)]
    c = [feature("c", i, 8.1 + i / 1000, f"tk_c_{i}", f"C {i}", osm(i)) for i in range(12)]
    d = [feature("d", i, 8.4 + i / 1000, f"tk_d_{i}", f"D {i}", osm(100 + i)) for i in range(12)]
    bar = [feature("c", 20, 8.15, "tk_c_bar", "Bar", osm(50), kind="bar")]
    answers = [element("c", i, 8.1 + i / 1000) for i in range(11)]  # one kiosk is gone; d and the bars of c never answered
    rows = refreshed(spark, c + d + bar, answers)
    assert rows["c", "tk_c_11"]["osm_removed"] is True
    assert not any(r["osm_removed"] for (region, _), r in rows.items() if region == "d")
    assert sum(region == "d" for region, _ in rows) == 12
    assert not rows["c", "tk_c_bar"]["osm_removed"]


def test_empty_answer_counts_as_an_answer(spark):
    few = [feature("c", i, 8.1, f"tk_c_{i}", f"C {i}", [("osm", f"node/{i}", 1)]) for i in range(2)]
    rows = refreshed(spark, few, [("node", None, 1, None, None, None, None, "c", "kiosk", 0, 0)])
    assert all(r["osm_removed"] for r in rows.values())


def test_failed_lookup_freezes_the_region(spark):
    rows = [feature("c", i, 8.1, f"tk_c_{i}", f"C {i}", [("osm", f"node/{i}", 1)]) for i in range(12)]
    lost = spark.createDataFrame([("c",)], "region string")
    out = refreshed(spark, rows, [element("c", i, 8.1) for i in range(11)], lookup_failed=lost)
    assert len(out) == 12 and not any(r["osm_removed"] for r in out.values())


def repeated(spark):
    seed = [("hopfenstop", "h", None)]
    rows = [feature("c", 0, 8.1, "same", "Corner", seed), feature("c", 1, 8.1, "same", "Corner", seed), feature("d", 0, 8.4, "same", "Corner", seed), feature("c", 2, 8.2, "other", "Else", seed)]
    return spark.createDataFrame(rows, schema.FEATURE_DDL)


def keys(df):
    return sorted((r["region"], r["ord"], r["id"]) for r in df.collect())


def test_enrichment_keeps_one_row_per_row(spark):
    f = repeated(spark)
    ids = spark.createDataFrame([("same",), ("other",)], "feature_id string")
    places = f.select(F.col("id").alias("feature_id"), "ord", "lng", "lat", F.concat(F.lit("p"), "region", F.col("ord")).alias("place_id"))
    one = enrich.resolve_place_ids(f, places, ids, "2024-01-01")
    assert keys(one) == keys(f)
    pages = one.select(F.explode(F.array(F.lit("pc0"), F.lit("pc0"), F.lit("pd0"))).alias("place_id"), F.lit("<html></html>").alias("html"))
    two = enrich.apply_place_pages(one, pages, "2024-01-01")
    assert keys(two) == keys(f)
    results = f.select(F.col("id").alias("feature_id"), "ord", "lng", "lat", F.lit("g").alias("place_id"), F.lit(None).cast("string").alias("cid"),
                       F.from_json(F.lit("[]"), schema.ABOUT_DDL).alias("about"), F.create_map(F.lit("Montag"), F.array(F.lit("07:00–22:00"))).alias("open_hours"))
    three = enrich.apply_search_results(two, results, ids, "2024-01-01")
    assert keys(three) == keys(f) and {r["google_attempted"] for r in three.collect()} == {"2024-01-01"}
    only_d = enrich.resolve_place_ids(f, places, spark.createDataFrame([("d", "same")], "region string, feature_id string"), "2024-01-01")
    assert sorted(r["region"] for r in only_d.collect() if len(r["sources"]) > 1) == ["d"]


def test_backfill_with_repeated_ids_and_elements(spark):
    f = repeated(spark)
    tags = {"name": "Corner", "opening_hours": "24/7"}
    twice = [("node", 1, 2, 8.1, 50.1, tags)] * 2 + [("node", 2, 2, 8.4, 50.1, tags)]
    elements = spark.createDataFrame(twice, "type string, id bigint, version int, lng double, lat double, tags map<string,string>")
    hits = f.select(F.col("id").alias("feature_id"), F.lit(0).alias("ord"), "lng", "lat", F.lit("Weg").alias("street"), F.lit("7").alias("housenumber"),
                    F.lit("1").alias("postcode"), F.lit("O").alias("city"), F.lit("D").alias("district"), F.lit("Germany").alias("country"))
    out = backfill.backfill_from_map(f, elements, hits.union(hits), "2024-01-01")
    assert keys(out.features) == keys(f)
    assert sum(len(r["sources"]) == 2 for r in out.features.collect()) == 3
    assert backfill.geocode_counters(f, hits).collect()[0]["matched"] == 4


def test_review_of_repeated_ids_and_failed_searches(spark):
    f = repeated(spark)
    review = spark.createDataFrame([("c", "same", "Corner", "node/1", "Corner", 0.5, 1.0, 0.5), ("c", "other", "Else", "node/2", "Else", 0.5, 1.0, 0.5)], readers.REVIEW_DDL)
    results = spark.createDataFrame([("c", "same", 50.1, 8.1)], "region string, feature_id string, lat double, lng double")
    failed = spark.createDataFrame([("c", "other")], "region string, feature_id string")
    rows = {r["feature_id"]: r for r in linking.confirm_review(review, f, results, failed).collect()}
    assert len(rows) == 2 and rows["same"]["outcome"] == "confirmed"
    assert (rows["other"]["outcome"], rows["other"]["detail"]) == ("error", "search failed")


def test_shadowing_stays_in_the_region(spark):
    ddl = "region string, ord int, id string, name string, lng double, lat double"
    fresh = spark.createDataFrame([("c", 0, "x", "Corner", 8.1, 50.1), ("d", 0, "x", "Corner", 8.1, 50.1)], ddl)
    existing = spark.createDataFrame([("c", 0, "e", "Corner", 8.1, 50.1)], ddl)
    assert [r["region"] for r in linking.without_near_duplicates(fresh, existing).collect()] == ["d"]


def test_region_list_in_yaml(spark, tmp_path):
    text = '# head\nregions:\n  - slug: a\n    path: data/a.geojson\n    prefix: "a1"   # why\n    iso3166_2: DE-HE\n    admin_level: 6\n    bbox: [7.5, 49.0, -9, 50.25]\n\n  - slug: b\n    path: b\n    prefix: b\n    iso3166_2: ES-MD\n    bbox: [1, 2, 3, 4]\n    role: rest\n    bbox_clip: true\n'
    (tmp_path / "regions.yml").write_text(text)
    a, b = readers.read_regions(spark, str(tmp_path / "regions.yml")).orderBy("ord").collect()
    assert (a["slug"], a["prefix"], a["admin_level"], a["w"], a["e"], a["role"]) == ("a", "a1", 6, 7.5, -9.0, None)
    assert (b["path"], b["n"], b["role"], b["bbox_clip"]) == ("b", 4.0, "rest", True)
    for bad in (["key: &x 1"], ["- a: {b: 1}"], ["- a: |"]):
        try:
            readers.parse_region_entries(bad)
        except ValueError:
            continue
        raise AssertionError(bad)


def test_capped_worklist_says_so(spark):
    f = repeated(spark)
    kept, capped = enrich.capped(f, 3)
    assert kept.count() == 3 and capped and not enrich.capped(f, 4)[1]


def test_geocode_budget_and_scope(spark):
    f = repeated(spark)
    hits = f.select(F.col("id").alias("feature_id"), F.lit(0).alias("ord"), "lng", "lat", F.lit("Weg").alias("street"), F.lit("").alias("housenumber"),
                    F.lit("1").alias("postcode"), F.lit(None).cast("string").alias("city"), F.lit("D").alias("district"), F.lit("Germany").alias("country"))
    free, short = (backfill.geocode_counters(f, hits, budget).collect()[0] for budget in (None, 3))
    assert (free["considered"], free["capped"], free["filled_street"], free["filled_number"], free["filled_city"]) == (4, False, 4, 0, 0)
    assert (short["considered"], short["matched"], short["capped"]) == (3, 3, True)
    none = backfill.geocode_counters(f.limit(0), hits).collect()[0]
    assert (none["considered"], none["capped"]) == (0, False)
    shop, plain = {"shop": "kiosk"}, {"name": "Corner"}
    rows = [("node", 1, 8.1, 50.1, shop), ("node", 1, 8.1, 50.1, shop), ("node", 2, 8.1, 50.1, plain), ("node", 3, 8.505, 50.1, shop), ("node", 4, 20.0, 50.1, shop)]
    elements = spark.createDataFrame(rows, "type string, id bigint, lng double, lat double, tags map<string,string>")
    counted = {r["region"]: r for r in backfill.scope_counters(f, elements).collect()}
    assert counted["(all)"]["asked"] == f.count() and counted["(all)"]["skipped_stale"] == 0
    assert all(r["candidates"] == 2 * r["files"] for r in counted.values())
    late = backfill.scope_counters(f, elements, "2999-01-01").filter("region = '(all)'").collect()[0]
    assert (late["asked"], late["files"], late["candidates"], late["skipped_stale"]) == (0, 0, 0, f.count())
