"""Queries on readers, writers, reports, snapshot gates and whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from poifuse import schema
from poifuse.catalog import standins as st
from poifuse.catalog.feature_queries import EL, FT, OSM_ONLY, SOURCES
from poifuse.catalog.registry import query
from poifuse.catalog.spatial_queries import BOXES
from poifuse.functions import provenance as prov
from poifuse.functions import rules
from poifuse.operators import dedup, linking, merge, quality, spatial, stats
from poifuse.plans import backfill, enrich, refresh, seed
from poifuse.sources import readers, writers

FT_STAMPS = dict(st.STAMP_COLUMNS)


@query(
    "SRC1 SNK1",
    f"WITH {FT} SELECT region, id, name, round(lng, 7) AS lng, has_payment, {SOURCES} AS sources, {st.joined_sql(FT_STAMPS)} AS stamps, hours, cash FROM ft",
)
def collection_round_trip(spark, sf):
    """Features to collection documents (several per large region) and back."""
    docs = writers.collections(st.features(spark, sf), per_document=200)
    parsed = docs.select(F.col("region").alias("path"), F.from_json("value", schema.GEOJSON_DDL)["features"].alias("features"))
    rows = readers.parse_collections(parsed)
    flat = st.flat(rows.withColumn("has_payment", F.col("payment").isNotNull()), "region", "id", "name", "lng", "has_payment", "sources", "stamps", "hours", "payment")
    return flat.withColumn("lng", F.round("lng", 7)).drop("cards", "contactless", "girocard")


@query(
    "SNK1 WIN7",
    f"WITH {FT} SELECT region, id, row_number() OVER (PARTITION BY region ORDER BY {OSM_ONLY}, id) AS position FROM ft",
)
def stable_positions(spark, sf):
    return writers.stable_order(st.features(spark, sf)).select("region", "id", "position")


@query(
    "SNK1 WIN7",
    f"WITH {FT}, o AS (SELECT region, id, row_number() OVER (PARTITION BY region ORDER BY {OSM_ONLY}, id) AS position FROM ft), n AS (SELECT region, count(*) AS n FROM ft GROUP BY 1) "
    "SELECT region, position, id, CASE WHEN position < n THEN ',' ELSE '}' END AS ending FROM o JOIN n USING (region) UNION ALL SELECT region, 0, NULL, '[' FROM n UNION ALL SELECT region, n + 1, NULL, '}' FROM n",
)
def collection_document_lines(spark, sf):
    """Each region as one document, line by line."""
    lines = writers.collection_lines(st.features(spark, sf).drop("k"))
    feature = F.regexp_replace("value", ",$", "")
    return lines.select("region", "position", F.get_json_object(feature, "$.properties.id").alias("id"), F.substring("value", -1, 1).alias("ending"))


@query(
    "SRC4",
    "SELECT p_brand, row_number() OVER (PARTITION BY p_brand, floor(p_partkey / 1000) ORDER BY p_partkey) AS ord, 'h' || p_partkey AS kioskId, p_name AS name FROM part",
)
def seed_ordinals(spark, sf):
    record = F.struct(F.col("p_partkey").alias("o"), F.concat(F.lit("h"), F.col("p_partkey").cast("string")).alias("kioskId"), F.col("p_name").alias("name"))
    grouped = st.table(spark, sf, "part").groupBy("p_brand", F.floor(F.col("p_partkey") / 1000).alias("file")).agg(F.sort_array(F.collect_list(record)).alias("r"))
    return readers.parse_seed(grouped.select("p_brand", F.to_json("r").alias("value"))).select("p_brand", "ord", "kioskId", "name")


@query(
    "SRC6",
    "SELECT 'all' AS region, 'f' || p_partkey AS feature_id, p_name || ', \"x\"' AS feature_name, p_size / 100.0 AS score FROM part",
)
def review_lines(spark, sf):
    """Quoted CSV lines, with commas and doubled quotes inside cells, parsed back."""
    p = st.table(spark, sf, "part")
    cells = [F.lit("all"), F.concat(F.lit("f"), F.col("p_partkey").cast("string")), F.concat("p_name", F.lit(', "x"')), F.lit("node/1"), F.lit("n"),
             (F.col("p_size") / 100).cast("string"), F.lit("1.0"), F.lit("0.5")]
    lines = p.select(F.concat_ws(",", *[writers.quoted(c) for c in cells]).alias("value"))
    return readers.parse_review_lines(lines).select("region", "feature_id", "feature_name", "score")


@query(
    "SRC7",
    "SELECT p_brand, p_type AS slug, 'L ' || p_type AS de, 'g' AS \"group\" FROM part GROUP BY p_brand, p_type",
)
def vocabulary_documents(spark, sf):
    """One vocabulary object per brand, with keys that are not slugs."""
    p = st.table(spark, sf, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("types"))
    body = F.transform("types", lambda t: F.concat(F.lit('"'), t, F.lit('": {"de": "L '), t, F.lit('", "group": "g"}')))
    text = F.concat(F.lit('{"$comment": "x", '), F.array_join(body, ", "), F.lit(', "$groups": {"g": {"de": "G"}}}'))
    return readers.parse_vocabulary(p.select("p_brand", text.alias("value"))).select("p_brand", "slug", "de", "group")


@query(
    "SRC8",
    "SELECT p_partkey, p_name AS title, p_size + 0.5 AS lat, CASE WHEN p_partkey % 3 = 2 THEN NULL ELSE p_size + 0.25 END AS lng FROM part WHERE p_partkey % 5 <> 4",
)
def place_lines(spark, sf):
    """JSON lines with either spelling of the longitude; malformed lines are skipped."""
    k = F.col("p_partkey")
    lng = F.when(k % 3 == 0, F.lit('"longitude": ')).when(k % 3 == 1, F.lit('"longtitude": ')).otherwise('"other": ')
    good = F.concat(F.lit('{"title": "'), "p_name", F.lit('", "latitude": '), (F.col("p_size") + 0.5).cast("string"), F.lit(", "), lng, (F.col("p_size") + 0.25).cast("string"), F.lit("}"))
    lines = st.table(spark, sf, "part").select("p_partkey", F.when(k % 5 == 4, F.lit("{broken")).otherwise(good).alias("value"))
    return readers.parse_place_lines(lines).select("p_partkey", "title", "lat", "lng")


@query(
    "FLT8",
    f"WITH {st.cte('poi', st.POI)}, {st.cte('box', BOXES, 'nation')} SELECT id, slug FROM poi JOIN box ON CASE WHEN role = 'rest' THEN id % 5 = box.ord % 5 AND "
    "(box.ord % 2 = 0 OR (lng BETWEEN w AND e AND lat BETWEEN s AND n)) ELSE lng BETWEEN w AND e AND lat BETWEEN s AND n END",
)
def area_members(spark, sf):
    """Elements that a region's query selects: by landed area code or by box."""
    boxes = st.table(spark, sf, "nation").selectExpr(*BOXES)
    region = F.struct("slug", "role", "w", "s", "e", "n", (F.col("ord") % 2 == 1).alias("bbox_clip"), (F.col("ord") % 5).cast("string").alias("iso3166_2"))
    regions = boxes.select(region.alias("region"))
    points = st.poi(spark, sf).select("id", "lng", "lat", F.array((F.col("id") % 5).cast("string")).alias("codes"))
    return spatial.members_of_areas(points, regions).select("id", F.col("region.slug").alias("slug"))


# Labels: words of documents against a vocabulary of part names.
LABELS = "w AS (SELECT doc_id, unnest(list_distinct(string_split(text, ' '))) AS tag FROM documents)"
VOCAB = "v AS (SELECT DISTINCT p_type AS slug FROM part), lab AS (SELECT CASE slug WHEN 'SMALL' THEN 'la' WHEN 'MEDIUM' THEN 'und' ELSE 'slug_' || lower(slug) END AS slug, CASE slug WHEN 'ECONOMY' THEN 'the' WHEN 'PROMO' THEN 'Für' WHEN 'STANDARD' THEN 'and' ELSE slug END AS de FROM v)"
MATCH = f"m AS (SELECT w.*, {st.slug_sql('w.tag')} AS key FROM w), k AS (SELECT m.doc_id, m.tag, coalesce(own.slug, lab.slug) AS slug FROM m LEFT JOIN lab own ON own.slug = m.key LEFT JOIN lab ON {st.slug_sql('lab.de')} = m.key)"


def _labels(spark, sf):
    words = st.table(spark, sf, "documents").select("doc_id", F.explode(F.array_distinct(F.split("text", " "))).alias("tag"))
    kinds = st.table(spark, sf, "part").select(F.col("p_type").alias("t")).distinct()
    label = F.when(F.col("t") == "ECONOMY", "the").when(F.col("t") == "PROMO", "Für").when(F.col("t") == "STANDARD", "and").otherwise(F.col("t"))
    slug = F.when(F.col("t") == "SMALL", "la").when(F.col("t") == "MEDIUM", "und").otherwise(F.concat(F.lit("slug_"), F.lower("t")))
    vocab = kinds.select(slug.alias("slug"), label.alias("de"), F.lit(0).alias("ord"))
    return quality.match_vocabulary(words, vocab)


@query("JN10 DQ3", f"WITH {LABELS}, {VOCAB}, {MATCH} SELECT slug, count(*) AS n, count(DISTINCT doc_id) AS docs FROM k WHERE slug IS NOT NULL GROUP BY slug")
def vocabulary_matches(spark, sf):
    known = _labels(spark, sf).filter(F.col("slug").isNotNull())
    return known.groupBy("slug").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))


@query("AGG11 DQ3", f"WITH {LABELS}, {VOCAB}, {MATCH} SELECT tag, count(*) AS n FROM k WHERE slug IS NULL GROUP BY tag ORDER BY n DESC, tag LIMIT 30")
def unknown_label_report(spark, sf):
    return quality.unknown_labels(_labels(spark, sf))


@query(
    "FLT21",
    "SELECT event_id AS ord, event_type AS tag FROM events WHERE event_type <> 'error' AND floor(value) % 7 <> 3",
)
def kept_labels(spark, sf):
    votes = F.when(F.floor("value") % 7 == 3, -1).otherwise(1)
    entry = F.struct(
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("tag"),
        F.struct(F.when(F.col("event_id") % 4 != 0, votes).when(votes < 0, votes).cast("int").alias("totalVotes")).alias("tagVotes"),
    )
    rows = st.table(spark, sf, "events").select(F.col("event_id").alias("ord"), F.array(entry).alias("kioskTags"))
    return seed.kept_labels(rows).select("ord", "tag")


@query(
    "DQ1",
    f"WITH {FT}, bad AS (SELECT region, id, 'postalcode pattern' AS rule FROM ft WHERE NOT regexp_full_match(postalcode, '[0-9]{{5}}') UNION ALL "
    "SELECT region, id, 'updated date' FROM ft WHERE updated = 'not a date' UNION ALL SELECT region, id, 'apple_id_attempted date' FROM ft WHERE apple_id_attempted = 'bad' UNION ALL "
    "SELECT region, id, 'stamp source' FROM ft WHERE st_hours = 'nobody' UNION ALL "
    "SELECT region, id, 'undeclared extra' FROM ft WHERE k % 13 = 0) SELECT * FROM bad",
)
def schema_violations(spark, sf):
    f = st.features(spark, sf)
    keys = F.to_json(F.struct("id", "name", F.when(F.col("k") % 13 == 0, F.lit(1)).alias("extra")))
    return quality.violations(f, quality.undeclared_keys(keys))


LINT = [
    "c_custkey AS ord",
    "'s' || CAST(c_custkey - c_custkey % 3 AS STRING) AS slug",
    "'data/' || c_mktsegment || CAST(c_custkey AS STRING) AS path",
    "CASE WHEN c_custkey % 40 = 0 THEN 'a-b' ELSE 'p' || CAST(c_custkey AS STRING) END AS prefix",
    "CASE WHEN c_custkey % 30 = 0 THEN 'de' ELSE 'DE-HE' END AS iso3166_2",
    "CASE WHEN c_custkey % 50 = 0 THEN 'town' WHEN c_custkey % 2 = 0 THEN 'city' END AS role",
]


@query(
    "DQ2 AGG12",
    f"WITH {st.cte('r', LINT, 'customer')} SELECT 'duplicate slug' AS problem, slug AS value, slug FROM r WHERE slug IN (SELECT slug FROM r GROUP BY slug HAVING count(*) > 1) UNION ALL "
    "SELECT 'duplicate prefix', prefix, slug FROM r WHERE prefix IN (SELECT prefix FROM r GROUP BY prefix HAVING count(*) > 1) UNION ALL "
    "SELECT 'malformed prefix', prefix, slug FROM r WHERE prefix = 'a-b' UNION ALL SELECT 'malformed iso3166_2', iso3166_2, slug FROM r WHERE iso3166_2 = 'de' UNION ALL "
    "SELECT 'malformed role', role, slug FROM r WHERE role = 'town'",
)
def region_lint(spark, sf):
    return quality.lint_regions(st.table(spark, sf, "customer").selectExpr(*LINT))


@query("AGG12", "SELECT 'name' AS field, p_name AS value, count(*) OVER (PARTITION BY p_name) AS n, p_partkey AS member FROM part QUALIFY n > 1")
def duplicate_names(spark, sf):
    return quality.duplicates(st.table(spark, sf, "part"), F.col("p_name"), "name", "p_partkey")


# Snapshot gates: ids are orders, regions nations, groups order priorities.
GROUPS = "CASE o_orderpriority WHEN '1-URGENT' THEN 'convenience' WHEN '2-HIGH' THEN 'bar' ELSE 'kiosk' END"
GATE = (
    f"x AS (SELECT c_nationkey AS region, {GROUPS} AS query_group, o_orderkey AS osm_id FROM orders JOIN customer ON c_custkey = o_custkey), "
    "a AS (SELECT x.*, m.mirror FROM x CROSS JOIN (VALUES (0), (1)) m(mirror) WHERE CASE WHEN m.mirror = 0 THEN CASE WHEN region % 2 = 0 THEN osm_id % 3 <> 0 ELSE osm_id % 7 <> 0 END "
    "ELSE CASE WHEN region % 4 = 0 THEN osm_id % 2 = 0 ELSE osm_id % 9 <> 0 END END), "
    "e AS (SELECT region, query_group, count(*) AS expected FROM x GROUP BY 1, 2), f AS (SELECT region, query_group, mirror, count(*) AS found FROM a GROUP BY 1, 2, 3), "
    "s AS (SELECT f.region, f.query_group, mirror, expected, CASE WHEN expected < 10 THEN 0.0 ELSE (expected - found) / expected END AS share FROM f JOIN e USING (region, query_group))"
)


def _gate(spark, sf):
    o = st.table(spark, sf, "orders").join(st.table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    expected = o.selectExpr("c_nationkey AS region", f"{GROUPS} AS query_group", "o_orderkey AS osm_id")
    i, r = F.col("osm_id"), F.col("region")
    first = F.when(r % 2 == 0, i % 3 != 0).otherwise(i % 7 != 0)
    second = F.when(r % 4 == 0, i % 2 == 0).otherwise(i % 9 != 0)
    mirrors = F.array_compact(F.array(F.when(first, 0), F.when(second, 1)))
    return expected, expected.withColumn("mirror", F.explode(mirrors))


@query("AGG1 AGG2", f"WITH {GATE} SELECT region, query_group, mirror, expected, round(share, 6) AS share FROM s")
def missing_shares(spark, sf):
    return quality.missing_share(*_gate(spark, sf)).withColumn("share", F.round("share", 6))


@query(
    "AGG3",
    f"WITH {GATE} SELECT region, query_group, min(CASE WHEN share <= 0.2 THEN mirror END) AS mirror, CASE WHEN min(CASE WHEN share <= 0.2 THEN mirror END) IS NOT NULL THEN 'accepted' "
    "WHEN query_group = 'kiosk' THEN 'region failed' ELSE 'group frozen' END AS status FROM s GROUP BY 1, 2",
)
def accepted_answers(spark, sf):
    return quality.accept_answers(quality.missing_share(*_gate(spark, sf)))


REF = "CASE WHEN k % 3 = 0 THEN 'node/' ELSE 'way/' END || k"


@query(
    "AGG1 FLT7",
    f"WITH {FT} SELECT region, CASE WHEN kind IN ('convenience', 'bar') THEN kind ELSE 'kiosk' END AS query_group, count(*) AS ids FROM ft WHERE s_osm AND NOT osm_removed GROUP BY 1, 2",
)
def expected_live_ids(spark, sf):
    return quality.expected_ids(st.features(spark, sf)).groupBy("region", "query_group").agg(F.count(F.lit(1)).alias("ids"))


def _fresh_ids(f):
    """Stand-in snapshot ids: those of the features whose key is no multiple of thirteen."""
    ref = F.concat(F.when(F.col("k") % 3 == 0, "node/").otherwise("way/"), F.col("k").cast("string"))
    return f.filter("k % 13 <> 0").select("region", ref.alias("osm_id"), "k")


@query(
    "JN3",
    f"WITH {FT}, x AS (SELECT region, {REF} AS osm_id, id, ord FROM ft WHERE s_osm), y AS (SELECT region, {REF} AS osm_id, k FROM ft WHERE k % 13 <> 0) "
    "SELECT region, osm_id, id, k FROM x FULL JOIN y USING (region, osm_id)",
)
def id_matches(spark, sf):
    f = st.features(spark, sf)
    return linking.match_by_osm_id(f, _fresh_ids(f)).select("region", "osm_id", "id", "k")


@query(
    "JN9 SET4",
    f"WITH {FT} SELECT region, {REF} AS osm_id FROM ft WHERE {OSM_ONLY} AND NOT osm_removed AND k % 13 = 0 AND k % 5 <> 2 AND NOT (region = 'em' AND coalesce(kind, '') = 'bar')",
)
def confirmed_removals(spark, sf):
    f = st.features(spark, sf)
    ref = F.concat(F.when(F.col("k") % 3 == 0, "node/").otherwise("way/"), F.col("k").cast("string")).alias("osm_id")
    still = f.filter("k % 5 = 2").select("region", ref)
    failed = f.select(F.lit("em").alias("region"), F.lit("bar").alias("query_group")).distinct()
    return refresh.confirmed_gone(f, _fresh_ids(f), still, failed)


@query(
    "WIN2",
    "WITH e AS (SELECT o_orderstatus AS region, o_orderkey AS id, o_custkey AS osm_id FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY region, osm_id ORDER BY id) AS rn FROM e) "
    "SELECT region, id, osm_id FROM r WHERE rn = 1",
)
def first_row_per_id(spark, sf):
    edges = st.table(spark, sf, "orders").selectExpr("o_orderstatus AS region", "o_orderkey AS id", "o_orderkey AS ord", "o_custkey AS osm_id")
    return dedup.first_row_per_id(edges).select("region", "id", "osm_id")


# Rows with several ids: an order and its parts, fifty regions; a row is dropped if an earlier kept row of its region has one of its ids.
KEYED = (
    "e AS (SELECT DISTINCT o_custkey % 50 AS region, l_orderkey AS id, l_partkey AS osm_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey), "
    "r AS (SELECT region, id, list(osm_id) AS ids, row_number() OVER (PARTITION BY region ORDER BY id) AS n FROM e GROUP BY region, id)"
)


@query(
    "WIN2",
    f"WITH RECURSIVE {KEYED}, w AS (SELECT region, n, ids AS used, true AS kept, id FROM r WHERE n = 1 UNION ALL "
    "SELECT r.region, r.n, CASE WHEN list_has_any(w.used, r.ids) THEN w.used ELSE list_concat(w.used, r.ids) END, NOT list_has_any(w.used, r.ids), r.id "
    "FROM w JOIN r ON r.region = w.region AND r.n = w.n + 1) SELECT e.region, e.id, e.osm_id FROM w JOIN e USING (region, id) WHERE w.kept",
)
def rows_with_several_ids(spark, sf):
    orders = st.table(spark, sf, "orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey % 50 AS region")
    lines = st.table(spark, sf, "lineitem").join(orders, "l_orderkey")
    edges = lines.selectExpr("region", "l_orderkey AS id", "l_orderkey AS ord", "l_partkey AS osm_id").distinct()
    return dedup.first_row_per_id(edges).select("region", "id", "osm_id")


@query(
    "WIN3",
    "SELECT l_returnflag AS type, l_partkey AS id, min(l_orderkey * 10 + l_linenumber) AS ord FROM lineitem GROUP BY 1, 2",
)
def distinct_candidates(spark, sf):
    rows = st.table(spark, sf, "lineitem").selectExpr("l_returnflag AS type", "l_partkey AS id", "l_orderkey * 10 + l_linenumber AS ord", "l_quantity")
    return dedup.distinct_candidates(rows).select("type", "id", "ord")


@query(
    "SET3 SET4",
    f"WITH {FT}, x AS (SELECT region, {REF} AS ref, id FROM ft), y AS (SELECT region, {REF} AS ref FROM ft WHERE k % 13 <> 0) "
    f"SELECT id AS row_id, 'refreshed' AS part FROM x WHERE id IN (SELECT id FROM ft WHERE s_osm AND k % 13 <> 0) UNION ALL "
    "SELECT id, 'kept' FROM ft WHERE NOT (s_osm AND k % 13 <> 0) UNION ALL "
    f"SELECT {REF}, 'added' FROM ft WHERE k % 13 <> 0 AND NOT s_osm",
)
def merged_row_set(spark, sf):
    """Rows of a new snapshot by origin: refreshed, kept and added."""
    f = st.features(spark, sf)
    matches = linking.match_by_osm_id(f, _fresh_ids(f).drop("k").withColumn("in_fresh", F.lit(True)))
    refreshed = matches.filter(F.col("in_fresh") & F.col("id").isNotNull()).select(F.col("id").alias("row_id"), F.lit("refreshed").alias("part"))
    added = matches.filter(F.col("id").isNull()).select(F.col("osm_id").alias("row_id"), F.lit("added").alias("part"))
    kept = f.select(F.col("id").alias("row_id")).join(refreshed, "row_id", "left_anti").withColumn("part", F.lit("kept"))
    return refreshed.unionByName(kept).unionByName(added)


ACTION = "CASE user_id % 4 WHEN 0 THEN 'added' WHEN 1 THEN CASE event_type WHEN 'view' THEN 'updated' WHEN 'click' THEN 'removed' ELSE 'kept_non_osm' END WHEN 2 THEN 'linked_non_osm' ELSE 'dropped_market' END"


@query(
    "AGG7",
    f"WITH a AS (SELECT user_id % 9 AS region, {ACTION} AS action FROM events) SELECT region, "
    + ", ".join(f"count_if(action = '{name}') AS {name}" for name in stats.REFRESH_ACTIONS)
    + " FROM a GROUP BY region",
)
def action_counters(spark, sf):
    actions = st.table(spark, sf, "events").selectExpr("user_id % 9 AS region", f"{ACTION} AS action")
    return stats.refresh_counters(actions)


def _refreshed(spark, sf):
    """Whole refresh: features against a snapshot of the same places, four overlapping regions."""
    f = st.features(spark, sf)
    regions = st.table(spark, sf, "nation").filter("n_nationkey < 4").selectExpr(
        "n_nationkey AS ord", st.choose("n_nationkey", st.SLUGS) + " AS slug", "'x' AS path", st.choose("n_nationkey", st.SLUGS) + " AS prefix",
        "CASE WHEN n_nationkey = 1 THEN 'ES-MD' ELSE 'DE-HE' END AS iso3166_2", "4 AS admin_level",
        "CAST(8.0 + n_nationkey * 0.003 - 0.01 AS DOUBLE) AS w", "49.99D AS s", "CAST(8.0 + n_nationkey * 0.003 + 0.013 AS DOUBLE) AS e", "51.0D AS n",
        "CASE WHEN n_nationkey = 3 THEN 'rest' ELSE 'city' END AS role", "false AS bbox_clip",
    )
    elements = st.elements(spark, sf).filter("k % 13 <> 0").drop("iso", "prefix", "region")
    slugs = F.array(*[F.lit(s) for s in st.SLUGS])
    elements = elements.withColumn("region", F.element_at(slugs, (F.col("k") % 4).cast("int") + 1)).drop("k")
    fresh = refresh.elements_to_features(elements, regions, st.AS_OF)
    ref = F.concat(F.when(F.col("k") % 3 == 0, "node/").otherwise("way/"), F.col("k").cast("string")).alias("osm_id")
    still = f.filter("k % 5 = 2").select("region", ref)
    failed = f.select(F.lit("em").alias("region"), F.lit("bar").alias("query_group")).distinct()
    return refresh.refresh_snapshot(f.drop("k"), fresh, regions, still, failed)


@query("JN3 JN4 MRG1 MRG8 MRG9 SET3 FLT19 WIN2 PRJ1 JN1")
def refreshed_snapshot(spark, sf):
    out = _refreshed(spark, sf).features
    return st.flat(out, "region", "id", "name", "osm_removed", "kind", "updated", "hours", "tags", "sources", "stamps")


@query("AGG7 MRG8")
def refresh_counters(spark, sf):
    return _refreshed(spark, sf).counters()


@query(
    "MRG8",
    f"WITH {FT} SELECT k, CASE WHEN {OSM_ONLY} AND NOT osm_removed AND k % 13 = 0 THEN true WHEN osm_removed THEN true END AS osm_removed FROM ft",
)
def removal_flags(spark, sf):
    f = st.features(spark, sf)
    gone = f.filter("k % 13 = 0").select("k", F.lit(True).alias("gone"))
    flag = merge.removal_flag(F.coalesce("gone", F.lit(False)))
    return f.join(gone, "k", "left").select("k", flag.alias("osm_removed"))


@query("JN6 MRG2 MRG6 AGG8")
def backfilled_table(spark, sf):
    f = st.features(spark, sf).filter("k % 2 = 0")
    elements = refresh.located(st.elements(spark, sf)).filter("k % 2 = 1").select("type", "id", "version", "lng", "lat", "tags")
    hits = f.select(
        F.col("id").alias("feature_id"), F.lit(0).alias("ord"), "lng", "lat", F.lit("Hit street").alias("street"), F.lit("7").alias("housenumber"),
        F.lit("60311").alias("postcode"), F.lit("Frankfurt").alias("city"), F.lit(None).cast("string").alias("district"), F.lit("Germany").alias("country"),
    )
    out = backfill.backfill_from_map(f.drop("k"), elements, hits, st.AS_OF)
    return st.flat(out.features, "region", "id", "hours", "address", "payment", "tags", "sources", "updated", "stamps")


@query("FLT16 JN13 JN14 MRG3 MRG4 MRG7 MRG14 PRJ20 PRJ21 PRJ22")
def enriched_table(spark, sf):
    """Place ids, then pages, then search results."""
    f = st.features(spark, sf)
    k = F.col("k")
    places = f.select(F.col("id").alias("feature_id"), F.lit(0).alias("ord"), "lng", "lat", F.when(k % 3 != 0, F.concat(F.lit("a"), k.cast("string"))).alias("place_id"))
    step1 = enrich.resolve_place_ids(f, places, f.select(F.col("id").alias("feature_id")), st.AS_OF)
    block = '"amenityV2":[{"amenityPresent":true,"amenityId":"crossbusiness.payments.contactless_pay"}]'
    pages = f.filter("k % 4 = 0").select(F.concat(F.lit("a"), k.cast("string")).alias("place_id"), F.lit(f"<html>{block}</html>").alias("html"))
    step2 = enrich.apply_place_pages(step1, pages, st.AS_OF)
    about = F.from_json(F.lit('[{"name":"Payments","options":[{"name":"Credit cards","enabled":true}]}]'), schema.ABOUT_DDL)
    results = f.filter("k % 5 <> 0").select(
        F.col("id").alias("feature_id"), F.lit(0).alias("ord"), "lng", "lat", F.lit("G1").alias("place_id"), F.lit(None).cast("string").alias("cid"),
        about.alias("about"), F.create_map(F.lit("Montag"), F.array(F.lit("07:00–22:00"))).alias("open_hours"),
    )
    step3 = enrich.apply_search_results(step2, results, f.select(F.col("id").alias("feature_id")), st.AS_OF)
    return st.flat(step3, "id", "payment", "hours", "sources", "stamps", "apple_id_attempted", "apple_attempted", "google_attempted", "updated")
