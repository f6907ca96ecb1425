"""Queries on places: distances, regions, tiles, radius matches and pairings."""

from __future__ import annotations

from pyspark.sql import functions as F

from poifuse import schema
from poifuse.catalog import standins as st
from poifuse.catalog.registry import query
from poifuse.functions import geo
from poifuse.operators import dedup, linking, spatial, stats
from poifuse.plans import seed
from poifuse.sources import writers

POI = st.cte("poi", st.POI)
ALL_POI = f"{POI}, f AS (SELECT * FROM poi)"
PAIR_POI = f"{POI}, f AS (SELECT * FROM poi WHERE side = 0), c AS (SELECT * FROM poi WHERE side = 1)"

BOXES = [
    "n_nationkey AS ord",
    "n_name AS slug",
    "'data/' || n_name AS path",
    "'p' || CAST(n_nationkey AS STRING) AS prefix",
    "CAST(8.0 + (n_nationkey % 5) * 0.003 - 0.001 AS DOUBLE) AS w",
    "CAST(50.0 + FLOOR(n_nationkey / 5) * 0.0025 - 0.001 AS DOUBLE) AS s",
    "CAST(8.0 + (n_nationkey % 5) * 0.003 + 0.004 AS DOUBLE) AS e",
    "CAST(50.0 + FLOOR(n_nationkey / 5) * 0.0025 + 0.0035 AS DOUBLE) AS n",
    "CASE WHEN n_nationkey % 3 = 0 THEN 'rest' WHEN n_nationkey % 3 = 1 THEN 'city' END AS role",
]
# Points spread over central Europe, one per customer, some of them unusable.
SPREAD = [
    "c_custkey AS k",
    "CAST(CASE WHEN c_custkey % 50 = 7 THEN 95.0 WHEN c_custkey % 50 = 8 THEN NULL ELSE 46.5 + (c_custkey % 83) * 0.11 END AS DOUBLE) AS lat",
    "CAST(CASE WHEN c_custkey % 50 = 9 THEN -190.0 ELSE 5.5 + (c_custkey % 97) * 0.1 END AS DOUBLE) AS lng",
    "c_nationkey AS region",
]
# Anchors: one per nation, on a grid over the points.
ANCHOR = ["n_nationkey AS i", "n_name AS slug", "CAST(47.5 + (n_nationkey % 5) * 1.7 AS DOUBLE) AS lat", "CAST(6.0 + FLOOR(n_nationkey / 5) * 1.9 AS DOUBLE) AS lng"]


def _poi(spark, sf, side=None):
    return st.poi(spark, sf) if side is None else st.poi(spark, sf).filter(F.col("side") == side)


def _boxes(spark, sf):
    return st.table(spark, sf, "nation").selectExpr(*BOXES)


def _spread(spark, sf):
    return st.table(spark, sf, "customer").selectExpr(*SPREAD)


D2 = "pow((lng - (w + e) / 2) * cos(lat * pi() / 180), 2) + pow(lat - (s + n) / 2, 2)"


@query(
    "JN1 FLT10 PRJ8",
    f"WITH {POI}, {st.cte('box', BOXES, 'nation')}, hit AS (SELECT id, slug, coalesce(role, 'city') <> 'city' AS is_rest, {D2} AS d2, box.ord AS o "
    "FROM poi JOIN box ON lng BETWEEN w AND e AND lat BETWEEN s AND n), "
    "best AS (SELECT id, slug, row_number() OVER (PARTITION BY id ORDER BY is_rest, d2, o) AS rn FROM hit) "
    "SELECT poi.id, best.slug AS owner FROM poi LEFT JOIN best ON best.id = poi.id AND rn = 1",
)
def region_ownership(spark, sf):
    return spatial.assign_region(st.poi(spark, sf), _boxes(spark, sf)).select("id", "owner")


@query(
    "JN2 FLT12 PRJ7",
    f"WITH {st.cte('p', SPREAD, 'customer')}, n AS (SELECT {', '.join(ANCHOR)} FROM nation), a AS (SELECT i, slug, lat AS alat, lng AS alng FROM n), "
    "ok AS (SELECT *, coalesce(lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180, false) AS usable FROM p), "
    f"d AS (SELECT k, slug, {st.haversine_sql('alat', 'alng', 'lat', 'lng', '6371.0088')} AS km, i FROM ok, a WHERE usable), "
    "best AS (SELECT k, slug, km, row_number() OVER (PARTITION BY k ORDER BY km, i) AS rn FROM d) "
    "SELECT ok.k, CASE WHEN km <= 60 THEN slug END AS anchor, round(km, 4) AS km, "
    "CASE WHEN NOT usable THEN 'invalid coords' WHEN km > 60 THEN 'no anchor within radius' END AS dropped "
    "FROM ok LEFT JOIN best ON best.k = ok.k AND rn = 1",
)
def nearest_anchor_split(spark, sf):
    anchors = [r.asDict() for r in st.table(spark, sf, "nation").selectExpr(*ANCHOR).orderBy("i").collect()]  # 25 rows
    placed = spatial.nearest_anchor(_spread(spark, sf).select("k", "lng", "lat"), anchors)
    return placed.select("k", "anchor", F.round("km", 4).alias("km"), "dropped")


@query(
    "FLT11 FLT12",
    f"WITH {st.cte('p', SPREAD, 'customer')} SELECT k, coalesce(lng BETWEEN 5.87 AND 15.04 AND lat BETWEEN 47.27 AND 55.06, false) AS in_germany, "
    "coalesce(lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180, false) AS valid, "
    "CASE WHEN k % 4 < 3 THEN round(lng, 6) END AS parsed FROM p",
)
def place_checks(spark, sf):
    lng, lat = F.col("lng"), F.col("lat")
    written = F.when(F.col("k") % 4 < 2, F.round(lng, 6).cast("string")).when(F.col("k") % 4 == 2, F.concat(F.lit(" "), F.round(lng, 6).cast("string"), F.lit("°E")))
    parsed = geo.parse_coordinate(F.coalesce(written, F.lit("n/a")))
    return _spread(spark, sf).select(
        "k",
        F.coalesce(geo.in_germany(lng, lat), F.lit(False)).alias("in_germany"),
        geo.valid_point(lng, lat).alias("valid"),
        F.round(parsed, 6).alias("parsed"),
    )


TILE = "FLOOR(lng / 0.5) * 0.5 AS x, FLOOR(lat / 0.5) * 0.5 AS y"


@query(
    "AGG4",
    f"WITH {st.cte('p', SPREAD, 'customer')}, t AS (SELECT DISTINCT {TILE} FROM p WHERE lat IS NOT NULL) "
    "SELECT round(x - 0.01, 6) AS w, round(y - 0.01, 6) AS s, round(x + 0.5 + 0.01, 6) AS e, round(y + 0.5 + 0.01, 6) AS n FROM t",
)
def occupied_tiles(spark, sf):
    tiles = spatial.occupied_tiles(_spread(spark, sf).filter("lat IS NOT NULL"))
    return tiles.select(*[F.round(c, 6).alias(c) for c in ("w", "s", "e", "n")])


@query(
    "AGG5",
    f"WITH {st.cte('p', SPREAD, 'customer')} SELECT region, round(min(lng) - 0.005, 6) AS w, round(min(lat) - 0.005, 6) AS s, "
    "round(max(lng) + 0.005, 6) AS e, round(max(lat) + 0.005, 6) AS n FROM p GROUP BY region",
)
def padded_boxes(spark, sf):
    boxes = spatial.padded_box(_spread(spark, sf), ["region"])
    return boxes.select("region", *[F.round(c, 6).alias(c) for c in ("w", "s", "e", "n")])


@query(
    "WIN5 AGG6",
    f"WITH {st.cte('p', SPREAD, 'customer')}, b AS (SELECT *, FLOOR((row_number() OVER (PARTITION BY region ORDER BY k) - 1) / 15) AS batch FROM p "
    "WHERE coalesce(lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180, false)), "
    "m AS (SELECT region, batch, avg(lat) AS la, avg(lng) AS ln, count(*) AS members FROM b GROUP BY 1, 2), "
    f"d AS (SELECT region, batch, max({st.haversine_sql('la', 'ln', 'lat', 'lng')}) AS far FROM b JOIN m USING (region, batch) GROUP BY 1, 2) "
    "SELECT region, CAST(batch AS BIGINT) AS batch, members, round(la, 6) AS centre_lat, round(ln, 6) AS centre_lng, "
    "greatest(1000.0, floor(far + 500 + 0.5)) AS radius_m FROM m JOIN d USING (region, batch)",
)
def batch_circles(spark, sf):
    usable = _spread(spark, sf).filter(geo.valid_point(F.col("lng"), F.col("lat")))
    planned = dedup.batches(usable, ["region"], ["k"])
    circles = spatial.bounding_circle(planned, ["region", "batch"])
    sizes = planned.groupBy("region", "batch").agg(F.count(F.lit(1)).alias("members"))
    joined = circles.join(sizes, ["region", "batch"])
    return joined.select(
        "region", "batch", "members", F.round("centre_lat", 6).alias("centre_lat"), F.round("centre_lng", 6).alias("centre_lng"), "radius_m"
    )


METERS = st.haversine_sql("c.lat", "c.lng", "f.lat", "f.lng")
NAMED = f"{PAIR_POI}, fn AS (SELECT *, {st.norm_a_sql('name')} AS nn FROM f), cn AS (SELECT *, {st.norm_a_sql('name')} AS nn FROM c)"
NEAR = (
    f"near AS (SELECT f.id AS fid, c.id AS cid, f.ord AS ford, c.ord AS cord, f.nn AS fnn, c.nn AS cnn, {METERS} AS meters "
    f"FROM fn f JOIN cn c ON {st.near_sql('f', 'c')})"
)


@query(
    "JN4 PRJ9a PRJ10a",
    f"WITH {NAMED}, {NEAR}, ok AS (SELECT *, {st.dice_a_sql('fnn', 'cnn')} AS sim FROM near WHERE meters <= 30), "
    "best AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY ford) AS rn FROM ok WHERE sim >= 0.6) "
    "SELECT cid AS fresh_id, fid AS existing_id, round(meters, 4) AS meters, round(sim, 6) AS sim FROM best WHERE rn = 1",
)
def linked_points(spark, sf):
    out = linking.first_similar(_poi(spark, sf, 1), _poi(spark, sf, 0))
    return out.select("fresh_id", "existing_id", F.round("meters", 4).alias("meters"), F.round("sim", 6).alias("sim"))


@query(
    "JN5 SET4",
    f"WITH {NAMED}, {NEAR} SELECT id FROM c WHERE id NOT IN (SELECT cid FROM near WHERE meters <= 30 AND {st.dice_a_sql('fnn', 'cnn')} >= 0.6)",
)
def unshadowed_points(spark, sf):
    return linking.without_near_duplicates(_poi(spark, sf, 1), _poi(spark, sf, 0)).select("id")


SCORED = (
    f"{NAMED}, {NEAR}, sc AS (SELECT *, {st.dice_a_sql('fnn', 'cnn')} AS sim FROM near WHERE meters <= 25), "
    "s2 AS (SELECT *, 0.55 * sim + 0.45 * greatest(0.0, 1 - meters / 25.0) AS score FROM sc), "
    "best AS (SELECT *, row_number() OVER (PARTITION BY fid ORDER BY score DESC, cord) AS rn FROM s2)"
)
VERDICT = (
    "CASE WHEN score >= 0.65 OR (sim >= 0.8 AND meters <= 25) OR (meters <= 15 AND sim >= 0.45) OR (meters <= 3 AND sim >= 0.25) "
    "THEN 'accepted' WHEN score >= 0.5 THEN 'uncertain' ELSE 'rejected' END"
)


@query(
    "JN6 PRJ11 PRJ12",
    f"WITH {SCORED} SELECT fid AS feature_id, cid AS candidate_id, round(meters, 4) AS meters, round(sim, 6) AS sim, round(score, 6) AS score, "
    f"{VERDICT} AS verdict FROM best WHERE rn = 1",
)
def best_matches(spark, sf):
    out = linking.best_match(_poi(spark, sf, 0), _poi(spark, sf, 1))
    return out.select("feature_id", "candidate_id", *[F.round(c, d).alias(c) for c, d in (("meters", 4), ("sim", 6), ("score", 6))], "verdict")


@query(
    "SNK2",
    f"WITH {SCORED} SELECT 'all' AS region, CAST(fid AS VARCHAR) AS feature_id, CAST(cid AS VARCHAR) AS osm_ref, printf('%.2f', floor(score * 100 + 0.5) / 100) AS score, "
    f"printf('%.1f', floor(meters * 10 + 0.5) / 10) AS distance_m, printf('%.2f', floor(sim * 100 + 0.5) / 100) AS name_sim FROM best WHERE rn = 1 AND {VERDICT} = 'uncertain'",
)
def match_review_rows(spark, sf):
    out = linking.best_match(_poi(spark, sf, 0), _poi(spark, sf, 1)).filter(F.col("verdict") == "uncertain")
    review = out.select(
        F.lit("all").alias("region"),
        F.col("feature_id").cast("string").alias("feature_id"),
        F.lit("").alias("feature_name"),
        F.col("candidate_id").cast("string").alias("osm_ref"),
        F.lit("").alias("osm_name"),
        "score",
        F.col("meters").alias("distance_m"),
        F.col("sim").alias("name_sim"),
    )
    return writers.match_review_cells(review).select("region", "feature_id", "osm_ref", "score", "distance_m", "name_sim")


# Pairing. Seeds are even keys, map rows odd ones; regions are blocks of the grid.
REGION = "CASE WHEN p_partkey % 6 < 2 THEN 'a' ELSE 'b' END"
PAIRING = st.POI + [
    f"{REGION} AS region",
    "'St ' || CAST((p_partkey - p_partkey % 2) % 8 AS STRING) AS street",
    "CASE WHEN p_partkey % 5 <> 0 THEN CAST((p_partkey - p_partkey % 2) % 6 AS STRING) END AS number",
    "CASE WHEN p_partkey % 3 = 0 THEN 'yes' END AS cash",
    "CASE WHEN p_partkey % 4 = 0 THEN 'Mo-Fr 08:00-20:00' END AS hours",
    "CASE WHEN p_partkey % 7 = 0 THEN 'text' END AS description",
]


def _pairing(spark, sf, side=None):
    rows = st.parts(spark, sf).selectExpr(*PAIRING)
    rows = rows if side is None else rows.filter(F.col("side") == side)
    none = F.lit(None).cast("string")
    return rows.select(
        "region", "ord", "lng", "lat", F.col("id"), "name", "description",
        F.struct("street", "number", none.alias("postalcode"), none.alias("city"), none.alias("district")).alias("address"),
        F.when(F.col("hours").isNotNull(), F.struct(F.col("hours").alias("raw"))).alias("hours"),
        F.lit(None).cast("array<string>").alias("tags"),
        F.struct("cash", none.alias("cards"), none.alias("contactless"), none.alias("girocard")).alias("payment"),
    )


PAIR_BASE = f"WITH {st.cte('q', PAIRING)}, n AS (SELECT *, {st.fold_sql('name')} AS nm, lower(trim(street)) AS st, lower(trim(coalesce(number, ''))) AS nr FROM q)"
PAIR_SQL = (
    f"{PAIR_BASE}, near AS (SELECT f.region, f.id AS gone_id, c.id AS kept_id, f.nm AS a, c.nm AS b, f.st AS s1, c.st AS s2, f.nr AS n1, c.nr AS n2, "
    f"{st.haversine_sql('f.lat', 'f.lng', 'c.lat', 'c.lng')} AS meters FROM n f JOIN n c ON f.side = 0 AND c.side = 1 AND f.region = c.region AND {st.near_sql('f', 'c')}), "
    f"j AS (SELECT *, length(a) >= 4 AND a = b AS exact, {st.dice_b_sql('a', 'b')} AS sim FROM near WHERE meters <= 60), "
    "g AS (SELECT * FROM j WHERE meters <= CASE WHEN exact OR sim >= 0.65 THEN 60 ELSE 30 END), "
    "r AS (SELECT *, CASE WHEN exact THEN 'exact-name' WHEN sim >= 0.55 THEN 'dice' "
    "WHEN length(a) >= 3 AND length(b) >= 3 AND (contains(a, b) OR contains(b, a)) THEN 'substring' "
    "WHEN s1 <> '' AND n1 <> '' AND s1 = s2 AND n1 = n2 THEN 'address' WHEN meters <= 8 THEN 'close-coord' WHEN sim >= 0.3 THEN 'B:dice' END AS reason FROM g) "
)


@query(
    "JN7 PRJ13 PRJ14",
    f"{PAIR_SQL} SELECT region, gone_id, kept_id, round(meters, 4) AS meters, round(sim, 6) AS sim, reason FROM r WHERE reason IS NOT NULL",
)
def seed_map_pairs(spark, sf):
    pairs = dedup.cross_pairs(_pairing(spark, sf, 0), _pairing(spark, sf, 1))
    return pairs.select("region", "gone_id", "kept_id", F.round("meters", 4).alias("meters"), F.round("sim", 6).alias("sim"), "reason")


@query(
    "JN8 PRJ19",
    f"{PAIR_BASE}, s AS (SELECT *, (cash IS NOT NULL)::INT + (hours IS NOT NULL)::INT + (street <> '')::INT + (coalesce(number, '') <> '')::INT + (description IS NOT NULL)::INT AS score "
    f"FROM n WHERE length(nm) >= 4), t AS (SELECT a.region, a.id AS a_id, b.id AS b_id, a.score >= b.score AS first_stays, "
    f"{st.haversine_sql('a.lat', 'a.lng', 'b.lat', 'b.lng')} AS meters FROM s a JOIN s b ON a.region = b.region AND a.nm = b.nm AND a.ord < b.ord AND {st.near_sql('a', 'b')}) "
    "SELECT region, CASE WHEN first_stays THEN b_id ELSE a_id END AS gone_id, CASE WHEN first_stays THEN a_id ELSE b_id END AS kept_id, round(meters, 4) AS meters "
    "FROM t WHERE meters <= 60",
)
def seed_twins(spark, sf):
    seeds = _pairing(spark, sf)
    return dedup.twin_pairs(seeds, seeds).select("region", "gone_id", "kept_id", F.round("meters", 4).alias("meters"))


TWIN_SQL = (
    "s AS (SELECT *, (cash IS NOT NULL)::INT + (hours IS NOT NULL)::INT + (street <> '')::INT + (coalesce(number, '') <> '')::INT + (description IS NOT NULL)::INT AS score "
    "FROM n WHERE side = 0 AND length(nm) >= 4), t AS (SELECT a.region, a.id AS a_id, b.id AS b_id, a.score >= b.score AS first_stays, "
    f"{st.haversine_sql('a.lat', 'a.lng', 'b.lat', 'b.lng')} AS meters FROM s a JOIN s b ON a.region = b.region AND a.nm = b.nm AND a.ord < b.ord AND {st.near_sql('a', 'b')})"
)
BOTH = (
    "p AS (SELECT region, gone_id, kept_id, meters, sim, reason, CASE WHEN reason = 'B:dice' THEN 1 ELSE 0 END AS tier, 0 AS kind, gone_id AS o1, kept_id AS o2 FROM r WHERE reason IS NOT NULL "
    "UNION ALL SELECT region, CASE WHEN first_stays THEN b_id ELSE a_id END, CASE WHEN first_stays THEN a_id ELSE b_id END, meters, 1.0, 'twin', 0, 1, a_id, b_id FROM t WHERE meters <= 60)"
)
# A pair that is best for both its rows is taken; the rest goes into the next round.
BEST = ", ".join(
    f"row_number() OVER (PARTITION BY region, {side} ORDER BY tier, sim DESC, meters, kind, o1, o2) AS {name}" for side, name in (("gone_id", "g"), ("kept_id", "h"))
)
GREEDY_SQL = (
    f"{PAIR_SQL.replace('WITH ', 'WITH RECURSIVE ', 1)}, {TWIN_SQL}, {BOTH}, z AS (SELECT *, {BEST} FROM p UNION ALL "
    f"SELECT region, gone_id, kept_id, meters, sim, reason, tier, kind, o1, o2, {BEST} FROM z WHERE NOT (g = 1 AND h = 1) "
    "AND gone_id NOT IN (SELECT gone_id FROM z WHERE g = 1 AND h = 1) AND kept_id NOT IN (SELECT kept_id FROM z WHERE g = 1 AND h = 1)) "
    "SELECT region, gone_id, kept_id, round(meters, 4) AS meters, round(sim, 6) AS sim, reason, tier FROM z WHERE g = 1 AND h = 1"
)


def _sourced(spark, sf):
    kind = F.when(F.col("id") % 2 == 0, "hopfenstop").otherwise("osm")
    entry = F.array(F.struct(kind.alias("type"), F.col("id").cast("string").alias("id"), F.lit(None).cast("int").alias("version")))
    return _pairing(spark, sf).withColumn("sources", entry.cast(schema.SOURCES))


@query("WIN1 JN7 JN8", GREEDY_SQL)
def one_to_one_pairs(spark, sf):
    pairs = dedup.pair_and_assign(_sourced(spark, sf))
    return pairs.select("region", "gone_id", "kept_id", F.round("meters", 4).alias("meters"), F.round("sim", 6).alias("sim"), "reason", "tier")


TOTALS = ["features_before", "seed_only_before", "map_before", "tier_a_merged", "tier_b_review", "features_after"]


@query(
    "AGG10",
    f"WITH {st.cte('q0', PAIRING)}, x AS ({GREEDY_SQL}), u AS (SELECT CAST(region AS VARCHAR) AS region, 1 AS features_before, (id % 2 = 0)::INT AS seed_only_before, (id % 2 = 1)::INT AS map_before, "
    "0 AS tier_a_merged, 0 AS tier_b_review, (id NOT IN (SELECT gone_id FROM x WHERE tier = 0))::INT AS features_after FROM q0 UNION ALL "
    "SELECT CAST(region AS VARCHAR), 0, 0, 0, (tier = 0)::INT, (tier = 1)::INT, 0 FROM x) "
    "SELECT CASE WHEN grouping(region) = 1 THEN '(all)' ELSE region END AS region, " + ", ".join(f"sum({t})::BIGINT AS {t}" for t in TOTALS) + " FROM u GROUP BY ROLLUP (region)",
)
def dedup_totals(spark, sf):
    """Totals of a deduplication run, per region and overall."""
    rows = _sourced(spark, sf)
    return seed.dedup_totals(rows, dedup.pair_and_assign(rows))


@query(
    "SNK3",
    f"{PAIR_SQL}, b AS (SELECT r.*, row_number() OVER (PARTITION BY r.region, gone_id ORDER BY sim DESC, meters, kept_id) AS rn FROM r WHERE reason = 'B:dice') "
    "SELECT b.region || ',' || gone_id || ',' || kept_id || ',' || printf('%.1f', floor(meters * 10 + 0.5) / 10) || ',' || printf('%.2f', floor(sim * 100 + 0.5) / 100) || ',\"' || f.name || '\",\"' || c.name || '\",\"' "
    "|| trim(f.street || ' ' || coalesce(f.number, '')) || '\",\"' || trim(c.street || ' ' || coalesce(c.number, '')) || '\"' AS value "
    "FROM b JOIN q f ON f.id = gone_id JOIN q c ON c.id = kept_id WHERE rn = 1",
)
def pair_review_lines(spark, sf):
    rows = _pairing(spark, sf)
    pairs = dedup.cross_pairs(rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1")).filter(F.col("tier") == 1)
    best = F.min_by(F.struct("kept_id", "meters", "sim"), F.struct(-F.col("sim"), "meters", "kept_id"))
    top = pairs.groupBy("region", "gone_id").agg(best.alias("p")).select("region", "gone_id", "p.*")
    address = F.trim(F.concat_ws(" ", "address.street", F.coalesce("address.number", F.lit(""))))
    named = rows.select("id", "name", address.alias("addr"))
    gone = named.withColumnsRenamed({"id": "gone_id", "name": "hops_name", "addr": "hops_addr"})
    kept = named.withColumnsRenamed({"id": "kept_id", "name": "osm_name", "addr": "osm_addr"})
    review = top.join(gone, "gone_id").join(kept, "kept_id").withColumnsRenamed({"gone_id": "hops_id", "kept_id": "osm_id"})
    return writers.dedup_review_lines(review).select("value")


# Landed answers: three per feature, scattered around it.
ANSWERS = (
    "SELECT f.id AS feature_id, g.ord, f.lat + (g.ord - 1) * 0.0002 + (f.id % 13) * 0.00007 AS lat, f.lng + (f.id % 9) * 0.0001 - g.ord * 0.00005 AS lng, "
    "CASE WHEN (f.id + g.ord) % 4 <> 0 THEN 'P' || (f.id * 3 + g.ord) END AS place_id, "
    "CASE WHEN (f.id + g.ord) % 3 <> 0 THEN 'Street ' || (f.id % 40) END AS street, CASE WHEN (f.id + g.ord) % 5 < 2 THEN CAST(f.id % 50 AS VARCHAR) END AS housenumber, "
    "CASE (f.id + g.ord) % 6 WHEN 0 THEN 'Germany' WHEN 1 THEN 'France' WHEN 2 THEN 'España' WHEN 3 THEN 'Österreich' WHEN 4 THEN 'Polska' END AS country "
    "FROM f CROSS JOIN (VALUES (0), (1), (2)) g(ord)"
)


def answers(features):
    """Three stand-in answers per feature (id, lng, lat)."""
    o = F.col("ord")
    spread = features.select(F.col("id").alias("feature_id"), "lng", "lat", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("ord"))
    k = F.col("feature_id")
    return spread.select(
        "feature_id",
        "ord",
        (F.col("lat") + (o - 1) * F.lit(0.0002) + (k % 13) * F.lit(0.00007)).alias("lat"),
        (F.col("lng") + (k % 9) * F.lit(0.0001) - o * F.lit(0.00005)).alias("lng"),
        F.when((k + o) % 4 != 0, F.concat(F.lit("P"), (k * 3 + o).cast("string"))).alias("place_id"),
        F.when((k + o) % 3 != 0, F.concat(F.lit("Street "), (k % 40).cast("string"))).alias("street"),
        F.when((k + o) % 5 < 2, (k % 50).cast("string")).alias("housenumber"),
        F.element_at(F.create_map(*[F.lit(p) for p in (0, "Germany", 1, "France", 2, "España", 3, "Österreich", 4, "Polska")]), ((k + o) % 6).cast("int")).alias("country"),
    )


def _answer_sql(where: str, order: str, limit: str, columns: str) -> str:
    meters = st.haversine_sql("f.lat", "f.lng", "a.lat", "a.lng")
    return (
        f"WITH {ALL_POI}, a AS ({ANSWERS}), d AS (SELECT a.*, {meters} AS meters FROM a JOIN f ON f.id = a.feature_id WHERE {where}), "
        f"best AS (SELECT *, row_number() OVER (PARTITION BY feature_id ORDER BY {order}) AS rn FROM d WHERE meters <= {limit}) "
        f"SELECT feature_id, ord, round(meters, 4) AS meters, {columns} FROM best WHERE rn = 1"
    )


ALLOWED = ", ".join(f"'{c}'" for c in linking.COUNTRIES)
HIT_SCORE = "CASE WHEN street IS NOT NULL THEN 2 ELSE 0 END + CASE WHEN housenumber IS NOT NULL THEN 1 ELSE 0 END"


@query(
    "JN12 FLT20",
    _answer_sql(f"(country IS NULL OR country IN ({ALLOWED})) AND (street IS NOT NULL OR housenumber IS NOT NULL)", f"{HIT_SCORE} DESC, meters, ord", "50", "street, housenumber"),
)
def geocode_hits(spark, sf):
    f = _poi(spark, sf)
    return linking.best_geocode_hit(f, answers(f)).select("feature_id", "ord", F.round("meters", 4).alias("meters"), "street", "housenumber")


@query("JN13", _answer_sql("place_id IS NOT NULL", "meters, ord", "150", "place_id"))
def nearest_places(spark, sf):
    f = _poi(spark, sf)
    return linking.nearest_place(f, answers(f)).select("feature_id", "ord", F.round("meters", 4).alias("meters"), "place_id")


@query("JN14 JN16", _answer_sql("true", "ord", "50", "place_id"))
def first_results(spark, sf):
    f = _poi(spark, sf)
    return linking.first_result(f, answers(f)).select("feature_id", "ord", F.round("meters", 4).alias("meters"), "place_id")


REVIEW = [
    "CASE WHEN p_partkey % 10 = 0 THEN 'nowhere' ELSE 'all' END AS region",
    "CASE WHEN p_partkey % 9 = 0 THEN p_partkey + 1 ELSE p_partkey END AS feature_id",
    "CASE p_partkey % 8 WHEN 2 THEN 'area/5' ELSE 'node/' || CAST(p_partkey AS STRING) END AS osm_ref",
    "CASE WHEN p_partkey % 14 = 0 THEN ' ab ' ELSE p_name END AS osm_name",
]


def _review(spark, sf):
    f = _poi(spark, sf).withColumn("region", F.lit("all"))
    review = st.table(spark, sf, "part").selectExpr(*REVIEW)
    results = answers(_poi(spark, sf)).withColumn("region", F.lit("all"))
    return f, review, results


OUTCOME_SQL = (
    f"WITH {ALL_POI}, a AS ({ANSWERS}), rv AS (SELECT {', '.join(REVIEW)} FROM part), "
    f"near AS (SELECT DISTINCT feature_id FROM a JOIN f ON f.id = a.feature_id WHERE {st.haversine_sql('f.lat', 'f.lng', 'a.lat', 'a.lng')} <= 50), "
    "o AS (SELECT rv.*, CASE WHEN length(trim(osm_name)) < 3 THEN 'skipped' WHEN region <> 'all' OR f.id IS NULL THEN 'error' "
    "WHEN near.feature_id IS NULL THEN 'no-match' WHEN NOT regexp_matches(osm_ref, '^(node|way|relation)/[0-9]+$') THEN 'error' ELSE 'confirmed' END AS outcome "
    "FROM rv LEFT JOIN f ON f.id = rv.feature_id LEFT JOIN near ON near.feature_id = rv.feature_id)"
)


@query("JN15 PRJ18", f"{OUTCOME_SQL} SELECT region, feature_id, osm_ref, osm_name, outcome FROM o")
def review_outcomes(spark, sf):
    f, review, results = _review(spark, sf)
    return linking.confirm_review(review, f, results).select("region", "feature_id", "osm_ref", "osm_name", "outcome")


@query("AGG14", f"{OUTCOME_SQL} SELECT count(*) AS total, count_if(outcome = 'confirmed') AS confirmed, count_if(outcome = 'no-match') AS no_match, "
       "count_if(outcome = 'skipped') AS skipped, count_if(outcome = 'error') AS errored FROM o")
def review_counters(spark, sf):
    f, review, results = _review(spark, sf)
    o = F.col("outcome")
    flags = {"total": F.lit(True), "confirmed": o == "confirmed", "no_match": o == "no-match", "skipped": o == "skipped", "errored": o == "error"}
    return stats.count_flags(linking.confirm_review(review, f, results), flags)


@query("SNK4", f"{OUTCOME_SQL} SELECT region, feature_id, osm_ref, osm_name FROM o WHERE outcome <> 'confirmed'")
def remaining_review_rows(spark, sf):
    f, review, results = _review(spark, sf)
    return writers.remaining_review(review, linking.confirm_review(review, f, results))
