"""Whole jobs on the seed: deduplication, split by anchor, confirmed references, checked import."""

from __future__ import annotations

from pyspark.sql import functions as F

from poifuse import schema
from poifuse.catalog import standins as st
from poifuse.catalog.element_queries import CANDIDATE, LOCATED
from poifuse.catalog.feature_queries import EL, FRESH, FT, SINCE, SOURCES
from poifuse.catalog.registry import query
from poifuse.catalog.spatial_queries import GREEDY_SQL, _sourced
from poifuse.plans import backfill, refresh, seed


def _whole(rows):
    """Feature rows with every column of the model."""
    kinds = dict(schema.FEATURE_PROPERTIES)
    present = set(rows.columns)
    return rows.select("region", "ord", "lng", "lat", *[F.col(c) if c in present else F.lit(None).cast(kinds[c]).alias(c) for c in kinds])


# Pairs in assignment order; a pair whose kept row lost its own pair before has no effect. Rows that survive, and how many rows went into them.
ASSIGNED = GREEDY_SQL.rpartition(" SELECT region, gone_id, kept_id, round")[0]
ORDERED = "row_number() OVER (PARTITION BY region ORDER BY tier, sim DESC, meters, kind, o1, o2) AS place"


@query(
    "WIN1 MRG5",
    f"{ASSIGNED}, won AS (SELECT region, gone_id, kept_id, {ORDERED} FROM z WHERE g = 1 AND h = 1 AND tier = 0), "
    "visible AS (SELECT w.* FROM won w LEFT JOIN won l ON l.region = w.region AND l.gone_id = w.kept_id WHERE l.place IS NULL OR l.place > w.place), "
    "tree AS (SELECT kept_id AS root, gone_id AS node FROM visible UNION ALL SELECT tree.root, visible.gone_id FROM tree JOIN visible ON visible.kept_id = tree.node), "
    "k AS (SELECT root, count(*) AS merged FROM tree GROUP BY root) "
    "SELECT CAST(q.id AS VARCHAR) AS id, coalesce(k.merged, 0) AS merged, k.root IS NOT NULL AS touched FROM q LEFT JOIN k ON k.root = q.id WHERE q.id NOT IN (SELECT gone_id FROM won)",
)
def deduplicated_rows(spark, sf):
    """The deduplication job: rows left over, how many were merged into each, and whether the merge touched them."""
    rows = _whole(_sourced(spark, sf)).withColumn("id", F.col("id").cast("string"))
    merged, _, _ = seed.deduplicate(rows, st.AS_OF)
    own = merged.select("id", (F.size("sources") - 1).cast("long").alias("merged"), (F.col("updated") == st.AS_OF).alias("touched"))
    return own.withColumn("touched", F.coalesce("touched", F.lit(False)))


# Anchors at the edge of the radius, so that some rows are dropped.
EDGE = ["n_nationkey AS i", "n_name AS slug", "CAST(49.4665 - (n_nationkey % 5) * 0.1 AS DOUBLE) AS lat", "CAST(8.0 + FLOOR(n_nationkey / 5) * 0.004 AS DOUBLE) AS lng"]


@query(
    "JN2",
    f"WITH {FT}, {st.cte('a', [c.replace(' AS lat', ' AS alat').replace(' AS lng', ' AS alng') for c in EDGE], 'nation')}, "
    f"d AS (SELECT k, slug, {st.haversine_sql('alat', 'alng', 'lat', 'lng', '6371.0088')} AS km, i FROM ft, a), "
    "b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY km, i) AS rn FROM d) "
    "SELECT ft.id, CASE WHEN km <= 60 THEN slug ELSE region END AS region, CASE WHEN km > 60 THEN 'no anchor within radius' END AS dropped FROM ft JOIN b ON b.k = ft.k AND rn = 1",
)
def anchor_split_rows(spark, sf):
    anchors = [r.asDict() for r in st.table(spark, sf, "nation").selectExpr(*EDGE).orderBy("i").collect()]  # 25 rows
    kept, dropped = seed.split_by_anchor(st.features(spark, sf).drop("k"), anchors)
    return kept.select("id", "region", F.lit(None).cast("string").alias("dropped")).unionByName(dropped.select("id", "region", "dropped"))


# Review rows of every third feature; its search result is near, far or missing.
REVIEW = "CASE WHEN k % 12 = 3 THEN 'area/' ELSE 'node/9' END || k"


@query(
    "JN15 MRG10 PRJ18",
    f"WITH {FT} SELECT id, {SOURCES} || CASE WHEN k % 3 = 0 AND k % 4 <> 3 AND k % 5 <> 0 THEN CASE WHEN {SOURCES} = '' THEN '' ELSE ',' END || 'osm:node/9' || k ELSE '' END AS sources, "
    f"CASE WHEN k % 3 = 0 AND k % 4 <> 3 AND k % 5 <> 0 THEN '{st.AS_OF}' ELSE updated END AS updated FROM ft",
)
def confirmed_sources(spark, sf):
    """The confirmation job: features with the references that a near search result confirms."""
    f = st.features(spark, sf)
    k = F.col("k")
    ref = F.concat(F.when(k % 4 == 3, "area/").otherwise("node/9"), k.cast("string"))
    review = f.filter("k % 3 = 0").select("region", F.col("id").alias("feature_id"), ref.alias("osm_ref"), F.lit("a long name").alias("osm_name"))
    results = f.select("region", F.col("id").alias("feature_id"), (F.col("lat") + F.when(k % 5 == 0, 0.01).otherwise(0.0001)).alias("lat"), "lng")
    out, _ = seed.confirm_matches(f.drop("k"), review, results, st.AS_OF)
    return out.select("id", st.sources_text(F.col("sources")).alias("sources"), "updated")


@query(
    "SRC4 HRS1 JN10 PRJ5 DQ1",
    "SELECT printf('tk_fr_%04d', p_partkey) AS id, p_name AS name, CASE WHEN p_size % 3 <> 0 THEN 'Street ' || p_size END AS street, CASE WHEN p_size % 4 = 0 THEN '60311' END AS postalcode, "
    "CASE WHEN p_partkey % 5 = 0 THEN lower(p_type) ELSE '' END AS tags, 'hopfenstop:h' || p_partkey AS sources FROM part WHERE p_partkey % 7 <> 0",
)
def imported_seed(spark, sf):
    """The import job: seed records as features, checked against the schema; records without coordinates are skipped."""
    p = st.parts(spark, sf)
    k, none = F.col("p_partkey"), F.lit(None)
    address = F.struct(
        F.when(F.col("p_size") % 3 != 0, F.concat(F.lit(" Street "), F.col("p_size").cast("string"))).alias("street"), none.cast("string").alias("number"), F.lit(" ").alias("city"),
        F.when(F.col("p_size") % 4 == 0, "60311").otherwise("6031").alias("postalcode"), none.cast("string").alias("district"),
        F.when(k % 7 != 0, "50.1").alias("geolat"), F.lit("8.6").alias("geolng"),
    )
    label = lambda tag, votes: F.struct(tag.alias("tag"), F.struct(F.lit(votes).cast("int").alias("totalVotes")).alias("tagVotes"))
    labels = F.array(label(F.when(k % 5 == 0, F.col("p_type")), 1), label(F.lit("Unwanted"), -1), label(F.lit("Unknown"), 2))
    times = F.lit(None).cast("array<struct<day: string, openTime: array<int>, closeTime: array<int>>>")
    records = p.select(
        F.concat(F.lit("h"), k.cast("string")).alias("kioskId"), F.col("p_name").alias("name"), F.lit("").alias("description"), address.alias("address"),
        times.alias("kioskTimes"), labels.alias("kioskTags"), k.alias("ord"),
    )
    vocab = p.select(F.lower("p_type").alias("slug"), F.col("p_type").alias("de")).distinct().withColumn("ord", F.lit(0))
    out = seed.checked_import(records, vocab, "fr", st.AS_OF)
    return out.select("id", "name", "address.street", "address.postalcode", F.coalesce(F.array_join("tags", ","), F.lit("")).alias("tags"), st.sources_text(F.col("sources")).alias("sources"))


INSIDE = "coalesce(lng BETWEEN 5.87 AND 15.04 AND lat BETWEEN 47.27 AND 55.06, false)"


@query(
    "AGG8 FLT9 FLT14",
    f"WITH {FT}, {EL}, u AS (SELECT region, lng, lat, {FRESH} AS fresh, {INSIDE} AS inside FROM ft WHERE NOT s_osm), "
    "t AS (SELECT DISTINCT region, floor(lng / 0.5) * 0.5 AS x, floor(lat / 0.5) * 0.5 AS y FROM u WHERE fresh AND inside), "
    f"c AS (SELECT k, coalesce(lng, c_lng) AS lng, coalesce(lat, c_lat) AS lat FROM el WHERE {LOCATED} AND ({CANDIDATE})), "
    "s AS (SELECT region, count(DISTINCT k) AS candidates FROM t JOIN c ON c.lng BETWEEN x - 0.01 AND x + 0.51 AND c.lat BETWEEN y - 0.01 AND y + 0.51 GROUP BY 1), "
    "n AS (SELECT region, count(*) AS unlinked, count_if(NOT fresh) AS skipped_stale, count_if(fresh AND NOT inside) AS outside, count_if(fresh AND inside) AS asked FROM u GROUP BY 1) "
    "SELECT CASE WHEN grouping(region) = 1 THEN '(all)' ELSE region END AS region, sum((asked > 0)::INT)::BIGINT AS files, "
    + ", ".join(f"sum({c})::BIGINT AS {c}" for c in ("unlinked", "skipped_stale", "outside", "asked"))
    + ", sum(coalesce(candidates, 0))::BIGINT AS candidates FROM n LEFT JOIN s USING (region) GROUP BY ROLLUP (region)",
)
def backfill_scope_counters(spark, sf):
    """What a backfill run takes on, per region and overall."""
    elements = refresh.located(st.elements(spark, sf)).select("type", "id", "lng", "lat", "tags")
    return backfill.scope_counters(st.features(spark, sf), elements, SINCE)


# Landed geocoder answers: two of three features have one, with some parts missing.
HIT = {
    "street": "CASE WHEN k % 4 <> 0 THEN 'Weg' END",
    "housenumber": "CASE WHEN k % 5 < 3 THEN '7' END",
    "postcode": "'60311'",
    "city": "CASE WHEN k % 2 = 1 THEN 'Frankfurt' END",
    "district": "CASE WHEN k % 7 = 0 THEN 'Mitte' END",
}


@query(
    "AGG8 FLT15 JN12",
    f"WITH {FT}, a AS (SELECT * FROM ft WHERE coalesce(street, '') = '' OR coalesce(number, '') = ''), "
    f"h AS (SELECT id AS feature_id, {', '.join(f'{v} AS h_{c}' for c, v in HIT.items())} FROM ft WHERE k % 3 <> 0), "
    "j AS (SELECT a.*, h.*, feature_id IS NOT NULL AS matched FROM a LEFT JOIN h ON h.feature_id = a.id AND (h_street IS NOT NULL OR h_housenumber IS NOT NULL)) "
    "SELECT count(*) AS considered, count_if(matched)::BIGINT AS matched, count_if(NOT matched)::BIGINT AS no_match, "
    + ", ".join(f"count_if(h_{offer} IS NOT NULL AND coalesce({part}, '') = '')::BIGINT AS filled_{part}" for part, offer in backfill.FILLED.items())
    + ", false AS capped FROM j",
)
def geocode_outcomes(spark, sf):
    """What the landed geocoder answers can fill."""
    f = st.features(spark, sf)
    parts = [F.expr(v).alias(c) for c, v in HIT.items()]
    hits = f.filter("k % 3 <> 0").select(F.col("id").alias("feature_id"), F.lit(0).alias("ord"), "lng", "lat", *parts, F.lit("Germany").alias("country"))
    return backfill.geocode_counters(f, hits)
