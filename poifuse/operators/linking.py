"""Matching features of one source to those of another.

The radius matches first reduce both sides to distinct (place, name) sites:
what wins depends on nothing else, so any number of copies costs one
comparison. The answer is joined back to the rows with salted keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poifuse.functions import geo, provenance, text
from poifuse.operators import spatial
from poifuse.operators.skew import HOT_ROWS, salted_join

LINK_RADIUS_M, LINK_SIMILARITY = 30.0, 0.6
MATCH_RADIUS_M, UNCERTAIN_SCORE = 25.0, 0.5
PLACE_RADIUS_M, RESULT_RADIUS_M, GEOCODE_RADIUS_M = 150.0, 50.0, 50.0
# Country names accepted on geocoder hits.
COUNTRIES = [
    "Germany", "Deutschland", "Austria", "Österreich", "Switzerland", "Schweiz", "Suisse", "Svizzera",
    "Liechtenstein", "Luxembourg", "Luxemburg", "Italy", "Italien", "Italia", "Belgium", "Belgien", "België",
    "Belgique", "Spain", "Spanien", "España",
]


def _sites(df: DataFrame, side: str, keys: list[str], order: str | None = None) -> DataFrame:
    """Distinct (keys, place, normalised name) with its numbered bigrams, and the first row if ordered."""
    name, grams = f"{side}_name", f"{side}_grams"
    site = [*keys, "lng", "lat", name]
    named = df.withColumn(name, text.normalise_name(F.coalesce("name", F.lit(""))))
    if order is None:
        sites = named.select(*site).distinct()
    else:
        first = F.min(F.struct(F.col(order).alias("ord"), F.col("id").alias("id"))).alias("first")
        sites = named.groupBy(*site).agg(first)
        sites = sites.select(*site, F.col("first.ord").alias("right_ord"), F.col("first.id").alias("right_id"))
    return sites.withColumn(grams, text.bigram_multiset(F.col(name)))


def _similarity() -> Column:
    cols = ["left_name", "right_name", "left_grams", "right_grams"]
    return text.dice_multiset(*[F.col(c) for c in cols])


def _tokens(side: str) -> Column:
    """Bigrams to meet on in crowded cells; a name too short for bigrams stands for itself."""
    whole = F.xxhash64(F.col(f"{side}_name"))
    grams = F.col(f"{side}_grams")
    return F.when(F.size(grams) > 0, grams).otherwise(F.array(whole))


def _back_to_rows(df: DataFrame, near: DataFrame, choice: Column, keys: list[str], out: list[str]) -> DataFrame:
    """Best right row per site, given back to every row of the site."""
    site = [*keys, "lng", "lat", "left_name"]
    best = near.groupBy(*site).agg(choice.alias("best")).select(*site, "best.*")
    name = text.normalise_name(F.coalesce("name", F.lit("")))
    rows = df.select(*keys, F.col("id").alias("left_id"), "lng", "lat", name.alias("left_name"))
    return salted_join(rows, best, site).select(*keys, "left_id", *out)


def first_similar(
    fresh: DataFrame,
    existing: DataFrame,
    radius_m: float = LINK_RADIUS_M,
    min_similarity: float = LINK_SIMILARITY,
    order: str = "ord",
    keys: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """For every fresh row the first existing row (by `order`) that is near and similarly named.

    Both inputs have id, name, lng, lat (and the equality keys, if any).
    Result: keys, fresh_id, existing_id, meters, sim.
    """
    keys = keys or []
    left = _sites(fresh, "left", keys).filter(F.col("left_name") != "")
    right = _sites(existing, "right", keys, order).filter(F.col("right_name") != "")
    near = spatial.pairs_within(
        left, right, radius_m, tokens=_tokens, condition=lambda _: _similarity() >= min_similarity, hot_rows=hot_rows, keys=keys
    )
    choice = F.min_by(F.struct("right_id", "meters", _similarity().alias("sim")), F.struct("right_ord", "right_id"))
    matched = _back_to_rows(fresh, near, choice, keys, ["right_id", "meters", "sim"])
    return matched.withColumnsRenamed({"left_id": "fresh_id", "right_id": "existing_id"})


def without_near_duplicates(fresh: DataFrame, existing: DataFrame) -> DataFrame:
    """Fresh rows that no existing row of the same region shadows by place and name (no region column: one region)."""
    keys = ["region"] if "region" in fresh.columns and "region" in existing.columns else []
    shadowed = first_similar(fresh, existing, keys=keys).select(*keys, F.col("fresh_id").alias("id"))
    return fresh.join(shadowed, [*keys, "id"], "left_anti")


def match_score(similarity: Column, meters: Column) -> Column:
    return F.lit(0.55) * similarity + F.lit(0.45) * F.greatest(F.lit(0.0), 1 - meters / F.lit(MATCH_RADIUS_M))


def match_verdict(score: Column, meters: Column, similarity: Column) -> Column:
    """"accepted", "uncertain" (for review) or "rejected"."""
    accepted = (
        (score >= 0.65)
        | ((similarity >= 0.8) & (meters <= MATCH_RADIUS_M))
        | ((meters <= 15) & (similarity >= 0.45))
        | ((meters <= 3) & (similarity >= 0.25))
    )
    return F.when(accepted, "accepted").when(score >= UNCERTAIN_SCORE, "uncertain").otherwise("rejected")


def best_match(
    features: DataFrame, candidates: DataFrame, order: str = "ord", keys: list[str] | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Best-scoring candidate within 25 m of every feature; ties go to the first by `order`.

    Both inputs have id, name, lng, lat (and the equality keys, if any).
    Result: keys, feature_id, candidate_id, meters, sim, score, verdict. A pair
    without a common bigram scores by distance alone, so in crowded cells it is
    enough to compare the pairs that share one and the nearest candidate.
    """
    keys = keys or []
    left, right = _sites(features, "left", keys), _sites(candidates, "right", keys, order)
    hot = spatial.crowded_cells(left, right, MATCH_RADIUS_M, hot_rows)
    near = spatial.pairs_within(left, right, MATCH_RADIUS_M, tokens=_tokens, hot_rows=hot_rows, hot=hot, keys=keys)
    near = near.withColumn("sim", _similarity()).drop("left_grams", "right_grams", "right_lng", "right_lat")
    if hot:
        crowded = left.join(spatial.in_crowded_cells(left, hot, MATCH_RADIUS_M), ["lng", "lat"], "left_semi")
        closest = spatial.nearest_within(crowded, right.drop("right_grams"), MATCH_RADIUS_M, "right_ord", keys, hot_rows)
        named = left.join(closest, [*keys, "lng", "lat"]).withColumn("right_grams", text.bigram_multiset(F.col("right_name")))
        near = near.unionByName(named.withColumn("sim", _similarity()).select(near.columns))

    scored = near.withColumn("score", match_score(F.col("sim"), F.col("meters")))
    choice = F.min_by(F.struct("right_id", "meters", "sim", "score"), F.struct(-F.col("score"), "right_ord", "right_id"))
    matched = _back_to_rows(features, scored, choice, keys, ["right_id", "meters", "sim", "score"])
    matched = matched.withColumnsRenamed({"left_id": "feature_id", "right_id": "candidate_id"})
    return matched.withColumn("verdict", match_verdict(F.col("score"), F.col("meters"), F.col("sim")))


# Matching against landed answers. The answers carry the id of the asking
# feature; join and aggregation share that key, so there is one shuffle, and
# the minimum is taken before it where Spark can. Ids may repeat within and across
# regions: `keys` names further columns of the asking row (region, ord), which come
# back as f_region, f_ord, and every row then has an answer of its own.


def _answers(features: DataFrame, answers: DataFrame, keys: list[str]) -> DataFrame:
    place = features.select(F.col("id").alias("feature_id"), *[F.col(k).alias(f"f_{k}") for k in keys], F.col("lng").alias("f_lng"), F.col("lat").alias("f_lat"))
    meters = geo.haversine_m(F.col("f_lat"), F.col("f_lng"), F.col("lat"), F.col("lng"))
    return answers.join(place, "feature_id").withColumn("meters", meters).drop("f_lng", "f_lat")


def _pick(near: DataFrame, order: list, keys: list[str]) -> DataFrame:
    names = ["feature_id", *[f"f_{k}" for k in keys]]
    rest = [c for c in near.columns if c not in names]
    return near.groupBy(*names).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("best")).select(*names, "best.*")


def results_by_feature(results: DataFrame, fields: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Results of each asking feature in result order; a search returns a bounded list per feature."""
    named = results.filter(text.has_text(F.col("feature_id").cast("string")))
    listed = F.sort_array(F.collect_list(F.struct("ord", *fields)))
    return named.groupBy("feature_id", *keys).agg(listed.alias("results"))


def best_geocode_hit(features: DataFrame, hits: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Hit within 50 m with a street or number: street and number first, then distance."""
    street, number = text.has_text(F.col("street")), text.has_text(F.col("housenumber"))
    usable = hits.filter((F.col("country").isNull() | (F.col("country") == "") | F.col("country").isin(COUNTRIES)) & (street | number))
    near = _answers(features, usable, list(keys)).filter(F.col("meters") <= GEOCODE_RADIUS_M)
    near = near.withColumn("score", F.when(street, 2).otherwise(0) + F.when(number, 1).otherwise(0))
    return _pick(near, [-F.col("score"), F.col("meters"), F.col("ord")], list(keys))


def nearest_place(features: DataFrame, places: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Nearest place with an id within 150 m."""
    usable = places.filter(text.has_text(F.col("place_id")) & F.col("lat").isNotNull() & F.col("lng").isNotNull())
    near = _answers(features, usable, list(keys)).filter(F.col("meters") <= PLACE_RADIUS_M)
    return _pick(near, [F.col("meters"), F.col("ord")], list(keys))


def first_result(features: DataFrame, results: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """First search result, in result order, within 50 m."""
    near = _answers(features, results.filter(text.has_text(F.col("feature_id"))), list(keys))
    return _pick(near.filter(F.col("meters") <= RESULT_RADIUS_M), [F.col("ord")], list(keys))


def match_by_osm_id(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Existing and fresh rows that carry the same element id in the same region.

    Existing rows have region, id, ord, sources; fresh rows region, osm_id.
    Full outer: unmatched rows of either side appear with nulls.
    """
    ids = existing.select("region", "id", "ord", F.posexplode(provenance.osm_ids(F.col("sources"))).alias("pos", "osm_id"))
    return ids.join(fresh, ["region", "osm_id"], "full_outer")


def confirm_review(review: DataFrame, features: DataFrame, results: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Outcome of every review row: confirmed, no-match, skipped or error, with the reason.

    A row is confirmed when any search result lies within 50 m of its feature.
    Of rows that share region and id the first (by ord, if there is one) counts.
    failed: (region, feature_id) of searches that gave no answer; their rows are errors.
    """
    first = F.struct("ord", "lng", "lat") if "ord" in features.columns else F.struct("lng", "lat")
    place = features.groupBy("region", F.col("id").alias("feature_id")).agg(F.min_by(F.struct("lng", "lat"), first).alias("at"))
    place = place.select("region", "feature_id", F.col("at.lng").alias("f_lng"), F.col("at.lat").alias("f_lat"))
    known = features.select("region").distinct().withColumn("region_known", F.lit(True))
    rows = review.join(known, "region", "left").join(place, ["region", "feature_id"], "left")
    near = geo.haversine_m(F.col("f_lat"), F.col("f_lng"), F.col("lat"), F.col("lng")) <= RESULT_RADIUS_M
    hits = (
        results.join(place, ["region", "feature_id"])
        .groupBy("region", "feature_id")
        .agg(F.coalesce(F.bool_or(near), F.lit(False)).alias("near"))
    )
    detail = (
        F.when(F.length(F.trim("osm_name")) < 3, "name too short")
        .when(F.col("region_known").isNull(), "region file not found")
        .when(F.col("f_lng").isNull(), "feature not in region file")
        .when(F.coalesce("near", F.lit(False)) & provenance.osm_reference(F.col("osm_ref")).isNull(), "malformed osm_ref")
    )
    outcome = (
        F.when(F.col("detail") == "name too short", "skipped")
        .when(F.col("detail").isNotNull(), "error")
        .when(F.coalesce("near", F.lit(False)), "confirmed")
        .otherwise("no-match")
    )
    rows = rows.join(hits, ["region", "feature_id"], "left")
    if failed is not None:
        lost = failed.select("region", "feature_id").distinct().withColumn("lost", F.lit(True))
        rows = rows.join(lost, ["region", "feature_id"], "left")
        detail = F.coalesce(detail, F.when(F.col("lost"), "search failed"))
    judged = rows.withColumn("detail", detail).withColumn("outcome", outcome)
    return judged.select(*review.columns, "outcome", "detail")
