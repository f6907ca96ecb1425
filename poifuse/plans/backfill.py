"""Match features without a map source to map candidates and fill their blanks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poifuse import schema
from poifuse.functions import geo, rules, text
from poifuse.functions import provenance as prov
from poifuse.operators import dedup, linking, merge, stats
from poifuse.session import cut

TILE, TILE_PAD = 0.5, 0.01


@dataclass
class Backfilled:
    """Features after the fill, review rows, and one row of counters."""

    features: DataFrame
    review: DataFrame
    counters: DataFrame

ROW = ["region", "ord", "id"]  # ids repeat within and across regions


def is_fresh_since(since: str | None) -> Column:
    """Touched on or after the date; rows without any date count as stale."""
    if since is None:
        return F.lit(True)
    latest = F.greatest(F.col("created").try_cast("date"), F.col("updated").try_cast("date"))
    return F.coalesce(latest >= F.lit(since).cast("date"), F.lit(False))


def needs_address() -> Column:
    return ~(text.has_text(F.col("address.street")) & text.has_text(F.col("address.number")))


def unlinked(features: DataFrame) -> DataFrame:
    return features.filter(~prov.has_source(F.col("sources"), "osm"))


def in_scope(features: DataFrame, since: str | None) -> DataFrame:
    """Unlinked rows inside the sanity box and the time window; they decide which tiles count."""
    return unlinked(features).filter(geo.in_germany(F.col("lng"), F.col("lat")) & is_fresh_since(since))


def match_candidates(elements: DataFrame) -> DataFrame:
    """Elements that a feature may be matched to: a broader selection than what a refresh imports."""
    return elements.filter(rules.is_match_candidate(F.col("tags")))


def visible_candidates(scope: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates per region: those inside a padded tile that holds a row of its scope."""
    tiles = scope.select("region", F.floor(F.col("lng") / TILE).alias("tx"), F.floor(F.col("lat") / TILE).alias("ty")).distinct()

    def span(column: str) -> Column:
        return F.sequence(F.floor((F.col(column) - TILE_PAD) / TILE), F.floor((F.col(column) + TILE_PAD) / TILE))

    spread = candidates.withColumn("tx", F.explode(span("lng"))).withColumn("ty", F.explode(span("lat")))
    return spread.join(tiles, ["tx", "ty"]).drop("tx", "ty").distinct()


def backfill_from_map(
    features: DataFrame, elements: DataFrame, hits: DataFrame, as_of: str, since: str | None = None
) -> Backfilled:
    """elements: type, id, version, lng, lat, tags of candidate elements; hits: landed geocoder answers."""
    scope = in_scope(features, since)
    # overlapping tiles list an element more than once; the first counts
    elements = dedup.distinct_candidates(elements if "ord" in elements.columns else elements.withColumn("ord", F.lit(0)))
    sites = elements.select(
        F.struct("type", "id").alias("ord"), F.struct("type", "id").alias("id"), F.coalesce(F.col("tags")["name"], F.lit("")).alias("name"), "lng", "lat"
    )
    matches = linking.best_match(
        unlinked(features).select("region", F.struct("ord", "id").alias("id"), "name", "lng", "lat"), visible_candidates(scope, sites), keys=["region"]
    )
    matches = cut(matches.select("region", "feature_id.ord", "feature_id.id", *[c for c in matches.columns if c not in ("region", "feature_id")]))
    chosen = matches.filter(F.col("verdict") == "accepted").select(*ROW, "candidate_id")
    detail = elements.select(F.struct("type", "id").alias("candidate_id"), "version", F.col("tags").alias("c_tags"))
    joined = features.join(chosen.join(detail, "candidate_id"), ROW, "left")
    hit = F.col("candidate_id").isNotNull()
    changes, counts = merge.backfill(F.col("c_tags"), F.col("candidate_id.type"), F.col("candidate_id.id"), F.col("version"), as_of)
    counted = joined.select(
        *[F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in schema.FEATURE_COLUMNS],
        hit.cast("int").alias("matched"),
        *[F.when(hit, n).otherwise(0).alias(name) for name, n in counts.items()],
    )
    measures = ["matched", *counts]
    totals = counted.agg(*[F.sum(m).alias(m) for m in measures])
    filled = fill_addresses(counted.select(schema.FEATURE_COLUMNS), scope.select(ROW), hits, as_of)

    review = matches.filter(F.col("verdict") == "uncertain").join(
        elements.select(F.struct("type", "id").alias("candidate_id"), F.col("tags")["name"].alias("osm_name")), "candidate_id"
    )
    named = review.join(features.select(*ROW, F.col("name").alias("feature_name")), ROW)
    rows = named.select(
        "region",
        F.col("id").alias("feature_id"),
        "feature_name",
        F.concat(F.col("candidate_id.type"), F.lit("/"), F.col("candidate_id.id").cast("string")).alias("osm_ref"),
        F.coalesce("osm_name", F.lit("")).alias("osm_name"),
        "score",
        F.col("meters").alias("distance_m"),
        F.col("sim").alias("name_sim"),
    )
    return Backfilled(filled, rows, totals)


def fill_addresses(features: DataFrame, scope: DataFrame, hits: DataFrame, as_of: str, budget: int | None = None) -> DataFrame:
    """Fill blank address parts of in-scope rows from the best geocoder hit.

    A budget limits how many rows are asked, in id order.
    """
    asking = features.join(scope, ROW, "left_semi").filter(needs_address())
    if budget is not None:
        asking = asking.orderBy("region", "id", "ord").limit(budget)
    answer = _hits(asking, hits)
    return merge.rewrite(features.join(answer, ROW, "left"), merge.fill_address(F.col("hit"), as_of))


def _hits(asking: DataFrame, hits: DataFrame) -> DataFrame:
    best = linking.best_geocode_hit(asking.select(*ROW, "lng", "lat"), hits.drop("region"), ("region", "ord"))
    fields = ["street", "housenumber", "postcode", "city", "district"]
    return best.select(F.col("f_region").alias("region"), F.col("f_ord").alias("ord"), F.col("feature_id").alias("id"), F.struct(*fields).alias("hit"))


FILLED = {"street": "street", "number": "housenumber", "postalcode": "postcode", "city": "city", "district": "district"}


def geocode_counters(features: DataFrame, hits: DataFrame, budget: int | None = None) -> DataFrame:
    """How many rows lack an address, how many a hit can help, which parts it fills, and whether the budget left rows out."""
    lacking = features.filter(needs_address())
    asking = lacking if budget is None else lacking.orderBy("region", "id", "ord").limit(budget)
    joined = asking.join(_hits(asking, hits), ROW, "left")
    matched = F.col("hit").isNotNull()
    flags = {"considered": F.lit(True), "matched": matched, "no_match": ~matched}
    for part, offer in FILLED.items():
        flags[f"filled_{part}"] = matched & text.has_text(F.col(f"hit.{offer}")) & ~F.coalesce(text.has_text(F.col(f"address.{part}")), F.lit(False))
    counts = stats.count_flags(joined, flags)
    left_out = lacking.agg(F.count(F.lit(1)).alias("lacking"))
    rows = counts.withColumn("lacking", F.lit(0).cast("long")).unionByName(left_out.select(*[F.lit(0).cast("long").alias(c) for c in flags], "lacking"))
    summed = rows.agg(*[F.sum(c).alias(c) for c in [*flags, "lacking"]])
    return summed.select(*flags, (F.col("lacking") > F.col("considered")).alias("capped"))


SCOPE_COUNTERS = ["files", "unlinked", "skipped_stale", "outside", "asked", "candidates"]


def scope_counters(features: DataFrame, elements: DataFrame, since: str | None = None) -> DataFrame:
    """What a backfill run takes on, per region and overall, before it matches anything.

    unlinked rows are skipped_stale, outside the sanity box, or asked; candidates are
    the elements in the tiles of a region's asked rows, listed once however many tiles
    show them; files are regions with asked rows. elements: type, id, lng, lat, tags.
    """
    fresh, inside = is_fresh_since(since), F.coalesce(geo.in_germany(F.col("lng"), F.col("lat")), F.lit(False))
    flags = {"unlinked": F.lit(True), "skipped_stale": ~fresh, "outside": fresh & ~inside, "asked": fresh & inside}
    rows = stats.count_flags(unlinked(features), flags, ["region"])
    listed = dedup.distinct_candidates(elements if "ord" in elements.columns else elements.withColumn("ord", F.lit(0)))
    seen = visible_candidates(in_scope(features, since), match_candidates(listed).select("type", "id", "lng", "lat"))
    seen = seen.groupBy("region").agg(F.count(F.lit(1)).alias("candidates"))
    joined = rows.join(seen, "region", "left").fillna(0, ["candidates"]).withColumn("files", (F.col("asked") > 0).cast("int"))
    return stats.rolled_up_sums(joined, "region", SCOPE_COUNTERS)
