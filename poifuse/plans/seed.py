"""Import of the community seed, attribution of its fields, clean-up and review confirmation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poifuse import schema
from poifuse.functions import geo, text
from poifuse.functions import hours as hrs
from poifuse.functions import provenance as prov
from poifuse.operators import dedup, linking, merge, quality, schema_rules, spatial, stats
from poifuse.sources import writers


def kept_labels(seed: DataFrame) -> DataFrame:
    """One row per label that the community did not vote down: ord, pos, tag."""
    spread = seed.select("ord", F.posexplode("kioskTags").alias("pos", "entry")).select("ord", "pos", "entry.*")
    votes = F.coalesce("tagVotes.totalVotes", F.lit(0))
    return spread.filter(text.has_text(F.col("tag")) & (votes >= 0)).select("ord", "pos", "tag")


def seed_labels(seed: DataFrame, vocab: DataFrame) -> DataFrame:
    placed = seed.filter(_has_place(seed))
    return quality.match_vocabulary(kept_labels(placed), vocab)


def _has_place(seed: DataFrame) -> Column:
    return geo.parse_coordinate(F.col("address.geolng")).isNotNull() & geo.parse_coordinate(F.col("address.geolat")).isNotNull()


def import_seed(seed: DataFrame, vocab: DataFrame, region: str, as_of: str) -> DataFrame:
    """Seed records (with 1-based ord) as features; records without coordinates are skipped."""
    labels = seed_labels(seed, vocab).filter(F.col("slug").isNotNull())
    slugs = labels.groupBy("ord").agg(F.sort_array(F.collect_list(F.struct("pos", "slug"))).alias("found"))
    slugs = slugs.select("ord", F.array_distinct(F.transform("found", lambda f: f["slug"])).alias("slugs"))
    joined = seed.filter(_has_place(seed)).join(slugs, "ord", "left")
    address = {key: text.clean_string(F.col(f"address.{key}")) for key in schema.ADDRESS_KEYS}
    address["postalcode"] = text.postcode(address["postalcode"])
    hours = hrs.seed_hours(F.col("kioskTimes"))
    none = F.lit(None)
    columns = {
        "region": F.lit(region),
        "ord": F.col("ord"),
        "lng": geo.parse_coordinate(F.col("address.geolng")),
        "lat": geo.parse_coordinate(F.col("address.geolat")),
        "id": F.format_string("tk_fr_%04d", F.col("ord")),
        "name": F.col("name"),
        "description": F.when(F.col("description") != "", F.col("description")),
        "address": F.struct(*[value.alias(key) for key, value in address.items()]),
        "hours": F.when(hours.isNotNull(), F.struct(hours.alias("raw"))),
        "tags": F.col("slugs"),
        "payment": none.cast(schema.PAYMENT),
        "sources": F.array(prov.source_entry("hopfenstop", F.col("kioskId"))),
        "osm_removed": none.cast("boolean"),
        "kind": none.cast("string"),
        "created": F.lit(as_of),
        "updated": F.lit(as_of),
        "apple_id_attempted": none.cast("string"),
        "apple_attempted": none.cast("string"),
        "google_attempted": none.cast("string"),
        "sources_by_field": none.cast(schema.STAMPS),
    }
    return joined.select(*[value.alias(name) for name, value in columns.items()])


def checked_import(seed: DataFrame, vocab: DataFrame, region: str, as_of: str) -> DataFrame:
    """import_seed, but nothing comes out if a feature would break the schema: SchemaError names the rules."""
    features = import_seed(seed, vocab, region, as_of)
    schema_rules.require_valid(features.select("region", "id", writers.feature_json().alias("value")))
    return features


def attribution_counts(stamped: DataFrame) -> DataFrame:
    """Stamps per region file and path, with totals."""
    paths = stamped.select("region", F.explode("stamped_paths").alias("path"))
    return stats.rolled_up_counts(paths, ["region", "path"])


def clean_hours(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features without degenerate hours, and per region how many were cleaned with three examples."""
    bad, changes = merge.drop_degenerate_hours()
    cleaned = features.filter(bad)
    listed = F.to_json(F.array("hours.raw"))
    shown = F.concat(F.col("id"), F.lit(": "), F.substring(listed, F.lit(2), F.length(listed) - 2))
    return merge.rewrite(features, changes), stats.examples_per_group(cleaned, "region", "ord", shown)


def deduplicate(features: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Merged features, tier-B pairs for review, and totals per region and overall."""
    pairs = dedup.pair_and_assign(features)
    merged = merge.apply_absorptions(features, pairs, as_of)
    address = F.trim(F.concat_ws(" ", F.coalesce("address.street", F.lit("")), F.coalesce("address.number", F.lit(""))))
    rows = features.select("region", "id", "name", address.alias("addr"))
    gone = rows.withColumnsRenamed({"id": "gone_id", "name": "hops_name", "addr": "hops_addr"})
    kept = rows.withColumnsRenamed({"id": "kept_id", "name": "osm_name", "addr": "osm_addr"})
    review = pairs.filter(F.col("tier") == 1).join(gone, ["region", "gone_id"]).join(kept, ["region", "kept_id"])
    review = review.select(
        F.regexp_replace("region", r"^data/de/|\.geojson$", "").alias("region"),
        F.col("gone_id").alias("hops_id"),
        F.col("kept_id").alias("osm_id"),
        "meters",
        "sim",
        "hops_name",
        "osm_name",
        "hops_addr",
        "osm_addr",
    )
    return merged, review, dedup_totals(features, pairs)


def dedup_totals(features: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per region and overall: rows before, seed-only and map rows before, merged pairs, pairs for review, rows after."""
    s = F.col("sources")
    seed_only = prov.has_source(s, "hopfenstop") & ~prov.has_source(s, "osm")
    measures = ["features_before", "seed_only_before", "map_before", "tier_a_merged", "tier_b_review", "features_after"]

    def counted(df: DataFrame, **flags: Column) -> DataFrame:
        return df.select("region", *[flags.get(m, F.lit(0)).cast("int").alias(m) for m in measures])

    gone = pairs.filter(F.col("tier") == 0).select("region", F.col("gone_id").alias("id"))
    before = counted(features, features_before=F.lit(1), seed_only_before=seed_only, map_before=prov.has_source(s, "osm"))
    paired = counted(pairs, tier_a_merged=F.col("tier") == 0, tier_b_review=F.col("tier") == 1)
    after = counted(features.join(gone, ["region", "id"], "left_anti"), features_after=F.lit(1))
    return stats.rolled_up_sums(before.unionByName(paired).unionByName(after), "region", measures)


def confirm_matches(features: DataFrame, review: DataFrame, results: DataFrame, as_of: str, failed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Features with confirmed references added, and the outcome of every review row; failed: searches without an answer."""
    outcome = linking.confirm_review(review, features, results, failed)
    confirmed = outcome.filter(F.col("outcome") == "confirmed").groupBy("region", F.col("feature_id").alias("id"))
    joined = features.join(confirmed.agg(F.sort_array(F.collect_set("osm_ref")).alias("refs")), ["region", "id"], "left")
    return merge.rewrite(joined, merge.confirm_sources(F.col("refs"), as_of)), outcome


def split_by_anchor(features: DataFrame, anchors: list[dict]) -> tuple[DataFrame, DataFrame]:
    """Features moved to the region of their nearest anchor, and the dropped ones with the reason."""
    placed = spatial.nearest_anchor(features, anchors)
    kept = placed.filter(F.col("dropped").isNull()).withColumn("region", F.col("anchor")).select(schema.FEATURE_COLUMNS)
    return kept, placed.filter(F.col("dropped").isNotNull()).select("region", "id", "dropped", "km")
