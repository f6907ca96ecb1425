"""Snapshot refresh: lay a fresh map snapshot over the existing table, all regions at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poifuse import schema
from poifuse.functions import hours as hrs
from poifuse.functions import provenance as prov
from poifuse.functions import rules
from poifuse.operators import dedup, linking, merge, quality, spatial, stats
from poifuse.session import cut

ID = ["region", "id"]


@dataclass
class Refreshed:
    """New snapshot, and one row per (region, action) event for the run counters."""

    features: DataFrame
    actions: DataFrame

    def counters(self) -> DataFrame:
        return stats.refresh_counters(self.actions)


def located(elements: DataFrame) -> DataFrame:
    """Elements with a position, taken from the element or its centre."""
    placed = elements.withColumn("lat", F.coalesce("lat", "center.lat")).withColumn("lng", F.coalesce("lon", "center.lon"))
    placed = placed.withColumn("version", F.coalesce("version", F.lit(0)))
    return placed.drop("center", "lon").filter(F.col("lat").isNotNull() & F.col("lng").isNotNull())


def element_ref(kind: Column, number: Column) -> Column:
    """Source id of an element; whatever is not a node is filed as a way."""
    return F.concat(F.when(kind == "node", "node/").otherwise("way/"), number.cast("string"))


def feature_columns(prefix: Column, as_of: str) -> dict[str, Column]:
    """Feature columns of an element row (type, number, version, lng, lat, element_tags, region, ord)."""
    tags = F.col("element_tags")
    address = rules.address_from_tags(tags)
    hours = hrs.clean_opening_hours(rules.tag(tags, "opening_hours"))
    payment = rules.map_payment(tags)
    slugs = rules.map_tags(tags)
    stamps = {"name": F.lit("osm"), "hours": F.when(hours.isNotNull(), "osm")}
    stamps |= {f"address.{key}": F.when(value.isNotNull(), "osm") for key, value in address.items()}
    stamps |= {f"payment.{key}": F.when(payment.isNotNull(), "osm") for key in schema.PAYMENT_KEYS}
    element = prov.source_entry("osm", element_ref(F.col("type"), F.col("number")), F.col("version"))
    none = F.lit(None)
    return {
        "region": F.col("region"),
        "ord": F.col("ord"),
        "lng": F.col("lng"),
        "lat": F.col("lat"),
        "id": F.concat(F.lit("tk_"), prefix, F.lit("_osm_"), F.substring("type", 1, 1), F.col("number").cast("string")),
        "name": rules.tag(tags, "name"),
        "description": none.cast("string"),
        "address": F.struct(*[value.alias(key) for key, value in address.items()]),
        "hours": F.when(hours.isNotNull(), F.struct(hours.alias("raw"))),
        "tags": F.when(F.size(slugs) > 0, slugs),
        "payment": payment,
        "sources": F.array(element),
        "osm_removed": none.cast("boolean"),
        "kind": rules.detect_kind(tags),
        "created": F.lit(as_of),
        "updated": F.lit(as_of),
        "apple_id_attempted": none.cast("string"),
        "apple_attempted": none.cast("string"),
        "google_attempted": none.cast("string"),
        "sources_by_field": prov.put_stamps(none.cast(schema.STAMPS), stamps),
    }


def elements_to_features(elements: DataFrame, regions: DataFrame, as_of: str) -> DataFrame:
    """Wanted elements as feature rows. Elements carry the region that asked for them, and ord."""
    codes = regions.select(F.col("slug").alias("region"), "prefix", "iso3166_2")
    wanted = located(elements).join(codes, "region").filter(rules.is_wanted(F.col("tags"), F.col("iso3166_2")))
    wanted = wanted.withColumnsRenamed({"tags": "element_tags", "id": "number"})
    return wanted.select(*[value.alias(name) for name, value in feature_columns(F.col("prefix"), as_of).items()])


def purge_markets(existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Existing rows without beverage markets, and the dropped ones."""
    market = prov.has_source(F.col("sources"), "osm") & rules.name_is_beverage_market(F.col("name"))
    return existing.filter(~market), existing.filter(market)


def confirmed_gone(existing: DataFrame, fresh_ids: DataFrame, still_wanted: DataFrame, failed: DataFrame) -> DataFrame:
    """Live map-only ids that the snapshot lacks and a lookup by id does not bring back.

    fresh_ids and still_wanted have region and osm_id; failed has region and query_group.
    """
    live = existing.filter(prov.is_osm_only(F.col("sources")) & ~F.coalesce("osm_removed", F.lit(False)))
    live = live.withColumn("query_group", rules.group_of_kind(F.col("kind")))
    asked = live.join(failed.select("region", "query_group"), ["region", "query_group"], "left_anti")
    ids = asked.select("region", F.explode(prov.osm_ids(F.col("sources"))).alias("osm_id")).distinct()
    keys = ["region", "osm_id"]
    return ids.join(fresh_ids.select(keys), keys, "left_anti").join(still_wanted.select(keys), keys, "left_anti")


def _events(df: DataFrame, action: str) -> DataFrame:
    return df.select("region", F.lit(action).alias("action"))


def refresh_snapshot(
    existing: DataFrame,
    fresh: DataFrame,
    regions: DataFrame,
    still_wanted: DataFrame,
    failed: DataFrame,
    keep_local_id: bool = False,
) -> Refreshed:
    """Refresh, flag, link and append. Inputs are feature tables; `fresh` carries the asking region.

    still_wanted: (region, osm_id) that a lookup by id confirmed; failed:
    (region, query_group) whose query gave no answer.
    """
    existing, markets = purge_markets(existing)
    owned = spatial.assign_region(fresh, regions)
    foreign = F.col("owner").isNotNull() & (F.col("owner") != F.col("region"))
    foreign_fresh = owned.filter(foreign)
    fresh = owned.filter(~F.coalesce(foreign, F.lit(False))).withColumn("osm_id", F.col("sources")[0]["id"])
    rest = [c for c in fresh.columns if c not in ("region", "osm_id", "owner")]
    fresh = fresh.groupBy("region", "osm_id").agg(F.max_by(F.struct(*rest), F.col("ord")).alias("row"))
    fresh = cut(fresh.select("region", "osm_id", *[F.col(f"row.{c}").alias(c) for c in rest]))
    fresh_ids = fresh.select("region", "osm_id")
    gone = confirmed_gone(existing, fresh_ids, still_wanted, failed)

    # One edge per (row, element id), with what the snapshot and the lookup say about it.
    existing = spatial.assign_region(existing, regions)
    edges = existing.select(
        *ID, "ord", "owner", prov.is_osm_only(F.col("sources")).alias("osm_only"), F.explode(prov.osm_ids(F.col("sources"))).alias("osm_id")
    )
    edges = edges.join(fresh_ids.withColumn("in_fresh", F.lit(True)), ["region", "osm_id"], "left")
    edges = edges.join(gone.withColumn("is_gone", F.lit(True)), ["region", "osm_id"], "left")
    facts = edges.groupBy(*ID, "ord").agg(
        F.coalesce(F.bool_or("in_fresh"), F.lit(False)).alias("in_fresh"),
        F.bool_and(F.coalesce("is_gone", F.lit(False))).alias("all_gone"),
        F.first("osm_only").alias("osm_only"),
        F.first("owner").alias("owner"),
    )
    moved = F.col("osm_only") & ~F.col("in_fresh") & F.coalesce(F.col("owner") != F.col("region"), F.lit(False))
    facts = cut(facts.withColumn("moved", moved))
    staying = edges.select(*ID, "ord", "osm_id").join(facts.filter(~F.col("moved")).select(ID), ID, "left_semi")
    kept_edges = cut(dedup.first_row_per_id(staying))
    kept = kept_edges.select(*ID).distinct()

    # Rows that moved to another region; those that repeat a kept row's id do not count.
    first_kept = kept_edges.groupBy("region", "osm_id").agg(F.min("ord").alias("kept_ord"))
    moved_rows = facts.filter("moved").select(ID)
    repeats = (
        edges.join(moved_rows, ID, "left_semi").join(first_kept, ["region", "osm_id"]).filter(F.col("kept_ord") < F.col("ord")).select(ID).distinct()
    )
    moved_away = moved_rows.join(repeats, ID, "left_anti")

    base = existing.select(schema.FEATURE_COLUMNS)
    no_osm = base.filter(~prov.has_source(F.col("sources"), "osm"))
    hits = kept_edges.join(fresh_ids, ["region", "osm_id"], "left_semi").select(*ID, "osm_id")
    row = F.struct(*schema.FEATURE_COLUMNS)
    local = base.select(*ID, row.alias("local"))
    new = fresh.select("region", "osm_id", F.struct(*schema.FEATURE_COLUMNS).alias("fresh"))
    joined = hits.join(local, ID).join(new, ["region", "osm_id"])
    refreshed = joined.select(*[c.alias(n) for n, c in merge.refresh(F.col("local"), F.col("fresh"), keep_local_id).items()])
    refreshed = refreshed.select(schema.FEATURE_COLUMNS)

    quiet = base.join(kept, ID, "left_semi").join(hits.select(ID), ID, "left_anti").join(facts.select(*ID, "all_gone", "osm_only"), ID)
    was = F.coalesce("osm_removed", F.lit(False))
    quiet = quiet.withColumn("flag", merge.removal_flag(F.col("all_gone")))
    quiet = quiet.withColumn("newly_removed", F.coalesce("flag", F.lit(False)) & ~was)
    unrefreshed = merge.rewrite(quiet, {"osm_removed": F.col("flag")})

    # Link what is left of the snapshot to rows without a map source, append the rest.
    left_over = fresh.join(hits.select("region", "osm_id"), ["region", "osm_id"], "left_anti")
    poi = left_over.select("region", F.col("osm_id").alias("id"), "name", "lng", "lat")
    links = linking.first_similar(poi, no_osm.select(*ID, "ord", "name", "lng", "lat"), keys=["region"])
    links = cut(links.select("region", F.col("fresh_id").alias("osm_id"), F.col("existing_id").alias("id")))
    linked = links.join(left_over.select("region", "osm_id", F.col("ord").alias("at"), "tags", "updated"), ["region", "osm_id"])
    per_row = linked.groupBy(*ID).agg(
        F.sort_array(F.collect_list(F.struct("at", "osm_id"))).alias("entries"),
        F.array_distinct(F.flatten(F.collect_list("tags"))).alias("new_tags"),
        F.max_by("updated", "at").alias("link_date"),
    )
    per_row = per_row.withColumn("osm_ids", F.transform("entries", lambda e: e["osm_id"]))
    with_links = no_osm.join(per_row.select(*ID, "osm_ids", "new_tags", "link_date"), ID, "left")
    kept_plain = merge.rewrite(with_links, merge.link_sources(F.col("osm_ids"), F.col("new_tags"), F.col("link_date")))
    added = left_over.join(links.select("region", "osm_id"), ["region", "osm_id"], "left_anti").select(schema.FEATURE_COLUMNS)

    features = refreshed.unionByName(unrefreshed).unionByName(kept_plain).unionByName(added)
    actions = _events(added, "added")
    for df, action in (
        (hits.select(ID).distinct(), "updated"),
        (quiet.filter("newly_removed"), "removed"),
        (no_osm, "kept_non_osm"),
        (links, "linked_non_osm"),
        (foreign_fresh, "cross_region_dropped"),
        (moved_away, "cross_region_dropped"),
        (markets, "dropped_market"),
    ):
        actions = actions.unionByName(_events(df, action))
    return Refreshed(features, actions)


def refresh_from_answers(
    existing: DataFrame,
    elements: DataFrame,
    regions: DataFrame,
    lookup: DataFrame,
    as_of: str,
    asked: DataFrame | None = None,
    lookup_failed: DataFrame | None = None,
) -> Refreshed:
    """Whole refresh from landed answers.

    elements: element rows with region, query_group, mirror, ord; an answer
    without elements is one row with a null id. lookup: elements found by id,
    with region. asked: the (region, query_group) that were asked; by default the
    kiosk group of every region and every group that an existing row of the region
    is in. lookup_failed: regions whose lookup by id gave no answer. A group
    without any answer counts as one without an acceptable answer: regions whose
    kiosk group has none, or whose lookup failed, keep their rows unchanged, and
    rows of other groups are not flagged.
    """
    live, _ = purge_markets(existing)
    answers = elements.withColumn("osm_id", F.concat("type", F.lit("/"), F.col("id").cast("string")))
    shares = quality.missing_share(quality.expected_ids(live), answers)
    if asked is None:
        slugs = regions.select(F.col("slug").alias("region"))
        named = live.select("region", rules.group_of_kind(F.col("kind")).alias("query_group")).join(slugs, "region", "left_semi")
        asked = slugs.withColumn("query_group", F.lit("kiosk")).union(named).distinct()
    status = cut(quality.judged_groups(asked, quality.accept_answers(shares)))
    dead = status.filter(F.col("status") == "region failed").select("region")
    if lookup_failed is not None:
        dead = dead.union(lookup_failed.select("region"))
    dead = dead.distinct()
    failed = status.filter(F.col("status") == "group frozen").select("region", "query_group")
    good = status.filter(F.col("status") == "accepted").select("region", "query_group", "mirror")
    used = elements.filter(F.col("id").isNotNull()).join(good, ["region", "query_group", "mirror"], "left_semi")
    used = used.join(dead, "region", "left_anti")
    codes = regions.select(F.col("slug").alias("region"), "iso3166_2")
    found = lookup.join(codes, "region").filter(rules.is_wanted(F.col("tags"), F.col("iso3166_2")))
    still = found.select("region", F.concat("type", F.lit("/"), F.col("id").cast("string")).alias("osm_id"))
    active = existing.join(dead, "region", "left_anti")
    result = refresh_snapshot(active, elements_to_features(used, regions, as_of), regions, still, failed)
    frozen = existing.join(dead, "region", "left_semi").select(schema.FEATURE_COLUMNS)
    return Refreshed(result.features.unionByName(frozen), result.actions)
