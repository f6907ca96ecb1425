"""Field-by-field merges. Each returns the changed columns of a feature as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poifuse import schema
from poifuse.functions import hours as hrs
from poifuse.functions import payment as pay
from poifuse.functions import provenance as prov
from poifuse.functions import rules, text
from poifuse.operators.dedup import without_claimed
from poifuse.session import cut


def _present(stamp: Column) -> Column:
    return F.when(stamp != "", stamp)


def _struct(values: dict[str, Column]) -> Column:
    return F.struct(*[value.alias(key) for key, value in values.items()])


def rewrite(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Features with some columns replaced, the others taken as they are."""
    return df.select(*[changes[c].alias(c) if c in changes else F.col(c) for c in schema.FEATURE_COLUMNS])


def refresh(local: Column, fresh: Column, keep_local_id: bool = False) -> dict[str, Column]:
    """A fresh row laid over its local row.

    Fresh values win unless the local field has a higher-ranked stamp or fresh
    has none; stamps follow the chosen value. The id is the fresh one.
    """
    l_stamps, f_stamps = local["sources_by_field"], fresh["sources_by_field"]
    stamps: dict[str, Column] = {}

    def take_local(path: str, local_value: Column, fresh_value: Column) -> Column:
        mine, theirs = prov.stamp_of(l_stamps, path), prov.stamp_of(f_stamps, path)
        take = local_value.isNotNull() & (fresh_value.isNull() | (prov.rank_of(mine) > prov.rank_of(theirs)))
        stamps[path] = F.when(take, _present(mine))
        return take

    out = {"region": local["region"], "ord": local["ord"], "lng": fresh["lng"], "lat": fresh["lat"]}
    out["id"] = local["id"] if keep_local_id else fresh["id"]
    for path in ("name", "description"):
        out[path] = F.when(take_local(path, local[path], fresh[path]), local[path]).otherwise(fresh[path])
    out["hours"] = F.when(take_local("hours", local["hours"], fresh["hours"]), local["hours"]).otherwise(fresh["hours"])
    for group, keys in (("address", schema.ADDRESS_KEYS), ("payment", schema.PAYMENT_KEYS)):
        values = {}
        for key in keys:
            mine, theirs = local[group][key], fresh[group][key]
            take = take_local(f"{group}.{key}", F.when(mine != "", mine), F.when(theirs != "", theirs))
            values[key] = F.when(take, mine).otherwise(theirs)
        out[group] = _struct(values)
    out["tags"] = F.coalesce(prov.union_tags(local["tags"], fresh["tags"]), fresh["tags"])
    out["sources"] = prov.union_sources(fresh["sources"], local["sources"])
    out["osm_removed"] = F.lit(None).cast("boolean")
    out["kind"] = fresh["kind"]
    out["created"] = F.coalesce(local["created"], fresh["created"])
    out["updated"] = fresh["updated"]
    for stamp in ("apple_id_attempted", "apple_attempted", "google_attempted"):
        out[stamp] = F.coalesce(local[stamp], fresh[stamp])
    out["sources_by_field"] = prov.put_stamps(F.coalesce(f_stamps, F.create_map().cast(schema.STAMPS)), stamps)
    return out


def _write_address(address: Column, stamps: Column, offers: dict[str, Column], source: str, overwrite: bool):
    values, changes, writes = {}, {}, F.lit(0)
    for key in schema.ADDRESS_KEYS:
        current, offer = address[key], offers.get(key, F.lit(None).cast("string"))
        offer = F.when(offer != "", offer)
        blank = F.coalesce(current == "", F.lit(True))
        write = offer.isNotNull() & blank
        if overwrite:
            write = write | F.coalesce((current != offer) & prov.can_write(stamps, f"address.{key}", source), F.lit(False))
        values[key] = F.when(write, offer).otherwise(current)
        changes[f"address.{key}"] = F.when(write, F.lit(source))
        writes = writes + write.cast("int")
    return _struct(values), changes, writes


def backfill(tags: Column, kind: Column, number: Column, version: Column, as_of: str) -> tuple[dict[str, Column], dict[str, Column]]:
    """Fill a matched feature from the tags of its map element.

    Returns the changed columns and the counts of what was written.
    """
    stamps = F.col("sources_by_field")
    opening = hrs.clean_opening_hours(rules.tag(tags, "opening_hours"))
    hours, hours_stamps, new_hours = pay.merge_hours(F.col("hours"), opening, stamps, "osm")
    payment, payment_stamps, new_payment = pay.write_payment(F.col("payment"), stamps, rules.payment_offers(tags), "osm")
    offers = rules.address_from_tags(tags)
    address, address_stamps, new_address = _write_address(F.col("address"), stamps, offers, "osm", overwrite=True)
    added = rules.map_tags(tags)
    empty = F.array().cast("array<string>")
    element = F.concat(F.when(kind == "node", "node/").otherwise("way/"), number.cast("string"))
    changes = {
        "hours": hours,
        "payment": payment,
        "address": address,
        "tags": F.coalesce(prov.union_tags(F.col("tags"), added), F.col("tags")),
        "sources": prov.append_source(F.col("sources"), prov.source_entry("osm", element, version)),
        "updated": F.lit(as_of),
        "sources_by_field": prov.put_stamps(stamps, hours_stamps | payment_stamps | address_stamps),
    }
    counts = {
        "hours_written": new_hours.cast("int"),
        "payment_written": new_payment,
        "address_written": new_address,
        "tags_written": F.size(F.array_except(added, F.coalesce("tags", empty))),
    }
    return changes, counts


def fill_address(hit: Column, as_of: str) -> dict[str, Column]:
    """Blank address parts from a geocoder hit."""
    offers = {
        "street": hit["street"], "number": hit["housenumber"], "postalcode": hit["postcode"],
        "city": hit["city"], "district": hit["district"],
    }
    address, changes, writes = _write_address(F.col("address"), F.col("sources_by_field"), offers, "photon", overwrite=False)
    stamps = prov.put_stamps(F.col("sources_by_field"), changes)
    changed = hit.isNotNull() & (writes > 0)
    return {
        "address": F.when(changed, address).otherwise(F.col("address")),
        "sources_by_field": F.when(changed, stamps).otherwise(F.col("sources_by_field")),
        "updated": F.when(changed, F.lit(as_of)).otherwise(F.col("updated")),
    }


def absorb(kept: Column, gone: Column, as_of: str) -> dict[str, Column]:
    """The surviving map row with its blanks filled from the seed row merged away."""
    stamps = kept["sources_by_field"]
    changes: dict[str, Column] = {}
    seed = F.lit("hopfenstop")

    def fill(path: str, mine: Column, theirs: Column, blank: Column) -> Column:
        take = F.coalesce(blank, F.lit(True)) & theirs.isNotNull()
        changes[path] = F.when(take, seed)
        return F.when(take, theirs).otherwise(mine)

    def some(value: Column) -> Column:
        return F.when(value != "", value)

    name = text.pick_name(kept["name"], gone["name"])
    changes["name"] = F.when((name != kept["name"]) & (name == gone["name"]), seed)
    description = fill("description", kept["description"], some(gone["description"]), kept["description"] == "")
    hours = fill("hours", kept["hours"], F.when(gone["hours"]["raw"] != "", gone["hours"]), kept["hours"]["raw"] == "")
    payment, writes = {}, F.lit(0)
    for key in schema.PAYMENT_KEYS:
        mine, theirs = kept["payment"][key], some(gone["payment"][key])
        offer = F.when(theirs != "unknown", theirs)
        blank = mine.isin("", "unknown")
        payment[key] = fill(f"payment.{key}", mine, offer, blank)
        writes = writes + changes[f"payment.{key}"].isNotNull().cast("int")
    address = {
        key: fill(f"address.{key}", kept["address"][key], some(gone["address"][key]), kept["address"][key] == "")
        for key in schema.ADDRESS_KEYS
    }
    return {
        "name": name,
        "description": description,
        "hours": hours,
        "payment": F.when(kept["payment"].isNotNull() | (writes > 0), _struct(payment)),
        "address": _struct(address),
        "tags": F.coalesce(prov.union_tags(kept["tags"], gone["tags"]), F.array().cast("array<string>")),
        "sources": prov.union_sources(kept["sources"], gone["sources"]),
        "updated": F.lit(as_of),
        "sources_by_field": prov.put_stamps(stamps, changes),
    }


def apply_absorptions(features: DataFrame, pairs: DataFrame, as_of: str) -> DataFrame:
    """Merge the gone row of every tier-A pair into its kept row and drop the gone rows.

    A kept row may itself be merged away later (twin chains). Pairs run in
    assignment order; a pair waits while its gone row still expects an earlier
    pair, and a pair whose kept row is already gone has no visible effect.
    Rounds therefore number the longest chain, and touch only paired rows.
    """
    order = F.struct(F.col("tier"), -F.col("sim"), F.col("meters"), F.col("kind"), F.col("first_ord"), F.col("second_ord"))
    todo = pairs.filter(F.col("tier") == 0).select("region", "gone_id", "kept_id", order.alias("at"))
    lost_earlier = todo.select("region", F.col("gone_id").alias("kept_id"), F.col("at").alias("lost_at"))
    todo = todo.join(lost_earlier, ["region", "kept_id"], "left").filter(F.col("lost_at").isNull() | (F.col("lost_at") > F.col("at")))
    todo = cut(todo.drop("lost_at"))
    gone_ids = pairs.filter(F.col("tier") == 0).select("region", "gone_id")
    involved = todo.select("region", F.explode(F.array("gone_id", "kept_id")).alias("id")).distinct()
    current = cut(features.join(involved, ["region", "id"], "left_semi").select(schema.FEATURE_COLUMNS))
    row = F.struct(*schema.FEATURE_COLUMNS)
    while not todo.isEmpty():
        feeds = todo.select("region", F.col("kept_id").alias("gone_id"), F.col("at").alias("fed_at"))
        waiting = todo.join(feeds, ["region", "gone_id"]).filter(F.col("fed_at") < F.col("at")).select("region", "gone_id", "kept_id")
        ready = cut(todo.join(waiting, ["region", "gone_id", "kept_id"], "left_anti"))
        gone = current.select("region", F.col("id").alias("gone_id"), row.alias("gone"))
        merges = ready.join(gone, ["region", "gone_id"]).select("region", F.col("kept_id").alias("id"), "gone")
        joined = current.join(merges, ["region", "id"], "left")
        merged = absorb(F.struct(*[joined[c] for c in schema.FEATURE_COLUMNS]), F.col("gone"), as_of)
        changes = {c: F.when(F.col("gone").isNotNull(), value).otherwise(F.col(c)) for c, value in merged.items()}
        current = cut(rewrite(joined, changes))
        todo = cut(todo.join(ready, ["region", "gone_id", "kept_id"], "left_anti"))
    untouched = features.join(involved, ["region", "id"], "left_anti").select(schema.FEATURE_COLUMNS)
    return without_claimed(untouched.unionByName(current), gone_ids, "gone_id").select(schema.FEATURE_COLUMNS)


def removal_flag(all_ids_gone: Column) -> Column:
    """osm_removed of a row the snapshot lacks: map-only rows whose every id is confirmed gone."""
    newly = prov.is_osm_only(F.col("sources")) & all_ids_gone & ~F.coalesce("osm_removed", F.lit(False))
    return F.when(newly, F.lit(True)).otherwise(F.col("osm_removed"))


def link_sources(osm_ids: Column, new_tags: Column, updated: Column) -> dict[str, Column]:
    """Attach linked element ids (without version) and their tags to an existing feature."""
    entries = F.transform(osm_ids, lambda i: prov.source_entry("osm", i))
    linked = osm_ids.isNotNull()
    joined = F.concat(F.coalesce("sources", F.array().cast(schema.SOURCES)), entries)
    union = F.coalesce(prov.union_tags(F.col("tags"), new_tags), F.array().cast("array<string>"))
    return {
        "sources": F.when(linked, joined).otherwise(F.col("sources")),
        "tags": F.when(linked, union).otherwise(F.col("tags")),
        "updated": F.when(linked, updated).otherwise(F.col("updated")),
    }


def confirm_sources(refs: Column, as_of: str) -> dict[str, Column]:
    """Add confirmed element references (an array); those already there change nothing."""
    sources = F.coalesce("sources", F.array().cast(schema.SOURCES))
    known = F.transform(F.filter(sources, lambda s: s["type"] == "osm"), lambda s: s["id"])
    new = F.array_except(F.filter(refs, lambda r: prov.osm_reference(r).isNotNull()), known)
    added = F.concat(sources, F.transform(new, lambda r: prov.source_entry("osm", r)))
    add = F.coalesce(F.size(new) > 0, F.lit(False))
    return {
        "sources": F.when(add, added).otherwise(F.col("sources")),
        "updated": F.when(add, F.lit(as_of)).otherwise(F.col("updated")),
    }


ATTRIBUTION_PATHS = ["name", "description", *[f"address.{key}" for key in schema.ADDRESS_KEYS], "hours"]


def attribution(upstream: Column) -> dict[str, Column]:
    """Per path: is it unstamped here and equal, non-empty, in the seed record?"""
    theirs = {"name": upstream["name"], "description": upstream["description"], "hours": hrs.seed_hours(upstream["kioskTimes"])}
    ours = {"name": F.col("name"), "description": F.col("description"), "hours": F.col("hours.raw")}
    for key in schema.ADDRESS_KEYS:
        theirs[f"address.{key}"], ours[f"address.{key}"] = upstream["address"][key], F.col(f"address.{key}")
    out = {}
    for path in ATTRIBUTION_PATHS:
        unstamped = F.coalesce(prov.stamp_of(F.col("sources_by_field"), path) == "", F.lit(True))
        out[path] = unstamped & F.coalesce((ours[path] == theirs[path]) & (ours[path] != ""), F.lit(False))
    return out


def attribute_seed(features: DataFrame, seed: DataFrame) -> DataFrame:
    """Stamp fields that still equal their seed record. Adds stamped_paths (array)."""
    upstream = seed.select(F.col("kioskId").alias("seed_id"), F.struct(*seed.columns).alias("upstream"))
    ided = features.withColumn(
        "seed_id", F.get(F.filter("sources", lambda s: s["type"] == "hopfenstop"), F.lit(0))["id"]
    )
    # Rows without a seed id stay out of the join, or they would all meet in one task.
    linked = ided.filter(F.col("seed_id").isNotNull()).join(upstream, "seed_id", "left")
    joined = linked.unionByName(ided.filter(F.col("seed_id").isNull()), allowMissingColumns=True)
    tests = attribution(F.col("upstream"))
    paths = F.array_compact(F.array(*[F.when(test, F.lit(path)) for path, test in tests.items()]))
    stamped = joined.withColumn("stamped_paths", paths)
    new = {path: F.when(F.array_contains("stamped_paths", path), F.lit("hopfenstop")) for path in tests}
    visited = F.col("upstream").isNotNull() & F.col("sources_by_field").isNull()
    base = F.when(visited, F.create_map().cast(schema.STAMPS)).otherwise(F.col("sources_by_field"))
    return stamped.withColumn("sources_by_field", prov.put_stamps(base, new)).select(
        *schema.FEATURE_COLUMNS, "seed_id", "stamped_paths"
    )


def drop_degenerate_hours() -> tuple[Column, dict[str, Column]]:
    """Which features lose their hours, and the changed columns."""
    raw = F.col("hours.raw")
    bad = text.has_text(raw) & hrs.clean_opening_hours(raw).isNull()
    return bad, {
        "hours": F.when(~bad, F.col("hours")),
        "sources_by_field": F.when(bad, prov.drop_stamp(F.col("sources_by_field"), "hours")).otherwise(F.col("sources_by_field")),
    }
