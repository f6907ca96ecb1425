"""Source ranks, per-field provenance stamps and the list of sources of a feature."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from poifuse import schema

SOURCE_ENTRY = "struct<type:string,id:string,version:int>"


def rank_of(source: Column) -> Column:
    """Trust rank: unset counts as the default rank, an unknown name as zero."""
    ranks = F.create_map(*[F.lit(part) for pair in schema.SOURCE_RANK.items() for part in pair])
    return F.when(source.isNull() | (source == ""), F.lit(schema.DEFAULT_RANK)).otherwise(
        F.coalesce(F.try_element_at(ranks, source), F.lit(0))
    )


def stamp_of(stamps: Column, path: str) -> Column:
    return F.try_element_at(stamps, F.lit(path))


def can_write(stamps: Column, path: str, source: str) -> Column:
    return F.lit(schema.SOURCE_RANK[source]) >= rank_of(stamp_of(stamps, path))


def put_stamps(stamps: Column, changes: dict[str, Column]) -> Column:
    """Set stamps where the new value is not null; a null map without changes stays null."""
    paths = list(changes)
    old = F.coalesce(stamps, F.create_map().cast(schema.STAMPS))
    entries = [part for path in paths for part in (F.lit(path), F.coalesce(changes[path], stamp_of(stamps, path)))]
    named = F.map_filter(F.create_map(*entries), lambda _, source: source.isNotNull())
    others = F.map_filter(old, lambda path, _: ~path.isin(paths))
    merged = F.map_concat(others, named)
    return F.when(stamps.isNull() & (F.size(merged) == 0), stamps).otherwise(merged)


def stamp_all(stamps: Column, paths: list[str], source: str) -> Column:
    return put_stamps(stamps, {path: F.lit(source) for path in paths})


def drop_stamp(stamps: Column, path: str) -> Column:
    rest = F.map_filter(stamps, lambda key, _: key != path)
    return F.when(F.size(rest) > 0, rest)


def has_source(sources: Column, kind: str) -> Column:
    return F.coalesce(F.exists(sources, lambda s: s["type"] == kind), F.lit(False))


def is_osm_only(sources: Column) -> Column:
    return F.coalesce((F.size(sources) > 0) & F.forall(sources, lambda s: s["type"] == "osm"), F.lit(False))


def osm_ids(sources: Column) -> Column:
    found = F.transform(F.filter(sources, lambda s: s["type"] == "osm"), lambda s: s["id"])
    return F.coalesce(found, F.array().cast("array<string>"))


def first_source_id(sources: Column, kind: str) -> Column:
    found = F.filter(sources, lambda s: (s["type"] == kind) & F.coalesce(s["id"] != "", F.lit(False)))
    return F.get(found, F.lit(0))["id"]


def apple_id(sources: Column) -> Column:
    return first_source_id(sources, "apple")


def gmaps_id(sources: Column) -> Column:
    """First place id, where two historical placeholder ids count as missing."""
    found = first_source_id(sources, "gmaps")
    return F.when(~found.isin("payment", "gmaps"), found)


def source_entry(kind: str, entry_id: Column, version: Column | None = None) -> Column:
    version = F.lit(None) if version is None else version
    return F.struct(
        F.lit(kind).alias("type"), entry_id.alias("id"), version.cast("int").alias("version")
    )


def append_source(sources: Column, entry: Column) -> Column:
    return F.concat(F.coalesce(sources, F.array().cast(schema.SOURCES)), F.array(entry))


def upsert_source(sources: Column, kind: str, entry_id: Column) -> Column:
    """Give the first entry of the type this id, or append one."""
    first = F.array_position(F.transform(sources, lambda s: s["type"]), F.lit(kind))
    replaced = F.transform(
        sources,
        lambda s, i: F.when(
            i + 1 == first, F.struct(s["type"].alias("type"), entry_id.alias("id"), s["version"].alias("version"))
        ).otherwise(s),
    )
    return F.when(first > 0, replaced).otherwise(append_source(sources, source_entry(kind, entry_id)))


def union_sources(first: Column, second: Column) -> Column:
    """Entries of the first list, then those of the second whose type and id are new."""
    def key(s: Column) -> Column:
        return F.concat(s["type"], F.lit("::"), F.coalesce(s["id"], F.lit("")))

    def add(kept: Column, s: Column) -> Column:
        known = F.exists(kept, lambda k: key(k) == key(s))
        return F.when(known, kept).otherwise(F.concat(kept, F.array(s)))

    empty = F.array().cast(schema.SOURCES)
    return F.aggregate(F.coalesce(second, empty), F.coalesce(first, empty), add)


def union_tags(first: Column, second: Column) -> Column:
    """Sorted union of two tag lists; null when both are empty."""
    empty = F.array().cast("array<string>")
    union = F.array_sort(F.array_union(F.coalesce(first, empty), F.coalesce(second, empty)))
    return F.when(F.size(union) > 0, union)


def osm_reference(ref: Column) -> Column:
    """Type and number of an element reference, null when malformed."""
    pattern = r"^(node|way|relation)/(\d+)$"
    return F.when(
        ref.rlike(pattern),
        F.struct(F.regexp_extract(ref, pattern, 1).alias("type"), F.regexp_extract(ref, pattern, 2).alias("id")),
    )
