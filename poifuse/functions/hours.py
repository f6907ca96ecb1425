"""Opening hours: cleaning and conversion to one compact text.

Weeks have seven days, so day grouping works inside the row on arrays of
seven entries; no shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from poifuse.functions.text import let
from poifuse.schema import WEEK

_RANGE = r"\d{1,2}:\d{2}\s*-\s*\d{1,2}:\d{2}"
# Day names of the inputs and their two-letter form.
ENGLISH_DAYS = dict(zip(["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"], WEEK))
GERMAN_DAYS = dict(zip(["Montag", "Dienstag", "Mittwoch", "Donnerstag", "Freitag", "Samstag", "Sonntag"], WEEK))
UPPER_DAYS = {day.upper(): short for day, short in ENGLISH_DAYS.items()}


def _lookup(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])


def _week() -> Column:
    return F.array(*[F.lit(day) for day in WEEK])


def clean_opening_hours(raw: Column) -> Column:
    """Null for blank texts and for texts whose every range is of zero length at midnight."""
    trimmed = F.trim(raw)
    ranges = F.regexp_extract_all(trimmed, F.lit(f"({_RANGE})"), F.lit(1))
    degenerate = F.forall(ranges, lambda r: r.rlike(r"^0?0:00\s*-\s*0?0:00$"))
    return F.when((trimmed != "") & ((F.size(ranges) == 0) | ~degenerate), trimmed)


def seconds_to_hm(seconds: Column) -> Column:
    return F.format_string("%02d:%02d", F.floor(seconds / 3600), F.floor((seconds % 3600) / 60))


def hour_slot(open_time: Column, close_time: Column) -> Column:
    def part(values: Column, i: int) -> Column:
        return F.coalesce(F.get(values, F.lit(i)), F.lit(0))

    slot = F.format_string("%02d:%02d-%02d:%02d", part(open_time, 0), part(open_time, 1), part(close_time, 0), part(close_time, 1))
    return F.when(open_time.isNotNull() & close_time.isNotNull(), slot)


def day_runs(slots: Column) -> Column:
    """Seven slots (null for closed) to runs of equal neighbours: [{first, last, slot}]."""
    run = "struct<first:int,last:int,slot:string>"

    def add(runs: Column, entry: Column) -> Column:
        day, slot = entry["day"], entry["slot"]
        last = F.try_element_at(runs, F.lit(-1))
        joins = (last["slot"] == slot) & (last["last"] == day - 1)
        single = F.struct(day.alias("first"), day.alias("last"), slot.alias("slot"))
        longer = F.struct(last["first"].alias("first"), day.alias("last"), slot.alias("slot"))
        return (
            F.when(slot.isNull(), runs)
            .when(joins, F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(longer)))
            .otherwise(F.concat(runs, F.array(single)))
        )

    days = F.transform(slots, lambda slot, i: F.struct(i.alias("day"), slot.alias("slot")))
    return F.aggregate(days, F.array().cast(f"array<{run}>"), add)


def run_label(run: Column) -> Column:
    first, last = F.get(_week(), run["first"]), F.get(_week(), run["last"])
    return F.when(run["first"] == run["last"], first).otherwise(F.concat(first, F.lit("-"), last))


def seed_hours(times: Column, days: dict[str, str] | None = None) -> Column:
    """One slot per day, the last entry of a day wins, equal consecutive days are joined."""
    names = _lookup(days or UPPER_DAYS | ENGLISH_DAYS)

    def entry(t: Column) -> Column:
        slot = hour_slot(t["openTime"], t["closeTime"])
        return F.struct(F.try_element_at(names, t["day"]).alias("day"), slot.alias("slot"))

    def by_day(entries: Column) -> Column:
        def last_slot(day: Column) -> Column:
            found = F.filter(entries, lambda e: F.coalesce((e["day"] == day) & e["slot"].isNotNull(), F.lit(False)))
            return F.try_element_at(found, F.lit(-1))["slot"]

        return F.transform(_week(), last_slot)

    runs = day_runs(let(F.transform(times, entry), by_day))
    labels = F.transform(runs, lambda run: F.concat(run_label(run), F.lit(" "), run["slot"]))
    return F.nullif(F.array_join(labels, "; "), F.lit(""))


def condense_days(days: Column) -> Column:
    """Two-letter days to text in week order: runs joined by "-", groups by ","."""
    marks = F.transform(_week(), lambda day: F.when(F.array_contains(days, day), F.lit("x")))
    return F.array_join(F.transform(day_runs(marks), run_label), ",")


def weekly_hours(weekly: Column) -> Column:
    """Entries with upper-case day names and second ranges, kept in input order."""
    names = _lookup(UPPER_DAYS)

    def segment(entry: Column) -> Column:
        days = F.array_compact(F.transform(entry["day"], lambda day: F.try_element_at(names, day)))
        ranges = F.array_join(
            F.transform(
                entry["timeRange"],
                lambda r: F.concat(seconds_to_hm(r["from"]), F.lit("-"), seconds_to_hm(r["to"])),
            ),
            ",",
        )
        text = F.concat(condense_days(days), F.lit(" "), ranges)
        return F.when((F.size(days) > 0) & (ranges != ""), text)

    segments = F.array_compact(F.transform(weekly, segment))
    return F.when(F.size(segments) > 0, F.array_join(segments, "; "))


def day_map_hours(open_hours: Column) -> Column:
    """Day name to ranges, map order kept; only ranges in 24-hour form are used."""
    names = _lookup(ENGLISH_DAYS | GERMAN_DAYS)

    def segment(entry: Column) -> Column:
        day = F.try_element_at(names, entry["key"])
        good = F.filter(entry["value"], lambda r: r.rlike(r"^\d{1,2}:\d{2}\s*[-–]\s*\d{1,2}:\d{2}$"))
        tidy = F.transform(good, lambda r: F.replace(F.regexp_replace(r, r"\s+", ""), F.lit("–"), F.lit("-")))
        return F.when(F.size(good) > 0, F.concat(day, F.lit(" "), F.array_join(tidy, ",")))

    segments = F.array_compact(F.transform(F.map_entries(open_hours), segment))
    return F.when(F.size(segments) > 0, F.array_join(segments, "; "))
