"""Payment and hours from place pages first, then from place-search results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poifuse.functions import hours as hrs
from poifuse.functions import payment as pay
from poifuse.functions import provenance as prov
from poifuse.operators import dedup, linking, spatial, stats
from poifuse.operators.merge import rewrite

TTL_DAYS, MIN_NAME = 30, 3


def due(attempted: Column, as_of: str) -> Column:
    """Never tried, unreadable date, or tried at least thirty days ago."""
    return F.coalesce(F.datediff(F.lit(as_of).cast("date"), attempted.try_cast("date")) >= TTL_DAYS, F.lit(True))


def incomplete() -> Column:
    return pay.payment_missing(F.col("payment")) | pay.hours_missing(F.col("hours"))


def worklist(features: DataFrame) -> DataFrame:
    """Rows worth asking about: not a vending machine, a real name, and something missing."""
    named = F.coalesce(F.length("name") >= MIN_NAME, F.lit(False))
    vending = F.coalesce(F.col("kind") == "vending_machine", F.lit(False))
    return features.filter(~vending & named & (prov.apple_id(F.col("sources")).isNull() | incomplete()))


def capped(rows: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    """The first rows of a worklist by region, id and position, and whether the cap left any out."""
    kept = rows.orderBy("region", "id", "ord").limit(limit)
    return kept, rows.limit(limit + 1).count() > limit


def worklist_counters(features: DataFrame) -> DataFrame:
    flags = {
        "considered": F.lit(True),
        "needs_id": prov.apple_id(F.col("sources")).isNull(),
        "needs_payment": pay.payment_missing(F.col("payment")),
        "needs_hours": pay.hours_missing(F.col("hours")),
    }
    return stats.count_flags(worklist(features), flags)


# A row is told apart by all three: ids repeat within and across regions.
ROW = ["region", "ord", "id"]


def _answered(best: DataFrame) -> DataFrame:
    return best.withColumnsRenamed({"feature_id": "id", "f_region": "region", "f_ord": "ord"})


def _asked(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """Rows whose id was asked about; in the row's region only, if the list names regions."""
    keys = ["region", "id"] if "region" in asked.columns else ["id"]
    return rows.join(asked.withColumnRenamed("feature_id", "id").select(keys), keys, "left_semi").select(*ROW, "lng", "lat")


def _when(test: Column, changes: dict[str, Column]) -> dict[str, Column]:
    return {name: F.when(test, value).otherwise(F.col(name)) for name, value in changes.items()}


def resolve_place_ids(features: DataFrame, places: DataFrame, asked: DataFrame, as_of: str) -> DataFrame:
    """Attach the nearest place id. asked: feature_id of every row whose lookup was tried.

    A tried row without a place (or whose lookup failed) gets the attempt date,
    a resolved one loses it.
    """
    want = worklist(features).filter(prov.apple_id(F.col("sources")).isNull() & due(F.col("apple_id_attempted"), as_of))
    tried = _asked(want, asked)
    best = _answered(linking.nearest_place(tried, places.drop("region"), ("region", "ord")).drop("ord")).select(*ROW, F.col("place_id").alias("new_place"))
    outcome = tried.select(*ROW, F.lit(True).alias("tried")).join(best, ROW, "left")
    joined = features.join(outcome, ROW, "left")
    found = F.col("new_place").isNotNull()
    return rewrite(
        joined,
        {
            "sources": F.when(found, prov.upsert_source(F.col("sources"), "apple", F.col("new_place"))).otherwise(F.col("sources")),
            "apple_id_attempted": attempt_stamp(F.col("apple_id_attempted"), F.coalesce("tried", F.lit(False)), found, True, as_of),
        },
    )


def _merged(test: Column, payment: Column, hours_text: Column, source: str, as_of: str, extra: dict[str, Column]) -> dict[str, Column]:
    """Payment, hours, stamps and dates after one source has spoken, where `test` holds."""
    stamps = F.col("sources_by_field")
    block, payment_stamps, writes = pay.merge_payment(F.col("payment"), payment, stamps, source)
    hours, hours_stamps, new_hours = pay.merge_hours(F.col("hours"), hours_text, stamps, source)
    touched = (writes > 0) | new_hours
    return _when(
        test,
        {
            "payment": block,
            "hours": hours,
            "sources_by_field": prov.put_stamps(stamps, payment_stamps | hours_stamps),
            "updated": F.when(touched, F.lit(as_of)).otherwise(F.col("updated")),
            **extra,
        },
    )


def apply_place_pages(features: DataFrame, pages: DataFrame, as_of: str) -> DataFrame:
    """Merge what the archived page of a row's place says; pages: place_id, html."""
    asking = (
        worklist(features)
        .filter(prov.apple_id(F.col("sources")).isNotNull() & incomplete() & due(F.col("apple_attempted"), as_of))
        .select(*ROW, prov.apple_id(F.col("sources")).alias("place_id"))
    )
    pages = pages.groupBy("place_id").agg(F.min("html").alias("html"))  # a page landed twice counts once
    facts = pages.select(
        "place_id",
        pay.amenities_to_payment(pay.page_amenities(F.col("html"))).alias("page_payment"),
        hrs.weekly_hours(pay.page_weekly_hours(F.col("html"))).alias("page_hours"),
    )
    joined = features.join(asking.join(facts, "place_id"), ROW, "left")
    answered = F.col("page_payment").isNotNull()
    stamp = {"apple_attempted": attempt_stamp(F.col("apple_attempted"), answered, answered, False, as_of)}
    return rewrite(joined, _merged(answered, F.col("page_payment"), F.col("page_hours"), "apple", as_of, stamp))


def search_batches(features: DataFrame, as_of: str, size: int = 15) -> tuple[DataFrame, DataFrame]:
    """Rows still incomplete, in batches per region, and the covering circle of each batch."""
    waiting = worklist(features).filter(incomplete() & due(F.col("google_attempted"), as_of))
    planned = dedup.batches(waiting.select("region", "ord", "id", "name", "lng", "lat"), ["region"], ["ord", "id"], size)
    return planned, spatial.bounding_circle(planned, ["region", "batch"])


def apply_search_results(features: DataFrame, results: DataFrame, answered: DataFrame, as_of: str) -> DataFrame:
    """Merge the first result within reach; answered: feature_id of rows whose batch came back."""
    asking = worklist(features).filter(incomplete() & due(F.col("google_attempted"), as_of))
    tried = _asked(asking, answered)
    first = _answered(linking.first_result(tried, results.drop("region"), ("region", "ord")).drop("ord"))
    facts = first.select(
        *ROW,
        F.coalesce(F.when(F.col("place_id") != "", F.col("place_id")), F.when(F.col("cid") != "", F.col("cid"))).alias("result_id"),
        pay.about_to_payment(F.col("about")).alias("result_payment"),
        hrs.day_map_hours(F.col("open_hours")).alias("result_hours"),
    )
    outcome = tried.select(*ROW, F.lit(True).alias("tried")).join(facts, ROW, "left")
    joined = features.join(outcome, ROW, "left")
    new_id = F.col("result_id").isNotNull() & ~F.coalesce(prov.gmaps_id(F.col("sources")) == F.col("result_id"), F.lit(False))
    sources = F.when(new_id, prov.upsert_source(F.col("sources"), "gmaps", F.col("result_id"))).otherwise(F.col("sources"))
    changes = _merged(
        F.col("result_payment").isNotNull(), F.col("result_payment"), F.col("result_hours"), "google", as_of, {"sources": sources}
    )
    was_tried = F.coalesce("tried", F.lit(False))
    changes["google_attempted"] = attempt_stamp(F.col("google_attempted"), was_tried, was_tried, False, as_of)
    return rewrite(joined, changes)


def attempt_stamp(current: Column, tried: Column, succeeded: Column, clears: bool, as_of: str) -> Column:
    """New attempt date: unchanged if not tried, cleared or renewed on success, renewed otherwise."""
    on_success = F.lit(None).cast("string") if clears else F.lit(as_of)
    return F.when(~tried, current).when(succeeded, on_success).otherwise(F.lit(as_of))
