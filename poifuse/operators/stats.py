"""Run statistics: counters per region, stamp counts, roll-ups per file and in total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REFRESH_ACTIONS = [
    "added", "updated", "removed", "kept_non_osm", "linked_non_osm", "suppressed_dup", "cross_region_dropped", "dropped_market",
]


def refresh_counters(actions: DataFrame) -> DataFrame:
    """One row per region, one column per action."""
    return actions.groupBy("region").agg(*[F.count_if(F.col("action") == name).alias(name) for name in REFRESH_ACTIONS])


def count_flags(df: DataFrame, flags: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(keys or [])).agg(*[F.count_if(flag).alias(name) for name, flag in flags.items()])


def rolled_up_counts(df: DataFrame, keys: list[str], total: str = "(all)") -> DataFrame:
    """Counts per key combination, per leading key and overall."""
    counts = df.rollup(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.grouping(k).alias(f"all_{k}") for k in keys])
    return counts.select(*[F.when(F.col(f"all_{k}") == 1, total).otherwise(F.col(k)).alias(k) for k in keys], "n")


def rolled_up_sums(df: DataFrame, key: str, measures: list[str], total: str = "(all)") -> DataFrame:
    sums = df.rollup(key).agg(*[F.sum(m).alias(m) for m in measures], F.grouping(key).alias("is_total"))
    return sums.select(F.when(F.col("is_total") == 1, total).otherwise(F.col(key)).alias(key), *measures)


def examples_per_group(df: DataFrame, key: str, order: str, shown: Column, n: int = 3) -> DataFrame:
    """Row count per group and its first n examples.

    The examples come from a bounded collection per partial group: each row
    carries its rank within a hash bucket, so no group is gathered whole.
    """
    bucket = F.pmod(F.xxhash64(order), F.lit(256))
    ranked = df.withColumn("shown", shown).withColumn("bucket", bucket)
    ranked = ranked.withColumn("nth", F.row_number().over(Window.partitionBy(key, "bucket").orderBy(order)))
    pair = F.when(F.col("nth") <= n, F.struct(F.col(order).alias("o"), "shown"))
    grouped = ranked.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(pair)).alias("firsts"))
    return grouped.select(key, "n", F.transform(F.slice("firsts", 1, n), lambda p: p["shown"]).alias("examples"))
