"""Helpers for hot keys: salting both join sides, and ranks without one-task windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poifuse.session import cut

# A key with more rows than this on a side is split; tune to executor memory.
HOT_ROWS = 20_000


def row_hash(df: DataFrame) -> Column:
    """Hash over the columns that can be hashed (maps cannot)."""
    return F.xxhash64(*[F.col(name) for name, kind in df.dtypes if "map<" not in kind])


def salts(df: DataFrame, own: Column, other: Column, side: str) -> DataFrame:
    """Place rows in a matrix of blocks: random along the own axis, copied along the other."""
    own_name, other_name = ("left_salt", "right_salt") if side == "left" else ("right_salt", "left_salt")
    spread = F.pmod(row_hash(df), F.coalesce(own, F.lit(1)))
    copies = F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)
    return df.withColumn(own_name, spread.cast("int")).withColumn(other_name, F.explode(copies))


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Equality join whose hot left keys are spread over salts, the right side copied.

    For joins where the left side may pile up on a key. "inner" and "left" only.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    # Every hot key is listed. The list has at most one row per hot_rows input rows; Spark
    # broadcasts it while it is small, and splits skewed partitions of this join otherwise.
    hot = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("left_n")).filter(F.col("left_n") > hot_rows)
    n = F.coalesce(F.ceil(F.col("left_n") / hot_rows).cast("int"), F.lit(1))
    a = left.join(hot, keys, "left").withColumn("salt", F.pmod(row_hash(left), n).cast("int")).drop("left_n")
    b = right.join(hot, keys, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), n - 1))).drop("left_n")
    return a.join(b, [*keys, "salt"], how).drop("salt")


# Rows of a compact table that one task makes wide rows of.
TASK_ROWS = 50_000


def dealt(df: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """Rows dealt over tasks by a key, so that a task has as many at every size of the table.

    A file of a few megabytes is read by one task or two, however many rows it holds and
    however much work or memory each of them takes afterwards. Tables dealt by the same
    key also join on it without another shuffle.
    """
    tasks = -(-df.count() // (rows or TASK_ROWS))
    # Spark moves later filters, with all that they work out, before the shuffle, where a task or two would do the work.
    # It moves none past a filter that it can't repeat; this one is true of every row.
    return df.repartition(tasks, key).filter(F.monotonically_increasing_id() >= 0) if tasks > 1 else df


SAMPLE_PER_RANGE = 20


def _ranged(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds part, the number of a row's range: bounds come from a bounded sample and are kept, so a range never changes."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct(*[F.col(c) for c in columns])
    sample = df.select(place.alias("place")).orderBy(F.xxhash64("place")).limit(SAMPLE_PER_RANGE * parts)
    listed = sample.agg(F.sort_array(F.collect_list("place")).alias("places"))
    bounds = cut(listed.select(F.filter("places", lambda _, i: i % SAMPLE_PER_RANGE == SAMPLE_PER_RANGE - 1).alias("bounds"))).scalar()
    return df.withColumn("bounds", bounds).withColumn("part", _bounds_passed(F.col("bounds"), place, parts)).drop("bounds")


def _bounds_passed(bounds: Column, place: Column, most: int) -> Column:
    """How many of the sorted bounds, of which there are at most so many, do not exceed a place: by halving steps, since comparing them all costs more the more ranges there are."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    return F.reduce(steps, F.lit(0), lambda n, step: F.when(F.get(bounds, n + step - 1) <= place, n + step).otherwise(n))


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """1-based rank per key without pulling a key into one task.

    Rows are ranged over the whole cluster by (keys, order); each range counts its
    rows per key, the counts of earlier ranges become an offset, and the rank within
    the range is added. The order must be total. Only the bounds of the ranges, from a
    bounded sample, are written: rows are read once for the counts, of which they need
    only these columns, and once for the ranks.
    """
    columns = [*keys, *order]
    ranged = _ranged(df, columns)
    sizes = ranged.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part", *keys).orderBy(*order)
    local = ranged.repartition("part").withColumn("local_rank", F.row_number().over(within))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*keys, "part"]]
    joined = local.alias("l").join(offsets.alias("o"), same)
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns], (F.col("l.local_rank") + F.col("o.offset")).alias(name)
    )
