"""Helpers of the operators: written stages, partition numbers, connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a new local one only where that is unset on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lost executors cost no recomputation."""
    spark, path = df.sparkSession, stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _trim() -> None:
    """Give freed memory back to the system: Python workers live on between tasks and stages, beside others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run):
    """A task's generator that leaves no memory behind in its worker."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _trim()

    return wrapped


def table(batch: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(batch[f.name], type=f.type) for f in schema], schema=schema)


def binary_rows(blobs: list[bytes]) -> pa.Array:
    return pa.array(blobs, type=pa.binary())


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one partition to a spanning forest of (node, smallest node reachable here)."""
    seen = [b for b in batches if b.num_rows]
    if not seen:
        return
    pairs = np.concatenate([np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in seen], axis=1)
    nodes, flat = np.unique(pairs, return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left, right = flat.reshape(2, -1).tolist()
    for a, b in zip(left, right):
        a, b = root(a), root(b)
        if a != b:  # the smaller position is the smaller id
            parent[max(a, b)] = min(a, b)
    roots = np.array([root(x) for x in range(len(nodes))])
    child = np.flatnonzero(roots != np.arange(len(nodes)))
    for k in range(0, len(child), 200_000):
        c = child[k : k + 200_000]
        yield pa.RecordBatch.from_arrays([pa.array(nodes[c]), pa.array(nodes[roots[c]])], names=["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an edge table with two long columns: (node, root), root the smallest id.

    Each partition first contracts its edges to a forest. While some node is both
    a child and a parent, or has two parents, rounds of large stars and small stars
    follow (their number grows with the logarithm of the longest path); every
    round is written to the shared folder. Nodes without edges, and roots
    themselves, have no row. Nulls must be removed before."""
    a, b = edges.columns
    edges = edges.where(F.col(a) != F.col(b)).select(F.col(a).cast("long").alias("node"), F.col(b).cast("long").alias("root"))
    forest = stage(edges.mapInArrow(_forest, "node long, root long"), "forest")
    while True:
        twice = forest.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        inner = forest.join(forest.select(F.col("root").alias("node")).distinct(), "node", "left_semi")
        if twice.isEmpty() and inner.isEmpty():
            return forest.distinct()
        for keep in ("large", "small"):
            both = forest.select("node", "root").union(forest.select(F.col("root"), F.col("node"))).toDF("u", "v")
            if keep == "small":
                both = both.where("v < u")
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            star = both.join(low, "u")
            star = star.where("v > u").select("v", "m") if keep == "large" else star.select("v", "m").union(low)
            forest = star.where("v <> m").distinct().toDF("node", "root")
        forest = stage(forest.mapInArrow(_forest, "node long, root long"), "forest")


FILTER_BITS = 1 << 25


def id_filter(ids: DataFrame):
    """Broadcast bitmap of hashed ids: 4 MB whatever the input. It only spares rows a shuffle; an exact join must follow.

    A null id is never in it. With very many ids it fills up and lets everything pass."""
    spark, column = ids.sparkSession, ids.columns[0]
    bits_of = ids.where(F.col(column).isNotNull()).select(filter_bit(column))
    words = bits_of.selectExpr("cast(bit div 32 as int) as word", "shiftleft(1L, cast(bit % 32 as int)) as bit")
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most FILTER_BITS / 32 rows
    bits = np.zeros(FILTER_BITS // 32, dtype=np.uint32)
    bits[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return spark.sparkContext.broadcast(bits)


def filter_bit(column: str):
    """The bit of an id, as a column to select beside it."""
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)).alias("bit")


def passes(bits: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (bits[bit >> 5] >> (bit & 31).astype(np.uint32)) & np.uint32(1) == 1
