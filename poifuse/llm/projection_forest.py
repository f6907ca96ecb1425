"""Near-duplicate vectors by a forest of random-projection trees (operator 6).

Vectors of one label link when their cosine, in double precision, is at least
the threshold. Equal vectors of a label are one class with a count from the start.
Each tree splits by one random direction per level at the median of its node; a
vector within `spill` of the median by rank goes to both sides. Medians are
fitted on a bounded sample (SAMPLE classes, those with the smallest hash); below
the sample's depth the split is at zero. Every vector is sent through every tree,
the vectors of a leaf and label are compared with each other, block by block, and
what passes is a link. The depth follows the largest label, so leaves keep their
size. A pair at the threshold is parted by a level with a chance of about 0.05, so
ten trees of eight levels miss one pair in a million; tests measure recall.

Nulls and ties: vectors that are null, zero, or hold a null or non-finite
component, and null labels, link with nothing and are kept; vectors of different
length link with nothing. Rows that repeat a vec_id count as vectors of their own
with the same id; a component is named by the smallest id in it. A row with a null
vec_id links like others, but has no component_id. An empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poifuse.llm import common
from poifuse.llm import wordbytes as wb

COSINE = 0.93
TREES = 10
LEAF = 256
SPILL = 0.05
SAMPLE = 20_000
_ROW = pa.schema([("key", pa.int64()), ("blob", pa.binary())])
_BLOCK = 1_024


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long float lists as rows of unit vectors, in double precision."""
    return unit(np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), -1))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)  # squares of very large or small numbers would not be finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit(sample: np.ndarray, depth: int, trees: int, spill: float, seed: int = 7) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """Per tree: directions by level, and (low, high) bounds of every fitted node by level."""
    forest = []
    for tree in range(trees):
        draw = np.random.default_rng([seed, tree])
        directions = draw.normal(size=(depth, sample.shape[1])) if sample.size else np.zeros((depth, 1))
        node = np.zeros(len(sample), dtype=np.int64)
        levels = []
        for level in range(depth):
            bounds = np.zeros((1 << level, 2)) if (1 << level) * 8 <= max(8, len(sample)) else None
            if bounds is None:
                break
            value = sample @ directions[level]
            order = np.lexsort((value, node))
            start = np.searchsorted(node[order], np.arange((1 << level) + 1))
            for k in range(1 << level):
                own = value[order[start[k] : start[k + 1]]]
                if len(own):
                    bounds[k] = np.quantile(own, [0.5 - spill, 0.5 + spill])
            levels.append(bounds)
            node = node * 2 + (value > bounds[node].mean(axis=1))
        forest.append((directions, levels))
    return forest


def leaves(vectors: np.ndarray, tree: tuple[np.ndarray, list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(vector, leaf) pairs; a vector in a spill zone has several leaves."""
    directions, levels = tree
    which, node = np.arange(len(vectors)), np.zeros(len(vectors), dtype=np.int64)
    projected = vectors @ directions.T
    for level in range(len(directions)):
        value = projected[which, level]
        bounds = levels[level][node] if level < len(levels) else np.zeros((len(node), 2))
        left, right = value <= bounds[:, 1], value >= bounds[:, 0]
        which, node = np.concatenate([which[left], which[right]]), np.concatenate([node[left] * 2, node[right] * 2 + 1])
    return which, node


def _send(forest, parts: int):
    """Vectors by (label, tree, leaf): blobs of ids and vectors per key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("embedding").value_lengths().to_numpy()
            for dim in np.unique(size).tolist():
                some = batch.filter(pa.array(size == dim)) if (size != dim).any() else batch
                trees = forest.value.get(dim)
                units = matrix(some.column("embedding"))
                ids, labels = some.column("rep").to_numpy(), some.column("label").to_numpy().astype(np.int64)
                row = np.dtype([("group", "<u8"), ("rep", "<i8"), ("vector", "<f8", (dim,))])
                raw = np.asarray(some.column("embedding").flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(some), dim)
                for k, tree in enumerate(trees):
                    which, leaf = leaves(units, tree)
                    out = np.zeros(len(which), dtype=row)
                    out["rep"], out["vector"] = ids[which], raw[which]
                    out["group"] = wb.mix(leaf.astype(np.uint64) * np.uint64(64 * 1024) + np.uint64(k * 64)) ^ wb.mix(labels[which].astype(np.uint64) + (np.uint64(dim) << np.uint64(40)))
                    key = out["group"] % np.uint64(parts)
                    order = np.argsort(key.astype(np.int32), kind="stable")
                    counts = np.bincount(key.astype(np.int64), minlength=parts)
                    stop = np.cumsum(counts)
                    at = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), common.binary_rows([dim.to_bytes(4, "little") + out[order[stop[p] - counts[p] : stop[p]]].tobytes() for p in at.tolist()])], schema=_ROW)

    return run


def _compare(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                dim = int.from_bytes(blob[:4], "little")
                got.setdefault(dim, []).append(np.frombuffer(blob, np.dtype([("group", "<u8"), ("rep", "<i8"), ("vector", "<f8", (dim,))]), offset=4))
        for dim in list(got):
            rows = np.concatenate(got.pop(dim))
            order = np.argsort(rows["group"], kind="stable")
            group = rows["group"][order]
            at = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            found, held = [], 0
            for a, b in zip(at.tolist(), np.append(at[1:], len(rows)).tolist()):
                for i in range(a, b, _BLOCK):
                    left = rows[order[i : min(i + _BLOCK, b)]]
                    x = unit(left["vector"])
                    for j in range(i, b, _BLOCK):
                        right = rows[order[j : min(j + _BLOCK, b)]]
                        y = unit(right["vector"])
                        p, q = np.nonzero(x @ y.T >= cosine)
                        first, second = left["rep"][p], right["rep"][q]
                        up = first < second if i == j else first != second
                        found.append(np.stack([np.minimum(first, second)[up], np.maximum(first, second)[up]], axis=1))
                        held += len(found[-1])
                if held > 200_000:
                    yield from emit(found)
                    found, held = [], 0
            yield from emit(found)

    def emit(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if found:
            pairs = np.unique(np.concatenate(found), axis=0)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))], names=["a", "b"])

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    parts = common.parts(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    good = F.coalesce(good, F.lit(False))
    one = rows.withColumn("good", good).withColumn("h1", F.xxhash64("embedding")).withColumn("h2", F.hash("embedding"))
    valid = one.where("good")
    # a class has a key of its own: ids may be null or repeat
    grouped = valid.groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    classes = common.stage(grouped.withColumn("rep", F.xxhash64("label", "h1", "h2")), "classes")
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    depth = max(1, int(np.ceil(np.log2(max(2, largest / leaf)))))
    sample = classes.select("embedding").orderBy(F.xxhash64("rep")).limit(SAMPLE).toArrow().column(0).combine_chunks()
    sizes = sample.value_lengths().to_numpy() if len(sample) else np.zeros(0, dtype=np.int64)
    dims = [r[0] for r in classes.select(F.size("embedding").alias("d")).distinct().collect()]  # lengths of vectors, a handful
    fitted = {d: fit(matrix(sample.filter(pa.array(sizes == d))) if (sizes == d).any() else np.zeros((0, d)), depth, trees, spill) for d in dims}
    forest = spark.sparkContext.broadcast(fitted)  # bounded by the sample
    sent = classes.select("rep", "label", "embedding").mapInArrow(_send(forest, parts), "key long, blob binary").repartition(parts, "key")
    links = common.stage(sent.mapInArrow(_compare(cosine), "a long, b long").distinct(), "links")
    counts = classes.select("rep", "copies")
    ends = links.select(F.col("a").alias("rep"), F.col("b").alias("other")).union(links.select("b", "a"))
    linked = ends.join(counts.withColumnRenamed("rep", "other"), "other").groupBy("rep").agg(F.sum("copies").alias("others"))
    trees_of = common.components(links).toDF("rep", "root")
    state = classes.drop("embedding").join(linked, "rep", "left").join(trees_of, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    smallest = state.groupBy("root").agg(F.min("low").alias("component_id"))
    state = state.join(smallest, "root").select("label", "h1", "h2", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = valid.select("vec_id", "label", "h1", "h2").join(state, ["label", "h1", "h2"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"))
    out = out.union(one.where(~F.col("good")).select("vec_id", F.lit(0).cast("long"), F.col("vec_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
