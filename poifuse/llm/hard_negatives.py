"""Hard negatives of anchor vectors by L2AP-style threshold joins (operator 12).

Scores are inner products of quantised vectors. For each anchor the first `k` other
rows of its label are its positives; for each positive the first `k` rows of other
labels whose score lies in a window below the positive's score are its negatives.

Both searches are joins of all rows with the anchors in blocks: a grid of row groups
and anchor blocks of bounded size, so that a label (or a pile of equal vectors) with a
third of all rows is many groups. Within a group, dimensions are ordered by energy and
cut into slices. For the threshold of the moment, a row's inverted-index entries stop
at the slice from which the norm of what is left, times the anchors' own, can't reach
the threshold any more. Partial scores are accumulated slice by slice over these lists,
rows whose partial score plus the remaining norms stays below every threshold are
pruned half way, and survivors get their omitted dimensions from the stored vector.
Thresholds start near the best possible score and are lowered, for the anchors that
still need it, until every window has `k` rows or is read to its lower end. A group
sends at most `k` rows per window on, so copies never become pairs.

Cases: rows with a null label, a null vector, or a null or non-finite component take
no part; a null vec_id takes part, is no anchor, and comes last among ties. Rows equal
in vec_id, label and vector are one row; rows that only share a vec_id are rows of
their own, ties between them go by a hash of the row. Missing trailing components of
shorter vectors count as 0, an empty vector scores 0. Scores beyond the range of a long
stay at its end. Other columns are ignored; an empty table gives no rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poifuse.llm import common

K = 5
ANCHOR_EVERY = 100
SCALE = 256
SLICE = 8  # dimensions whose partial scores are added at once
FALLS = (0.1, 0.25, 0.5, 1.0)  # how far down its window a threshold goes, round by round
GROUP_BYTES = 8 << 20  # vectors of a row group
ANCHORS = 2_048  # of a block
_AT_ONCE = 128  # anchors whose scores are in memory at once
_TOP = (1 << 63) - 1


def vectors_of(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists as rows of a matrix, shorter ones filled with 0."""
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), width))
    out[np.arange(width)[None, :] < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


_whole = np.frompyfunc(lambda v: int(v) * SCALE if abs(v) >= 2.0**53 else math.floor(v * SCALE), 1, 1)


class SliceIndex:
    """Rows by dimension slice, most energy first, with the norm of what follows each slice."""

    def __init__(self, x: np.ndarray) -> None:
        self.dims = np.argsort(-(x * x).sum(axis=0), kind="stable")
        self.x = x[:, self.dims]
        self.edges = np.append(np.arange(0, x.shape[1], SLICE), x.shape[1])
        self.rest = self.norms(self.x)

    def norms(self, ordered: np.ndarray) -> np.ndarray:
        tail = np.concatenate([np.cumsum((ordered * ordered)[:, ::-1], axis=1)[:, ::-1], np.zeros((len(ordered), 1))], axis=1)
        return np.sqrt(tail[:, self.edges])

    def scores(self, a: np.ndarray, arest: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, scores of rows and anchors, which of them can reach the anchor's threshold); others may be incomplete."""
        last = len(self.edges) - 1
        covered = self.rest * arest.max(axis=0) < least.min()
        stop = np.where(covered.any(axis=1), covered.argmax(axis=1), last)  # slices in the row's index entries
        rows = np.argsort(-stop, kind="stable")
        rows = rows[: int((stop > 0).sum())] if last else rows
        stop = stop[rows]
        x, sums = self.x[rows], np.zeros((len(rows), len(a)))
        for s in range(last):
            m = int(np.searchsorted(-stop, -s, side="left"))  # the list of slice s: rows with stop > s
            if not m:
                break
            cut = slice(self.edges[s], self.edges[s + 1])
            sums[:m] += x[:m, cut] @ a[:, cut].T
            if s == last // 2:
                at = np.minimum(stop, s + 1)
                live = (sums + self.rest[rows, at][:, None] * arest.T[at] >= least).any(axis=1)
                rows, stop, x, sums = rows[live], stop[live], x[live], sums[live]
        able = sums + self.rest[rows, stop][:, None] * arest.T[stop] >= least
        for s in np.unique(stop[stop < last]).tolist():  # omitted dimensions of survivors
            own = np.flatnonzero((stop == s) & able.any(axis=1))
            sums[own] += x[own, self.edges[s] :] @ a[:, self.edges[s] :].T
        return rows, sums, able


def first_in_windows(x: np.ndarray, a: np.ndarray, low: list[list[int]], high: list[list[int]], allowed: Callable[[int, np.ndarray], np.ndarray], k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(anchor, window, rows, scores): the first k allowed rows with low <= score <= high; equal scores by row number."""
    plain = x.shape[1] * max(1.0, np.abs(x).max(initial=0) * SCALE) * max(1.0, np.abs(a).max(initial=0) * SCALE) < 2.0**52
    if plain:
        index = SliceIndex(np.floor(x * SCALE))
        a = np.floor(a * SCALE)[:, index.dims]
        arest = index.norms(a)
        best = arest[:, 0] * index.rest[:, 0].max(initial=0) if len(index.edges) > 1 else np.zeros(len(a))
    for begin in range(0, len(a), _AT_ONCE):
        some = np.arange(begin, min(begin + _AT_ONCE, len(a)))
        if plain:
            top = [[min(float(h), best[i] + 1) for h in high[i]] for i in some]
            end = [[max(float(l), -best[i] - 1) for l in low[i]] for i in some]
            open_ = {(j, w) for j in range(len(some)) for w in range(len(top[j])) if top[j][w] >= end[j][w]}
        else:  # integers beyond doubles: every score, exactly
            exact = np.clip(_whole(x) @ _whole(a[some]).T, -_TOP - 1, _TOP).astype(np.int64)
            open_ = {(j, w) for j, i in enumerate(some) for w in range(len(low[i]))}
        for fall in FALLS if plain else FALLS[-1:]:
            anchors = sorted({j for j, _ in open_})
            if not anchors:
                break
            if plain:
                least = {(j, w): end[j][w] if fall == 1 else top[j][w] - fall * (top[j][w] - end[j][w]) for j, w in open_}
                limit = np.array([min(least[j, w] for w in range(len(top[j])) if (j, w) in open_) for j in anchors])
                rows, sums, able = index.scores(a[some[anchors]], arest[some[anchors]], limit - 0.5)
            else:
                rows, sums, able = np.arange(len(x)), exact[:, anchors], np.ones((len(x), len(anchors)), dtype=bool)
            for c, j in enumerate(anchors):
                own = np.flatnonzero(able[:, c])
                own = own[allowed(int(some[j]), rows[own])]
                score = sums[own, c]
                for w in [w for jj, w in open_ if jj == j]:
                    floor = least[j, w] if plain else low[some[j]][w]
                    fit = np.flatnonzero((score >= floor) & (score <= high[some[j]][w]))
                    if len(fit) < k and fall < 1:
                        continue
                    open_.discard((j, w))
                    if len(fit) > 4 * k:
                        fit = fit[score[fit] >= np.partition(score[fit], len(fit) - k)[len(fit) - k]]
                    fit = fit[np.lexsort((rows[own[fit]], -score[fit]))[:k]]
                    if len(fit):
                        yield int(some[j]), w, rows[own[fit]], score[fit].astype(np.int64)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label (as changed), vector, rid (hash of the row); one of each."""
    one = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    one = one.where(F.coalesce(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite, F.lit(False)))
    one = one.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return one.dropDuplicates(["vec_id", "label", "vector"]).withColumn("rid", F.xxhash64("vec_id", "label", "vector"))


def _groups(n: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / size)).cast("int")


def _spread(rows: DataFrame, anchors: DataFrame, keys: list[str], row_groups: Column, blocks: Column):
    """Both sides on the grid: rows in groups, copied to every block of anchors, and anchors in blocks, copied to every group."""
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = rows.withColumn("grp", F.pmod(F.col("rid"), row_groups)).withColumn("block", every(blocks))
    right = anchors.withColumn("block", F.pmod(F.xxhash64("rid"), blocks)).withColumn("grp", every(row_groups))
    names = [*keys, "grp", "block"]
    cast = [F.col(n).cast("long").alias(n) for n in ("grp", "block")]
    left = left.select(*cast, "vec_id", "label", "rid", "vector")
    right = right.select(*cast, *[c for c in right.columns if c not in ("grp", "block")])
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # columns of their own: both come from one table
    return left.groupBy(*names).cogroup(right.groupBy(*names))


_FOUND = pa.schema([("anchor_id", pa.int64()), ("anchor_rid", pa.int64()), ("positive_id", pa.int64()), ("positive_rid", pa.int64()), ("positive_score", pa.int64()), ("other_id", pa.int64()), ("other_rid", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "anchor_id long, anchor_rid long, positive_id long, positive_rid long, positive_score long, other_id long, other_rid long, score long"


def _join(k: int, positives: bool):
    """Search of one group for one block of anchors: rows of the anchor's label, or of other labels in the positives' windows."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _FOUND.empty_table()
        left = left.sort_by([("vec_id", "ascending"), ("rid", "ascending")])  # nulls at the end
        anchors = right.drop_columns(["vector"]).to_pylist()
        width = int(max(max(t.column("vector").combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max() for t in (left, right)), 1))
        x, a = vectors_of(left.column("vector"), width), vectors_of(right.column("vector"), width)
        ids, rids = left.column("vec_id").to_pylist(), left.column("rid").to_numpy()
        if positives:
            low, high = [[-_TOP - 1]] * len(anchors), [[_TOP]] * len(anchors)
            windows = [[{"id": None, "rid": None, "score": None}]] * len(anchors)
            same = np.array([i if i is not None else -1 for i in ids])
            allowed = lambda i, rows: (rids[rows] != anchors[i]["rid"]) | (same[rows] != anchors[i]["vec_id"])
        else:
            windows = [r["windows"] for r in anchors]
            low, high = [[-((-4 * p["score"]) // 5) for p in w] for w in windows], [[p["score"] for p in w] for w in windows]
            labels = left.column("label").to_numpy()
            allowed = lambda i, rows: labels[rows] != anchors[i]["label"]
        out: dict[str, list] = {f.name: [] for f in _FOUND}
        for i, w, rows, scores in first_in_windows(x, a, low, high, allowed, k):
            p = windows[i][w]
            for row, score in zip(rows.tolist(), scores.tolist()):
                for name, value in zip(_FOUND.names, (anchors[i]["vec_id"], anchors[i]["rid"], p["id"], p["rid"], p["score"], ids[row], int(rids[row]), score)):
                    out[name].append(value)
        return pa.table(out, schema=_FOUND)

    return run


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k of the groups' rows; each group sent at most k."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("other_id").asc_nulls_last(), "other_rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, k: int = K, anchor_every: int = ANCHOR_EVERY, group_bytes: int = GROUP_BYTES, block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for (vec_id, embedding, label)."""
    rows = common.stage(usable(vectors), "vectors")
    is_anchor = F.col("vec_id") % anchor_every == 0
    whole = rows.agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("a"), F.max(F.size("vector")).alias("width")).first()
    size = max(64, group_bytes // (8 * max(1, whole["width"] or 1)))
    per_label = rows.groupBy("label").agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("a")).where("a > 0")
    sized = rows.join(per_label, "label")
    grid = _spread(sized, sized.where(is_anchor), ["label"], _groups(F.col("n"), size), _groups(F.col("a"), block))
    found = grid.applyInArrow(_join(k, True), _FOUND_DDL)
    best = _first(found, ["anchor_id", "anchor_rid"], k)
    windows = best.groupBy("anchor_id", "anchor_rid").agg(F.collect_list(F.struct(F.col("other_id").alias("id"), F.col("other_rid").alias("rid"), "score")).alias("windows"))  # at most k
    windows = common.stage(windows.select(F.col("anchor_id").alias("vec_id"), F.col("anchor_rid").alias("rid"), "windows"), "windows")
    anchors = rows.where(is_anchor).join(windows, ["vec_id", "rid"])
    grid = _spread(rows, anchors, [], _groups(F.lit(whole["n"]), size), _groups(F.lit(whole["a"]), block))
    found = grid.applyInArrow(_join(k, False), _FOUND_DDL)
    best = _first(found, ["anchor_id", "anchor_rid", "positive_id", "positive_rid"], k)
    return best.select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ORACLE_SQL = """
WITH used AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, r.label = a.label AS same, list_inner_product(a.q, r.q)::BIGINT AS score
  FROM used a JOIN used r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.positive_id, (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other))::INTEGER AS rank,
  s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""
