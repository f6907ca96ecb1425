"""Mixing sources to target weights by balanced sampling with the cube method (operator 10).

Each source has a share of the mix in words, at most `most` times its size. Every
document is taken floor(r) times, r the share over the size, and once more for a
sample with inclusion probability r - floor(r). The sample is drawn by the cube
method: probabilities move through the null space of the two balancing
constraints (words and documents of the source) until one of three active
documents is decided, then the next document takes its place. A source is cut
into blocks by doc_id, so that a source with a third of all rows is many groups;
each block leaves at most two undecided documents, which later rounds balance over
many blocks, until two per source are left. They land on the choice nearest to the
source's words; pairs of documents of the last round may then change places, which
keeps small sources near their target and the number of documents as it is.

Large documents come first, so that what stays undecided is small. All choices
depend on the rows alone (order by size and doc_id, random numbers by block), so reruns agree, whatever the partitions. Nulls and ties: a null text has size 0 and
takes nothing; a null source is a source of its own, after the others; null
doc_ids and repeated rows are mixed like others, rows that share a doc_id each by itself. An empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poifuse.llm import common

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
BLOCK = 4_000  # documents of a block, about
FAN = 512  # blocks whose leftovers a later round balances together
_EPS = 1e-9


def shares(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """From (source, source_size, ...): adds source_rank and target. One row per source, kept as a table.

    Shares go by weight; a source above `most` times its size stops there and the
    excess is shared by the others. With sources ordered by target over weight
    at which they fill up, those that fill are a prefix, found with running sums."""
    # Binary order of UTF-8 is code point order; one row per source goes through this window
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("room", F.col("source_size") * F.lit(float(most)))
    ranked = ranked.withColumn("level", F.col("room") / F.col("weight"))
    before = Window.orderBy("level", "rank").rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.orderBy("level", "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = ranked.select(
        "*", (F.sum("source_size").over(all_) * F.lit(float(share)) - F.coalesce(F.sum("room").over(before), F.lit(0.0))).alias("left"),
        (F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("over"),
    )
    # a source fills up if the level of those not yet full reaches it
    filled = filled.withColumn("price", F.col("left") / F.col("over")).withColumn("full", F.col("level") <= F.col("price"))
    final = F.min(F.when(~F.col("full"), F.struct("level", "rank", "price"))).over(all_)["price"]
    target = F.when(F.col("full"), F.col("room")).otherwise(F.col("weight") * F.col("final"))
    return filled.withColumn("final", final).select(*sizes.columns, F.col("rank").cast("long").alias("source_rank"), target.alias("target"))


def flight(size: np.ndarray, p: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Move probabilities until at most two are undecided; sums of p and of size * p stay."""
    out = p.copy()
    sizes, value = size.astype(float).tolist(), p.astype(float).tolist()
    active: list[int] = []
    turn = 0
    for new in range(len(value)):
        if _EPS < value[new] < 1 - _EPS:
            active.append(new)
        while len(active) == 3:
            a, b, c = active
            # null vector of the rows (1, 1, 1) and (sizes): their cross product
            u = (sizes[c] - sizes[b], sizes[a] - sizes[c], sizes[b] - sizes[a])
            if not any(u):
                u = (1.0, -1.0, 0.0)
            up = min((1 - value[i]) / w if w > 0 else value[i] / -w for i, w in zip(active, u) if w)
            down = min(value[i] / w if w > 0 else (1 - value[i]) / -w for i, w in zip(active, u) if w)
            step = up if draws[turn] * (up + down) < down else -down
            turn += 1
            rest = []
            for i, w in zip(active, u):
                value[i] += step * w
                if _EPS < value[i] < 1 - _EPS:
                    rest.append(i)
                else:
                    value[i] = float(round(value[i]))
            active = rest
    out[:] = value
    return out


def landing(size: np.ndarray, entry: np.ndarray, p: np.ndarray, draw: float) -> np.ndarray:
    """Decide at most two documents, by the choice whose words are nearest to the expected ones; the draw breaks ties.

    In a small source one document may still weigh much, so pairs of documents that were
    open at entry, one taken and one not, change places while that brings the words
    nearer. The number of documents stays, and every exchange makes the error smaller."""
    open_ = np.flatnonzero((p > _EPS) & (p < 1 - _EPS))
    out = p.copy()
    want = float((size[open_] * p[open_]).sum())
    choices = [[(k >> j) & 1 for j in range(len(open_))] for k in range(1 << len(open_))]
    off = [abs(float((size[open_] * np.array(c)).sum()) - want) if len(open_) else 0.0 for c in choices]
    best = [c for c, o in zip(choices, off) if o == min(off)]
    out[open_] = best[int(draw * len(best))]
    movable = np.flatnonzero((entry > _EPS) & (entry < 1 - _EPS))
    movable = movable[np.argsort(size[movable], kind="stable")]
    while True:
        error = float((size * (out - entry)).sum())
        taken, left = movable[out[movable] > 0.5], movable[out[movable] < 0.5]
        if not len(taken) or not len(left):
            return out
        # size of the one that leaves, less that of the one that comes, is to be the error
        wanted = size[taken] - error
        near = np.searchsorted(size[left], wanted)
        near = np.stack([np.maximum(near - 1, 0), np.minimum(near, len(left) - 1)])
        rest = np.abs(error - (size[taken] - size[left[near]]))
        row, k = np.unravel_index(int(np.argmin(rest)), rest.shape)
        if rest[row, k] >= abs(error) - _EPS:
            return out
        out[taken[k]], out[left[near[row, k]]] = 0.0, 1.0


def _draws(frame: pd.DataFrame, seed: int) -> np.ndarray:
    first = int(frame["block"].iloc[0]) * 1_000_003 + int(frame["source_rank"].iloc[0]) * 7919 + seed
    return np.random.default_rng(first & (2**63 - 1)).random(len(frame) + 1)


def _round(last: bool, seed: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "no_id", "id", "row", "copy"], ascending=[False, True, True, True, True], kind="stable").reset_index(drop=True)
        draws = _draws(frame, seed)
        size, entry = frame["size"].to_numpy(), frame["p"].to_numpy()
        moved = flight(size, entry, draws)
        frame["p"] = landing(size, entry, moved, float(draws[-1])) if last else moved
        return frame

    return run


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """doc_id, row, size, source, source_size, target, taken (words) and times (copies of the document) for (doc_id, text, source).

    `row` is a hash of the text; it tells rows that share a doc_id apart."""
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("row"), F.col("source").cast("string").alias("source"), words.cast("long").alias("size")]
    # equal rows are counted, then numbered: which of them is which doesn't matter
    counted = common.stage(docs.select(*own).groupBy("doc_id", "row", "source", "size").agg(F.count("*").alias("n")), "sizes")
    sizes = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows"))
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(4096).cast("long")))
    sized = counted.withColumn("first", first).withColumn("copy", F.explode(F.sequence(F.col("first"), F.least(F.col("first") + 4095, F.col("n") - 1)))).drop("first", "n")
    # ids stay whole numbers in the tasks: a null is a mark beside them
    sized = sized.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), "row", "copy", "size", "source")
    plan = shares(sizes, weights, share, most)
    plan = plan.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("rows") / block)).cast("long"))
    plan = common.stage(plan.withColumnRenamed("source", "plan_source"), "shares")
    ratio = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    whole = F.floor(ratio + _EPS)
    joined = sized.join(plan, sized["source"].eqNullSafe(plan["plan_source"])).drop("plan_source").withColumn("whole", whole).withColumn("p", F.greatest(F.lit(0.0), ratio - whole))
    joined = joined.withColumn("block", F.pmod(F.xxhash64("id", "no_id", "size", "row", "copy"), F.col("blocks")))
    types = "id long, no_id boolean, row long, copy long, size long, source string, source_size long, target double, whole long, p double, source_rank long, block long, blocks long"
    keep = [t.split(" ")[0] for t in types.split(", ")]
    most_blocks = plan.agg(F.max("blocks")).first()[0] or 1
    level, done = 0, []
    state = joined.select(*keep)
    while True:
        last = most_blocks <= 1
        state = common.stage(state.groupBy("source_rank", "block").applyInPandas(_round(last, seed + level), types), "flight")
        if last:
            done.append(state)
            break
        open_ = (F.col("p") > _EPS) & (F.col("p") < 1 - _EPS)
        done.append(state.where(~open_))
        state = state.where(open_).withColumn("block", F.floor(F.col("block") / FAN)).select(*keep)
        most_blocks = -(-most_blocks // FAN)
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    times = F.col("whole") + F.round("p").cast("long")
    return out.select(F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "row", "size", "source", "source_size", "target", (times * F.col("size")).alias("taken"), times.alias("times"))
