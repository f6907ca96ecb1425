"""Greedy one-to-one assignment on sites, inside connected components.

Rows that agree in everything a pair is judged by (region, place, name, address,
completeness) are one site; pairs are pairs of sites, so copies never multiply. The
greedy walk takes row pairs by tier, similarity, distance, kind and then by row order.
Row pairs of one site pair differ in row order only, so a site offers its first open
row, and the next one only when that is taken.

Pairs that share no site, directly or through others, do not affect each other. Sites
are therefore joined to connected components, and every component is walked in one
pass; small components share a task. Components are found with one union-find pass per
map area, and rounds of stars (their number grows with the logarithm of the longest
path) for the few sites that areas share."""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poifuse.session import cut

CROSS, TWIN = 0, 1
TASK_ROWS = 50_000  # rows that small components of one task have together
_FOREST = pa.schema([("node", pa.int64()), ("root", pa.int64())])


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one partition to (node, smallest node connected here), roots included."""
    seen = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches if b.num_rows]
    if not seen:
        return
    nodes, flat = np.unique(np.concatenate(seen, axis=1), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(*flat.reshape(2, -1).tolist()):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    roots = np.array([root(x) for x in range(len(nodes))])
    for k in range(0, len(nodes), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[k : k + 100_000]), pa.array(nodes[roots[k : k + 100_000]])], schema=_FOREST)


def star_rounds(edges: DataFrame) -> DataFrame:
    """(node, root) of the components of (a, b) edges, by alternating large and small stars; roots have no row."""
    stars, before = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()), None
    while True:
        both = stars.union(stars.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("v", "m").union(low).where("v <> m").distinct().toDF("u", "v")
        stars = cut(small)
        state = stars.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == before:
            return stars.toDF("node", "root")
        before = state


def components(edges: DataFrame, area: list[str]) -> DataFrame:
    """(node, root) of every node of (a, b, area columns): edges of one area meet in one task first."""
    local = cut(edges.repartition(*area).select("a", "b").mapInArrow(_union_find, "node long, root long"))
    split = local.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    links = cut(local.join(split.select("node", "low"), "node").select(F.col("low").alias("a"), F.col("root").alias("b")).where("a <> b").distinct())
    if not links.isEmpty():
        stars = star_rounds(links).toDF("root", "top")
        local = local.join(stars, "root", "left").select("node", F.coalesce("top", "root").alias("root")).distinct()
    return local


class _Site:
    """Rows of a site in order, and per role the next one that is still open."""

    def __init__(self, rows: list[tuple]) -> None:
        self.rows = sorted(rows)  # (ord, id)
        self.gone = list(range(len(rows) + 1))
        self.kept = list(range(len(rows) + 1))

    def after(self, role: list[int], i: int) -> int:
        """First open row from i on; the number of rows if there is none."""
        while role[i] != i:
            role[i] = role[role[i]]
            i = role[i]
        return i


def walk(pairs: list[dict], members: dict[str, list[tuple]], score: dict[str, int]) -> Iterator[tuple]:
    """(pair, gone row, kept row) in greedy order; pairs name two sites "a" and "b".

    A cross pair merges rows of a into rows of b. A twin pair merges the less complete
    row into the other one, on a tie the later into the earlier; a may equal b."""
    sites = {name: _Site(rows) for name, rows in members.items()}
    order = lambda p: (p["tier"], -p["sim"], p["meters"], p["kind"])
    pairs = sorted(pairs, key=order)
    start = 0
    while start < len(pairs):
        stop = start
        while stop < len(pairs) and order(pairs[stop]) == order(pairs[start]):
            stop += 1
        equal: dict[str, dict[str, dict]] = {}
        for p in pairs[start:stop]:
            equal.setdefault(p["a"], {})[p["b"]] = p
            if p["kind"] == TWIN:
                equal.setdefault(p["b"], {})[p["a"]] = p
        yield from (_cross if pairs[start]["kind"] == CROSS else _twins)(equal, sites, score)
        start = stop


def _cross(equal: dict, sites: dict[str, _Site], score: dict[str, int]) -> Iterator[tuple]:
    def offer(name: str) -> None:
        site = sites[name]
        i = site.after(site.gone, 0)
        if i < len(site.rows):
            heapq.heappush(queue, (site.rows[i], name, i))

    queue: list[tuple] = []
    for name in equal:
        offer(name)
    while queue:
        row, name, i = heapq.heappop(queue)
        spots = [(sites[b].rows[j], b, j) for b in equal[name] if (j := sites[b].after(sites[b].kept, 0)) < len(sites[b].rows)]
        if spots:  # else no row of this site has a partner left among these pairs
            other, b, j = min(spots)
            sites[name].gone[i], sites[b].kept[j] = i + 1, j + 1
            yield equal[name][b], row, other
            offer(name)


def _twins(equal: dict, sites: dict[str, _Site], score: dict[str, int]) -> Iterator[tuple]:
    for row, name, i in heapq.merge(*[[(row, name, i) for i, row in enumerate(sites[name].rows)] for name in equal]):
        own = sites[name]
        for mine, theirs, fits in ((own.kept, "gone", lambda s: s <= score[name]), (own.gone, "kept", lambda s: s > score[name])):
            if mine[i] != i:
                continue
            spots = []
            for b in equal[name]:
                if fits(score[b]):
                    site = sites[b]
                    j = site.after(getattr(site, theirs), bisect_right(site.rows, row[0], key=lambda r: r[0]))
                    if j < len(site.rows):
                        spots.append((site.rows[j], b, j))
            if spots:
                other, b, j = min(spots)
                mine[i], getattr(sites[b], theirs)[j] = i + 1, j + 1
                yield (equal[name][b], other, row) if theirs == "gone" else (equal[name][b], row, other)


def _walk_task(schema: pa.Schema):
    def run(pairs: pa.Table, members: pa.Table) -> pa.Table:
        rows: dict[str, list[tuple]] = {}
        score: dict[str, int] = {}
        for site, ord_, ident, points in zip(*[members.column(n).to_pylist() for n in ("site", "ord", "id", "score")]):
            rows.setdefault(site, []).append((ord_, ident))
            score[site] = points
        out = []
        for p, gone, kept in walk(pairs.to_pylist(), rows, score):
            first, second = (gone[0], kept[0]) if p["kind"] == CROSS else sorted((gone[0], kept[0]))
            out.append((p["region"], gone[1], kept[1], p["meters"], p["sim"], p["reason"], p["tier"], p["kind"], first, second))
        columns = list(zip(*out)) or [[] for _ in schema]
        return pa.table([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def assign(pairs: DataFrame, members: DataFrame, comps: DataFrame, rows: int) -> DataFrame:
    """Walk every component: pairs (region, a, b, meters, sim, reason, tier, kind), members (site, ord, id, score), comps (site, root)."""
    tasks = max(1, -(-rows // TASK_ROWS))
    task = F.pmod(F.xxhash64("root"), F.lit(tasks)).alias("task")
    left = pairs.join(comps.withColumnRenamed("site", "a"), "a").select(task, *pairs.columns)
    right = members.join(comps, "site").select(task, "site", "ord", "id", "score")
    ident = members.schema["id"].dataType.simpleString()
    types = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    ddl = f"region string, gone_id {ident}, kept_id {ident}, meters double, sim double, reason string, tier int, kind int, first_ord bigint, second_ord bigint"
    schema = pa.schema([("region", pa.string()), ("gone_id", types[ident]), ("kept_id", types[ident]), ("meters", pa.float64()), ("sim", pa.float64()), ("reason", pa.string()), ("tier", pa.int32()), ("kind", pa.int32()), ("first_ord", pa.int64()), ("second_ord", pa.int64())])
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    return left.groupBy("task").cogroup(right.groupBy("task")).applyInArrow(_walk_task(schema), ddl)


def walk_in_order(placed: DataFrame, columns: list[str], ident: str, order: str, key: str, rows: int) -> DataFrame:
    """Edges (row, key) of the rows that an order-greedy walk keeps; placed has the root of each row's component.

    A row is kept if none of its keys belongs to a row that was kept before it. A null is no key."""

    def run(table: pa.Table) -> pa.Table:
        names = list(zip(*[table.column(c).to_pylist() for c in ("region", ident)]))
        keys: dict[tuple, list] = {}
        place: dict[tuple, tuple] = {}
        for name, at, value in zip(names, table.column(order).to_pylist(), table.column(key).to_pylist()):
            keys.setdefault(name, []).extend([] if value is None else [(name[0], value)])
            place[name] = min(place.get(name, (at, name[1])), (at, name[1]))
        used, kept = set(), set()
        for name in sorted(keys, key=place.__getitem__):
            if not used.intersection(keys[name]):
                used.update(keys[name])
                kept.add(name)
        return table.filter(pa.array([n in kept for n in names], type=pa.bool_())).select(columns)

    tasks = max(1, -(-rows // TASK_ROWS))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.select(columns).schema)
    return placed.withColumn("task", F.pmod(F.xxhash64("root"), F.lit(tasks))).groupBy("task").applyInArrow(run, schema)
