"""A Merkle manifest of a dataset by bitmap-rank indexing (operator 11).

Every row is a leaf, every group (language) a tree over its leaves in doc_id order, and
the group roots are the leaves of one more tree. Leaf places come from ranks, not from
a sort. The ids of a group are cut into chunks of 65,536; a chunk is a compressed
container (sorted 16-bit offsets while it has few ids, else a bitmap of 8 KB) with the
extra count of repeated ids. Containers are built per task and merged by (group,
chunk), and get a popcount directory: ones before each 64-bit word in the container, and
above it counts of ids before each chunk, in three more levels of 65,536 children, so
that no window and no group is larger than that. The rank of an id is the sum of these
counts and one popcount.

Leaves then go to keyed slot arrays: (group, place / 1,024) with the place in the block
as slot. One pass over a block reduces ten levels; block tops are the leaves of the next
round. Proofs come back down the same blocks: the siblings inside the block, then those
of its top. Equal leaves of one id are a run (slot, length), so a third of all rows
being one row is many short runs in many blocks, never one task.

Cases: a null value is `-` in the leaf; a null doc_id comes before all others of its
group and is never tampered with; leaves of one doc_id, or of none, ascend by their
hash; repeated rows are leaves of their own. n_chars beyond the range of a long is not
an error. Other columns don't count. An empty table gives no rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poifuse.llm import common

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CHUNK_BITS = 16
FEW = 4_096  # ids of a container that is a list, at most
BLOCK_BITS = 10  # levels that one pass reduces


def node(hashes: list[str]) -> str:
    return hashlib.sha256("".join(hashes).encode()).hexdigest()


def part(value: Column) -> Column:
    """A value of a leaf: '-' if null, else its length in bytes, ':', and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[part(columns[n]) for n in FIELDS]), 256)


def group_key(lang: Column) -> Column:
    """Never null, in the order of the groups: null first, then by bytes."""
    return F.when(lang.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), lang))


def leaves(docs: DataFrame) -> DataFrame:
    """grp, doc_id, leaf, tampered (the leaf of the row as a tamperer leaves it), n: the number of equal ones."""
    own = {"doc_id": F.col("doc_id").cast("long"), "source": F.col("source").cast("string"), "lang": F.col("lang").cast("string"), "n_chars": F.col("n_chars").cast("long"), "text": F.col("text").cast("string")}
    hit = F.crc32(own["doc_id"].cast("string").cast("binary")) % 7 == 0
    more = own | {"n_chars": own["n_chars"].cast("decimal(20,0)") + 1}
    rows = docs.select(group_key(own["lang"]).alias("grp"), own["doc_id"].alias("doc_id"), leaf(own).alias("leaf"), F.when(hit & own["n_chars"].isNotNull(), leaf(more)).alias("tampered"))
    return rows.groupBy("grp", "doc_id", "leaf", "tampered").agg(F.count("*").alias("n"))


# --- containers -----------------------------------------------------------------------


def pack_container(at: np.ndarray, count: np.ndarray) -> bytes:
    """Offsets (ascending) of a chunk with their counts."""
    twice = np.flatnonzero(count > 1)
    head = np.array([len(at), len(twice)], dtype="<u4").tobytes()
    extra = at[twice].astype("<u2").tobytes() + (count[twice] - 1).astype("<i8").tobytes()
    if len(at) <= FEW:
        return head + extra + at.astype("<u2").tobytes()
    bits = np.zeros(1 << CHUNK_BITS, dtype=bool)
    bits[at] = True
    return head + extra + np.packbits(bits, bitorder="little").tobytes()


def open_container(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(offsets or None, words of the bitmap or None, offsets with extra counts, these counts)."""
    n, twice = np.frombuffer(blob, "<u4", 2).tolist()
    extra_at = np.frombuffer(blob, "<u2", twice, 8).astype(np.int64)
    extra = np.frombuffer(blob, "<i8", twice, 8 + 2 * twice)
    rest = 8 + 10 * twice
    if n <= FEW:
        return np.frombuffer(blob, "<u2", n, rest), None, extra_at, extra
    return None, np.frombuffer(blob, "<u8", (1 << CHUNK_BITS) // 64, rest), extra_at, extra


def offsets(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    at, words, extra_at, extra = open_container(blob)
    if at is None:
        at = np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))
    at = at.astype(np.int64)
    count = np.ones(len(at), dtype=np.int64)
    count[np.searchsorted(at, extra_at)] += extra
    return at, count


def rank(blob: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For offsets that are in the container: ids before them, with repeats, and their own count."""
    few, words, extra_at, extra = open_container(blob)
    if few is not None:
        ones = np.searchsorted(few, at.astype(np.uint16), side="left")
    else:
        directory = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        ones = directory[word] + np.bitwise_count(words[word] & below)
    before = np.concatenate([[0], np.cumsum(extra)])
    k = np.searchsorted(extra_at, at, side="left")
    own = np.ones(len(at), dtype=np.int64)
    if len(extra_at):
        same = extra_at[np.minimum(k, len(extra_at) - 1)] == at
        own[same] += extra[np.minimum(k, len(extra_at) - 1)][same]
    return ones + before[k], own


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and starts of the groups of equal keys."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order, np.append(np.flatnonzero(new), len(order))


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers of each batch."""
    for batch in batches:
        names, grp = np.unique(batch.column(0).to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        ids, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        order, cuts = _runs(grp, ids >> CHUNK_BITS, ids)
        # first one of each id, then chunks of those
        first = order[cuts[:-1]]
        count = np.add.reduceat(n[order], cuts[:-1]) if len(first) else n[:0]
        g, chunk, at = grp[first], ids[first] >> CHUNK_BITS, ids[first] & ((1 << CHUNK_BITS) - 1)
        cut = np.append(np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (chunk[1:] != chunk[:-1]))) if len(g) else [], len(g)).astype(np.int64)
        blobs = [pack_container(at[a:b], count[a:b]) for a, b in zip(cut[:-1], cut[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(names[g[cut[:-1]]].tolist(), type=pa.string()), pa.array(chunk[cut[:-1]], type=pa.int64()), pa.array(blobs, type=pa.binary())], names=["grp", "chunk", "bits"])


def _merge(key: tuple, table: pa.Table) -> pa.Table:
    """All containers of one chunk as one: at most 65,536 ids, whatever the number of containers."""
    at, count = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def join():
        all_at, all_count = np.concatenate([at, *[a for a, _ in held]]), np.concatenate([count, *[c for _, c in held]])
        distinct, inverse = np.unique(all_at, return_inverse=True)
        sums = np.zeros(len(distinct), dtype=np.int64)
        np.add.at(sums, inverse, all_count)
        held.clear()
        return distinct, sums

    for chunk in table.column("bits").chunks:
        for blob in chunk:
            held.append(offsets(blob.as_buffer().to_pybytes()))
            if len(held) >= 1_000:
                at, count = join()
    at, count = join()
    return pa.table({"grp": [key[0].as_py()], "chunk": [key[1].as_py()], "bits": pa.array([pack_container(at, count)], type=pa.binary()), "ids": pa.array([int(count.sum())], type=pa.int64())})


def index(found: DataFrame) -> DataFrame:
    """grp, chunk, bits, before (leaves of the group in earlier chunks) for the ids of (grp, doc_id, n)."""
    ids = found.where("doc_id is not null").select("grp", "doc_id", "n")
    built = ids.mapInArrow(_build, "grp string, chunk long, bits binary")
    merged = common.stage(built.groupBy("grp", "chunk").applyInArrow(_merge, "grp string, chunk long, bits binary, ids long"), "containers")
    level = merged.select("grp", F.col("chunk").alias("child"), "ids")
    out, key = merged, F.col("chunk")
    for k in range(3):  # directories over at most 65,536 children each
        level = level.withColumn("parent", F.shiftright("child", CHUNK_BITS)) if k < 2 else level.withColumn("parent", F.lit(0).cast("long"))
        own = Window.partitionBy("grp", "parent").orderBy("child").rowsBetween(Window.unboundedPreceding, -1)
        sums = level.withColumn("before", F.coalesce(F.sum("ids").over(own), F.lit(0)))
        out = out.withColumn("child", key).join(sums.select("grp", "child", F.col("before").alias(f"before{k}")), ["grp", "child"]).drop("child")
        level = level.groupBy("grp", F.col("parent").alias("child")).agg(F.sum("ids").alias("ids"))
        key = F.shiftright(key, CHUNK_BITS)
    nulls = found.where("doc_id is null").groupBy("grp").agg(F.sum("n").alias("nulls"))
    out = out.join(nulls, "grp", "left")
    return out.select("grp", "chunk", "bits", (F.col("before0") + F.col("before1") + F.col("before2") + F.coalesce("nulls", F.lit(0))).alias("before"))


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows joined with their container: adds the rank of the id and its count."""
    for batch in batches:
        names = batch.schema.names
        ids, before, bits = batch.column("doc_id").to_numpy(), batch.column("before").to_numpy(), batch.column("bits")
        place, same = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
        grp = np.unique(batch.column("grp").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)[1] if len(ids) else ids
        order, cuts = _runs(grp, ids >> CHUNK_BITS)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own = order[a:b]
            ones, count = rank(bits[int(own[0])].as_buffer().to_pybytes(), ids[own] & ((1 << CHUNK_BITS) - 1))
            place[own], same[own] = before[own] + ones, count
        made = {"place": pa.array(place), "same": pa.array(same)}
        yield pa.RecordBatch.from_arrays([made[n] if n in made else batch.column(n) for n in _RANKED], names=_RANKED)


_RANKED = ["grp", "doc_id", "leaf", "tampered", "n", "place", "same"]


def placed(found: DataFrame) -> DataFrame:
    """Leaves with the place of the first of their n equal ones in the group."""
    joined = found.where("doc_id is not null").withColumn("chunk", F.shiftright("doc_id", CHUNK_BITS)).join(index(found), ["grp", "chunk"])
    ranked = joined.mapInArrow(_rank, "grp string, doc_id long, leaf string, tampered string, n long, place long, same long")
    ranked = common.stage(ranked.unionByName(found.where("doc_id is null").withColumns({"place": F.lit(0).cast("long"), "same": F.lit(None).cast("long")})), "ranked")
    # different leaves of one id, or of none: by hash, in two levels of at most 65,536 prefixes and what has one prefix
    alone = F.coalesce(F.col("same") == F.col("n"), F.lit(False))
    ties = ranked.where(~alone).withColumn("prefix", F.substring("leaf", 1, 4))
    sums = ties.groupBy("grp", "doc_id", "prefix").agg(F.sum("n").alias("sum"))
    before = Window.partitionBy("grp", "doc_id").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("grp").alias("g"), F.col("doc_id").alias("d"), F.col("prefix").alias("p"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("up"))
    ties = ties.join(sums, (F.col("grp") == F.col("g")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("prefix") == F.col("p")))
    inside = Window.partitionBy("grp", "doc_id", "prefix").orderBy("leaf", "tampered").rowsBetween(Window.unboundedPreceding, -1)
    ties = ties.withColumn("place", F.col("place") + F.col("up") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    kept = ["grp", "doc_id", "leaf", "tampered", "n", "place"]
    return ranked.where(alone).select(*kept).union(ties.select(*kept))


# --- trees ----------------------------------------------------------------------------


def depth(n: int) -> int:
    """Levels above n nodes."""
    return max(0, (n - 1).bit_length())


def reduce_block(nodes: list[str], block: int, n: int, level: int) -> list[list[str]]:
    """Levels of a block, its own nodes first; n is the number of nodes of the whole tree's lowest level."""
    out = [nodes]
    for _ in range(max(0, min(BLOCK_BITS, depth(n) - level))):
        last = out[-1]
        out.append([node(last[i : i + 2]) for i in range(0, len(last), 2)])
    return out


def siblings(levels: list[list[str]], slot: int) -> str:
    """The hashes beside the path of a slot, from below, joined."""
    return "".join(nodes[(slot >> k) ^ 1] for k, nodes in enumerate(levels[:-1]) if ((slot >> k) ^ 1) < len(nodes))


def fold(start: str, beside: str, place: int, n: int) -> str:
    """The root that a node and its siblings give."""
    at = 0
    for k in range(depth(n)):
        own = place >> k
        if own % 2:
            start, at = node([beside[at : at + 64], start]), at + 64
        elif own + 1 < (n + (1 << k) - 1) >> k:
            start, at = node([start, beside[at : at + 64]]), at + 64
        else:
            start = node([start])
    return start


def _dense(slots: list[dict]) -> list[str]:
    """Leaf hashes of a block by slot."""
    out = [""] * sum(s["len"] for s in slots)
    for s in slots:
        out[s["slot"] : s["slot"] + s["len"]] = [s["hash"]] * s["len"]
    return out


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Blocks one by one: only one at a time as Python objects."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _tops(level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(g, b, n, reduce_block(_dense(s.as_py()), b, n, level)[-1][0]) for g, b, n, s in zip(batch.column("grp").to_pylist(), batch.column("block").to_pylist(), batch.column("total").to_pylist(), batch.column("slots"))]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["grp", "place", "total", "hash"])

    return run


def _down(level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                levels = reduce_block(_dense(row["slots"]), row["block"], row["total"], level)
                some = range(len(levels[0]))
                place = [(row["block"] << BLOCK_BITS) + k for k in some]
                beside = [siblings(levels, k) + row["beside"] for k in some]
                yield pa.RecordBatch.from_arrays([pa.array([row["grp"]] * len(some)), pa.array(place, type=pa.int64()), pa.array([row["root"]] * len(some)), pa.array(beside)], names=["grp", "place", "root", "beside"])

    return run


def blocks(nodes: DataFrame) -> DataFrame:
    """Slot arrays of (grp, place, total, hash, ...): at most 1,024 nodes each."""
    extra = [c for c in nodes.columns if c not in ("grp", "place", "total", "len", "hash")]
    run = F.col("len") if "len" in nodes.columns else F.lit(1)
    slot = F.struct(F.col("place").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias("slot"), run.cast("int").alias("len"), "hash", *extra)
    total = [F.max("total").alias("total")] if "total" in nodes.columns else []
    return nodes.groupBy("grp", F.shiftright("place", BLOCK_BITS).alias("block")).agg(*total, F.collect_list(slot).alias("slots"))


def paths(nodes: DataFrame, most: int, level: int = 0) -> DataFrame:
    """grp, place, root of the group, siblings on the way there; most is the largest total."""
    if depth(most) <= level:
        return nodes.select("grp", "place", F.col("hash").alias("root"), F.lit("").alias("beside"))
    own = common.stage(blocks(nodes), "slots")
    tops = own.mapInArrow(_tops(level), "grp string, place long, total long, hash string")
    above = paths(tops, most, level + BLOCK_BITS).withColumnRenamed("place", "block")
    return own.join(above, ["grp", "block"]).mapInArrow(_down(level), "grp string, place long, root string, beside string")


_OUT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per leaf of the blocks, each with its proof, and the root folded from what a tamperer left."""
    for batch in batches:
        for row in _rows(batch):
            levels = reduce_block(_dense(row["slots"]), row["block"], row["total"], 0)
            out: list[tuple] = []
            for s in row["slots"]:
                for slot in range(s["slot"], s["slot"] + s["len"]):
                    below = siblings(levels, slot) + row["beside"]
                    place = (row["block"] << BLOCK_BITS) + slot
                    got = fold(fold(s["tampered"] or s["hash"], below, place, row["total"]), row["top_beside"], row["top_place"], row["tops"])
                    out.append((s["doc_id"], s["hash"], row["subroot"], row["root"], node([below, row["top_beside"]]), got, got == row["root"]))
            columns = list(zip(*out))
            types = (pa.int64(), *[pa.string()] * 5, pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of docs."""
    found = common.stage(leaves(docs), "leaves")
    totals = found.groupBy("grp").agg(F.sum("n").alias("total"))
    # runs of equal leaves, cut at the blocks' ends
    size = 1 << BLOCK_BITS
    rows = placed(found)
    first, last = F.shiftright("place", BLOCK_BITS), F.shiftright(F.col("place") + F.col("n") - 1, BLOCK_BITS)
    runs = rows.withColumn("block", F.explode(F.sequence(first, last)))
    begin, end = F.greatest("place", F.col("block") * size), F.least(F.col("place") + F.col("n"), (F.col("block") + 1) * size)
    own = blocks(runs.select("grp", begin.alias("place"), (end - begin).alias("len"), F.col("leaf").alias("hash"), "doc_id", "tampered"))
    slots = common.stage(own.join(totals, "grp"), "slots")  # blocks meet the totals, not leaves
    summary = totals.agg(F.max("total"), F.count("*")).first()
    most, groups = summary[0] or 0, summary[1]
    tops = slots.mapInArrow(_tops(0), "grp string, place long, total long, hash string")
    above = common.stage(paths(tops, most, BLOCK_BITS), "paths")
    roots = above.where("place = 0").select("grp", "root")
    # the order of group names is that of their bytes; one row per group
    names = ordered(roots)
    upper = paths(names.select(F.lit("").alias("grp"), "place", F.lit(groups).cast("long").alias("total"), F.col("root").alias("hash")), groups)
    upper = names.withColumnRenamed("root", "subroot").join(upper.select("place", "root", F.col("beside").alias("top_beside")), "place").withColumnRenamed("place", "top_place")
    whole = slots.join(above.select("grp", F.col("place").alias("block"), "beside"), ["grp", "block"]).join(upper, "grp").withColumn("tops", F.lit(groups).cast("long"))
    return whole.mapInArrow(_verify, _OUT)


def ordered(roots: DataFrame) -> DataFrame:
    """grp, root, place: rows sorted by range over the cluster, places from counts per range."""
    ranged = common.stage(roots.repartitionByRange("grp").withColumn("range", F.spark_partition_id()), "groups")
    counts = ranged.groupBy("range").agg(F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts = counts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("range").orderBy("grp")
    return ranged.withColumn("nth", F.row_number().over(own) - 1).join(counts, "range").select("grp", "root", (F.col("nth") + F.col("before")).alias("place"))


#: A leaf's checksum is taken bit by bit: one step per bit of each digit, each step a shift and a xor.
ORACLE_SQL = """
WITH RECURSIVE raw AS (
  SELECT doc_id, lang, n_chars, row_number() OVER () AS row,
    CASE WHEN doc_id IS NULL THEN '-' ELSE octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id END ||
    CASE WHEN source IS NULL THEN '-' ELSE octet_length(encode(source)) || ':' || source END ||
    CASE WHEN lang IS NULL THEN '-' ELSE octet_length(encode(lang)) || ':' || lang END AS head,
    CASE WHEN n_chars IS NULL THEN '-' ELSE octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars END AS chars,
    octet_length(encode((n_chars::HUGEINT + 1)::VARCHAR)) || ':' || (n_chars::HUGEINT + 1) AS more,
    CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':' || text END AS tail,
    list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: [ascii(x)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, x: xor(xor(c, x) >> 1, 3988292384::UBIGINT * (xor(c, x) & 1))) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, lang, row, sha256(head || chars || tail) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND n_chars IS NOT NULL AND xor(crc, 4294967295::UBIGINT) % 7 = 0 THEN sha256(head || more || tail) ELSE sha256(head || chars || tail) END AS used,
    coalesce('=' || lang, '-') AS grp
  FROM raw
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS place, count(*) OVER (PARTITION BY grp) AS n FROM leaves
), tree AS (
  SELECT grp, 0 AS level, place, leaf AS hash, n FROM placed
  UNION ALL
  SELECT grp, level + 1, place // 2, sha256(string_agg(hash, '' ORDER BY place)), (n + 1) // 2 FROM tree WHERE n > 1 GROUP BY grp, level, place // 2, n
), subroots AS (
  SELECT grp, hash AS subroot, row_number() OVER (ORDER BY encode(grp)) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS level, place, subroot AS hash, n FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(hash, '' ORDER BY place)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY level, place // 2, n
), root AS (SELECT hash AS root FROM top WHERE n = 1),
steps AS (
  SELECT p.row, t.level, CASE WHEN s.hash IS NULL THEN 'N' WHEN (p.place >> t.level) % 2 = 1 THEN 'L' || s.hash ELSE 'R' || s.hash END AS step
  FROM placed p JOIN (SELECT DISTINCT grp, level FROM tree WHERE n > 1) t ON t.grp = p.grp
  LEFT JOIN tree s ON s.grp = p.grp AND s.level = t.level AND s.place = xor(p.place >> t.level, 1)
), upper_steps AS (
  SELECT g.grp, t.level, CASE WHEN s.hash IS NULL THEN 'N' WHEN (g.place >> t.level) % 2 = 1 THEN 'L' || s.hash ELSE 'R' || s.hash END AS step
  FROM subroots g CROSS JOIN (SELECT DISTINCT level FROM top WHERE n > 1) t
  LEFT JOIN top s ON s.level = t.level AND s.place = xor(g.place >> t.level, 1)
), own AS (SELECT row, list(step ORDER BY level) AS steps FROM steps GROUP BY row),
upper_own AS (SELECT grp, list(step ORDER BY level) AS steps FROM upper_steps GROUP BY grp),
whole AS (
  SELECT p.doc_id, p.leaf, p.used, g.subroot, r.root, list_concat(coalesce(o.steps, []), coalesce(u.steps, [])) AS steps
  FROM placed p JOIN subroots g USING (grp) CROSS JOIN root r LEFT JOIN own o USING (row) LEFT JOIN upper_own u USING (grp)
), folded AS (
  SELECT *, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
    list_reduce(list_prepend(used, steps), lambda h, s: CASE s[1] WHEN 'L' THEN sha256(s[2:] || h) WHEN 'R' THEN sha256(h || s[2:]) ELSE sha256(h) END) AS folded_root
  FROM whole
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
