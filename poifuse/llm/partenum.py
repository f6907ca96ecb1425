"""Exact Jaccard join of word shingle sets by partition signatures (operator 8).

Sets are the distinct hashes of runs of `width` words (lower-cased in A-Z); two
documents link when 100 * intersection >= 75 * union. Sizes are cut into bands.
In a band's grid the hash range is cut into equal parts; each part of a set that
isn't empty gives one signature, the hash of what the set has there. A linked
partner differs from a set of n shingles in at most n // 3 of them, and each
difference spoils one part at most. So a set with p > n // 3 filled parts shares
at least p - n // 3 whole parts with every partner. Small sets use single
shingles as parts, where this always holds; a larger set that has too few filled
parts also gives its single shingles in the band's spare grid, which covers pairs
of two such sets. Sets close below a band also take part in the band above.

The same bound prunes: sets with fewer than p - n // 3 shared signatures have no
partner, and of the others only the n // 3 + 1 rarest signatures are looked at.
Frequent shingles (common passages) thus generate no pairs, and nothing is capped.

Copies (equal word sequences) are one class from the start. Groups of a signature
are linked in two rounds. First each class is checked against one leading class,
the one with most shared signatures. Groups that then still hold several components
go on with a bit map of each set, one bit for many shingles: sets differ in at
least as many shingles as their maps do in bits, so in a large group of edited
copies only pairs that are linked or nearly so leave the task: first, of each class,
the closest one per other component, then all that still lie between components. Every pair is decided
on whole shingle sets (their hashes cut to 40 bits), never on signatures or maps.

Nulls and ties: null or wordless texts have no shingles and link with nothing;
fewer words than `width` make one shingle. Rows that repeat a doc_id are copies
or separate texts of that id. A null doc_id keeps its row, with a null component,
and links nothing. An empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poifuse.llm import common
from poifuse.llm import wordbytes as wb

WIDTH = 5
SMALL = 64  # largest size whose parts are single shingles
RATIO = 3  # sizes of a band
FILL = 2.6  # shingles per part at a band's upper end
_BITS40 = np.uint64((1 << 40) - 1)
_ROW = pa.schema([("key", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary())])
_ROW_DDL = "key long, kind int, blob binary"
_DOC = np.dtype([("doc_id", "<i8"), ("known", "?"), ("fp", "<u8"), ("n", "<i4"), ("ref", "<u8"), ("first", "?"), ("parts", "<i4", (4,))])
_SHARED = np.dtype([("ref", "<u8"), ("sig", "<u8"), ("count", "<u4")])


def band_of(n: np.ndarray) -> np.ndarray:
    edges = SMALL * RATIO ** np.arange(40, dtype=np.float64)
    return np.searchsorted(edges, n, side="left")


def upper(band: np.ndarray) -> np.ndarray:
    return SMALL * np.power(float(RATIO), band)


def signatures(values: np.ndarray, sizes: np.ndarray, bands: np.ndarray, spare: np.ndarray | bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of sorted sets laid end to end, and the set of each; band 0 and spare grids use single shingles."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    grid = np.where((bands > 0) & ~np.asarray(spare), np.maximum(1, np.ceil(upper(bands) / FILL)), 0).astype(np.uint64)
    salt = wb.mix(bands.astype(np.uint64) * np.uint64(2) + np.uint64(1) + np.asarray(spare).astype(np.uint64))
    part = ((values >> np.uint64(32)) * grid[owner]) >> np.uint64(32)
    new = np.ones(len(values), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (part[1:] != part[:-1]) | (grid[owner[1:]] == 0)
    at = np.flatnonzero(new)
    if not len(at):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return wb.mix(np.add.reduceat(values, at) + part[at] * np.uint64(0x9E3779B97F4A7C15) + salt[owner[at]]), owner[at]


def _packed(keys: np.ndarray, rows: np.ndarray, kind: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Rows of a structured array as one blob per key."""
    order = np.argsort(keys.astype(np.int32), kind="stable")
    rows, counts = rows[order], np.bincount(keys.astype(np.int64), minlength=parts)
    stops = np.cumsum(counts)
    at = np.flatnonzero(counts)
    if len(at):
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(np.full(len(at), kind, dtype=np.int32)), common.binary_rows([rows[stops[k] - counts[k] : stops[k]].tobytes() for k in at.tolist()])], schema=_ROW)


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[slice, list[np.ndarray], np.ndarray]]:
    """For chunks of rows: the sorted distinct shingles of each, and the hash of each row's word sequence."""
    for chunk in wb.words(column, lower=True):
        rows = len(chunk.first) - 1
        prefix = wb.prefix_hash(chunk.hash)
        fp = wb.span_hash(prefix, chunk.first[:-1], chunk.first[1:])
        at = np.arange(len(chunk.hash))
        stop = np.repeat(chunk.first[1:], np.diff(chunk.first))
        runs = wb.span_hash(prefix, at, np.minimum(at + width, stop))
        full = (at + width <= stop) | (at == np.repeat(chunk.first[:-1], np.diff(chunk.first)))
        sets = [np.unique(runs[a:b][full[a:b]]) for a, b in zip(chunk.first[:rows].tolist(), chunk.first[1:].tolist())]
        yield chunk.rows, sets, fp


def _sign(width: int, parts: int):
    """Pass over the texts: document rows (kind 0) and signature blobs (kind 1), both by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        task = np.uint64(context.partitionId() if context else 0) << np.uint64(32)
        refs: dict[int, int] = {}
        for batch in batches:
            names = batch.column(0)
            known = names.is_valid().to_numpy(zero_copy_only=False)
            names = names.fill_null(0).to_numpy()
            for rows, sets, fp in shingle_sets(batch.column(1), width):
                docs = np.zeros(len(sets), dtype=_DOC)
                docs["doc_id"], docs["known"], docs["fp"] = names[rows], known[rows], fp
                docs["n"] = [len(s) for s in sets]
                fresh = []
                for i, (f, n) in enumerate(zip(fp.tolist(), docs["n"].tolist())):
                    if f not in refs:
                        refs[f] = len(refs)
                        docs["first"][i] = True
                        if n:
                            fresh.append(i)
                    docs["ref"][i] = refs[f]
                docs["ref"] = task | (docs["ref"] << np.uint64(2))
                out = []
                if fresh:
                    values, sizes = np.concatenate([sets[i] for i in fresh]), docs["n"][fresh].astype(np.int64)
                    fresh = np.array(fresh)
                    band = band_of(sizes)
                    above = sizes >= np.ceil(0.75 * (upper(band) + 1))
                    for role in range(4):  # own band, band above, and the spare grids of both
                        here = np.ones(len(sizes), dtype=bool) if role == 0 else above if role == 1 else (docs["parts"][fresh, role - 2] <= sizes // 3) & (docs["parts"][fresh, role - 2] > 0)
                        if not here.any():
                            continue
                        some = values if here.all() else values[np.repeat(here, sizes)]
                        sig, owner = signatures(some, sizes[here], (band + role % 2)[here], spare=role > 1)
                        at = fresh[here]
                        docs["parts"][at, role] = np.bincount(owner, minlength=len(at))
                        out.append((sig, docs["ref"][at][owner] | np.uint64(role)))
                yield from _packed(wb.mix(docs["ref"] >> np.uint64(2)) % np.uint64(parts), docs, 0, parts)
                if out:
                    sig, ref = (np.concatenate(x) for x in zip(*out))
                    pending.append((sig, ref))
                    if sum(len(s) for s, _ in pending) >= 1_500_000:
                        yield from flush()
        yield from flush()

    pending: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if pending:
            sig, ref = (np.concatenate(x) for x in zip(*pending))
            pending.clear()
            key = (sig >> np.uint64(40)) % np.uint64(parts)
            order = np.argsort(key.astype(np.uint32), kind="stable")
            sig, ref, counts = sig[order], ref[order], np.bincount(key.astype(np.int64), minlength=parts)
            stops = np.cumsum(counts)
            for k in np.flatnonzero(counts).tolist():
                cut = slice(stops[k] - counts[k], stops[k])
                base = int(ref[cut].min())
                # 5 bytes of signature and 4 of reference, the high bytes of both in planes of their own
                s, r = sig[cut] & _BITS40, (ref[cut] - np.uint64(base)).astype("<u4")
                blob = np.uint64(base).tobytes() + s.astype("<u4").tobytes() + (s >> np.uint64(32)).astype("u1").tobytes() + r.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([1], type=pa.int32()), pa.array([blob])], schema=_ROW)

    return run


def _unblob(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = (len(blob) - 8) // 9
    base = np.frombuffer(blob, "<u8", 1)[0]
    low, high = np.frombuffer(blob, "<u4", n, 8), np.frombuffer(blob, "u1", n, 8 + 4 * n)
    ref = np.frombuffer(blob, np.uint8, 4 * n, 8 + 5 * n).view("<u4") if n else np.zeros(0, "<u4")
    return low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32), ref.astype(np.uint64) + base


def _share(parts: int):
    """All signatures of some keys: those that several classes of texts have, by the reference's key (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            forward = pa.compute.equal(batch.column("kind"), 0)
            if pa.compute.any(forward).as_py():
                yield batch.filter(forward)
            for key, kind, blob in zip(*[c.to_pylist() for c in batch.columns]):
                if kind == 1:
                    got.setdefault(key, []).append(_unblob(blob))
        for key in list(got):
            sig, ref = (np.concatenate(x) for x in zip(*got.pop(key)))
            order = np.argsort(sig, kind="stable")
            sig, ref = sig[order], ref[order]
            at = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
            counts = np.diff(np.append(at, len(sig)))
            count = np.repeat(counts, counts)
            shared = count > 1
            rows = np.zeros(int(shared.sum()), dtype=_SHARED)
            # the key completes the signature
            rows["sig"], rows["ref"], rows["count"] = sig[shared] | np.uint64(key & 0xFFFFFF) << np.uint64(40), ref[shared], count[shared]
            yield from _packed(wb.mix(rows["ref"] >> np.uint64(2)) % np.uint64(parts), rows, 1, parts)

    return run


_ROLES = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("n", pa.int64()), ("band", pa.int64()), ("shared", pa.int64()), ("sigs", pa.binary())])
_ROLES_DDL = "doc_id long, fp long, n long, band long, shared long, sigs binary"


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as rows; and for classes that may have partners, their rarest signatures, by role."""
    docs, shared = [], []
    for batch in batches:
        for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist()):
            (shared if kind else docs).append(np.frombuffer(blob, _SHARED if kind else _DOC))
    if not docs:
        return
    doc = np.concatenate(docs)
    for k in range(0, len(doc), 20_000):
        d = doc[k : k + 20_000]
        none = pa.nulls(len(d), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(d["doc_id"], mask=~d["known"]), pa.array(d["fp"].view(np.int64)), pa.array(d["n"].astype(np.int64)), none, none, pa.nulls(len(d), pa.binary())], schema=_ROLES)
    if not shared:
        return
    first = doc[doc["first"]]
    first = first[np.argsort(first["ref"])]
    rows = np.concatenate(shared)
    rows = rows[np.lexsort((rows["sig"], rows["count"], rows["ref"]))]
    at = np.flatnonzero(np.append(True, rows["ref"][1:] != rows["ref"][:-1]))
    stop = np.append(at[1:], len(rows))
    own = np.searchsorted(first["ref"], rows["ref"][at] & ~np.uint64(3))
    role = (rows["ref"][at] & np.uint64(3)).astype(np.int64)
    n, p = first["n"][own].astype(np.int64), first["parts"][own, role].astype(np.int64)
    most, band = n // 3, band_of(n) + role % 2
    keep = np.flatnonzero(stop - at >= np.maximum(1, p - most))
    out: dict[str, list] = {f.name: [] for f in _ROLES}
    for k in keep.tolist():
        left = int(most[k] + 1 - (p[k] - (stop[k] - at[k])))  # signatures of one class alone come first
        if left > 0:
            for name, value in zip(out, (None, int(first["fp"][own[k]].view(np.int64)), int(n[k]), int(band[k]), int(stop[k] - at[k]), rows["sig"][at[k] : at[k] + left].tobytes())):
                out[name].append(value)
    for k in range(0, len(out["fp"]), 5_000):
        yield common.table({name: v[k : k + 5_000] for name, v in out.items()}, _ROLES)


_ENTRY = np.dtype([("sig", "<u8"), ("fp", "<i8"), ("root", "<i8"), ("n", "<i4"), ("shared", "<i4"), ("band", "<i4")])


def _deal(parts: int):
    """Signatures by key, each with its class, size, band, shared signatures and component so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = [np.frombuffer(x, "<u8") for x in batch.column("sigs").to_pylist()]
            size = np.array([len(x) for x in sigs], dtype=np.int64)
            rows = np.zeros(int(size.sum()), dtype=_ENTRY)
            if len(rows):
                rows["sig"] = np.concatenate(sigs)
                for name in ("fp", "root", "n", "shared", "band"):
                    rows[name] = np.repeat(batch.column(name).to_numpy(), size)
                yield from _packed(wb.mix(rows["sig"]) % np.uint64(parts), rows, 1, parts)

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries by signature and band, the class with most shared signatures first, and each group's start and stop; only groups of several components.

    The signature is cut short, so those of two bands may be equal: they are two groups."""
    got = [np.frombuffer(x, _ENTRY) for b in batches for x in b.column("blob").to_pylist()]
    if not got:
        return np.zeros(0, dtype=_ENTRY), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rows = np.concatenate(got)
    rows = rows[np.lexsort((rows["fp"], rows["band"], rows["sig"]))]
    group = (rows["sig"][1:] != rows["sig"][:-1]) | (rows["band"][1:] != rows["band"][:-1])
    rows = rows[np.append(True, group | (rows["fp"][1:] != rows["fp"][:-1]))]
    rows = rows[np.lexsort((rows["fp"], -rows["shared"], rows["band"], rows["sig"]))]
    at = np.flatnonzero(np.append(True, (rows["sig"][1:] != rows["sig"][:-1]) | (rows["band"][1:] != rows["band"][:-1])))
    stop = np.append(at[1:], len(rows))
    several = np.minimum.reduceat(rows["root"], at) != np.maximum.reduceat(rows["root"], at)
    return rows, at[several], stop[several]


def _leading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a group's leading class (a) with each other class (b) of a fitting size."""
    rows, at, stop = _groups(batches)
    if len(at):
        size = stop - at
        first = np.repeat(at, size)
        own = first + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        n, m = rows["n"][first].astype(np.int64), rows["n"][own].astype(np.int64)
        ok = (own != first) & (4 * np.minimum(n, m) >= 3 * np.maximum(n, m))
        both, count = np.unique(np.stack([rows["fp"][first[ok]], rows["fp"][own[ok]]], axis=1), axis=0, return_counts=True)
        for k in range(0, len(both), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[k : k + 100_000, 0])), pa.array(np.ascontiguousarray(both[k : k + 100_000, 1])), pa.array(count[k : k + 100_000].astype(np.int64))], names=["a", "b", "hits"])


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of groups that still hold several components."""
    rows, at, stop = _groups(batches)
    if len(at):
        keep = np.zeros(len(rows) + 1, dtype=np.int64)
        np.add.at(keep, at, 1)
        np.add.at(keep, stop, -1)
        rows = rows[np.cumsum(keep)[:-1] > 0]
        for k in range(0, len(rows), 100_000):
            r = rows[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(r["sig"].view(np.int64)), *[pa.array(r[c].astype(np.int64)) for c in ("fp", "root", "n", "band")]], names=["sig", "fp", "root", "n", "band"])


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One map per class and band; its length depends on the band alone, four bits per shingle or more."""
    for batch in batches:
        maps = []
        for blob, band in zip(batch.column("items").to_pylist(), batch.column("band").to_pylist()):
            length = max(2048, 64 * -(-4 * int(upper(np.array(band))) // 64))
            bits = np.zeros(length, dtype=np.uint8)
            # the parity of each bit's shingles: one differing shingle flips one bit
            np.bitwise_xor.at(bits, (_items(blob) * np.uint64(length) >> np.uint64(40)).astype(np.int64) if length < 1 << 23 else (_items(blob) % np.uint64(length)).astype(np.int64), 1)
            maps.append(np.packbits(bits).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("fp"), batch.column("band"), common.binary_rows(maps)], names=["fp", "band", "map"])


def _near(closest: bool):
    """Pairs (a < b) between components whose maps differ in no more bits than linked sets may differ in shingles.

    closest: of each class's pairs with one component, the one with the smallest difference."""
    return lambda batches: _near_pairs(batches, closest)


def _near_pairs(batches: Iterator[pa.RecordBatch], closest: bool) -> Iterator[pa.RecordBatch]:
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    table = pa.Table.from_batches(got)
    columns = {c: table.column(c).to_numpy() for c in ("sig", "fp", "root", "n", "band")}
    order = np.lexsort((columns["fp"], columns["band"], columns["sig"]))
    maps = table.column("map").to_pylist()
    del got, table
    sig, fp, root, n, band = (columns[c][order] for c in ("sig", "fp", "root", "n", "band"))
    at = np.flatnonzero(np.append(True, (sig[1:] != sig[:-1]) | (band[1:] != band[:-1])))
    pairs, held = [], 0

    def emit() -> Iterator[pa.RecordBatch]:
        if pairs:
            both = np.unique(np.concatenate(pairs), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1]))], names=["a", "b"])

    for a, b in zip(at.tolist(), np.append(at[1:], len(sig)).tolist()):
        bits = np.frombuffer(b"".join([maps[k] for k in order[a:b].tolist()]), np.uint64).reshape(b - a, -1)
        names, size = np.unique(root[a:b], return_counts=True)
        largest = names[np.argmax(size)]
        outside = root[a:b] != largest
        for x in np.flatnonzero(outside).tolist():  # each class outside the largest component against the others
            other = root[a:b] != root[a + x]
            other[:x] &= ~outside[:x]  # pairs outside it once
            y = a + np.flatnonzero(other)
            y = y[4 * np.minimum(n[a + x], n[y]) >= 3 * np.maximum(n[a + x], n[y])]
            apart = np.bitwise_count(bits[y - a] ^ bits[x]).sum(axis=1, dtype=np.int64)
            close = apart <= (n[a + x] + n[y]) // 7
            y, apart = y[close], apart[close]
            if closest and len(y) > 1:
                rank = np.lexsort((fp[y], apart, root[y]))
                y = y[rank[np.append(True, root[y][rank][1:] != root[y][rank][:-1])]]
            if len(y):
                pairs.append(np.stack([np.minimum(fp[y], fp[a + x]), np.maximum(fp[y], fp[a + x])], axis=1))
                held += len(y)
        if held > 500_000:
            yield from emit()
            pairs, held = [], 0
    yield from emit()


def _sets(width: int, bits):
    """5-byte shingle sets of the documents that the filter lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(common.passes(bits.value, batch.column("bit").to_numpy())))
            for rows, sets, fp in shingle_sets(batch.column("text"), width):
                cut = [np.unique(s & _BITS40) for s in sets]
                blobs = [s.astype("<u4").tobytes() + (s >> np.uint64(32)).astype("u1").tobytes() for s in cut]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(rows.start, rows.stop - rows.start), pa.array(fp.view(np.int64)), common.binary_rows(blobs)], names=["doc_id", "fp", "items"])

    return run


def _items(blob: bytes) -> np.ndarray:
    n = len(blob) // 5
    return np.frombuffer(blob, "<u4", n).astype(np.uint64) | np.frombuffer(blob, "u1", n, 4 * n).astype(np.uint64) << np.uint64(32)


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, last, left = [], None, None
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            if x is not last and x != last:
                last, left = x, _items(x)
            right = _items(y)
            both = len(left) + len(right) - len(np.union1d(left, right))
            keep.append(100 * both >= 75 * (len(left) + len(right) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = pairs.join(sets.select(F.col("fp").alias("b"), F.col("items").alias("y")), "b")
    both = left.join(sets.select(F.col("fp").alias("a"), F.col("items").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(common.tidy(_decide), "a long, b long")


def jaccard_groups(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) for each row of (doc_id, text)."""
    spark = docs.sparkSession
    parts = common.parts(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = rows.mapInArrow(common.tidy(_sign(width, parts)), _ROW_DDL).repartition(parts, "key")
    shared = signed.mapInArrow(common.tidy(_share(parts)), _ROW_DDL).repartition(parts, "key")
    found = common.stage(shared.mapInArrow(common.tidy(_prune), _ROLES_DDL), "roles")
    members = found.where("sigs is null").select("doc_id", "fp", "n")
    roles = found.where("sigs is not null").select("fp", "n", "band", "shared", "sigs")
    classes = members.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("rep"))
    needed = roles.select("fp").distinct().join(classes, "fp").where("rep is not null").select(F.col("rep").alias("doc_id"), "fp")
    bits = common.id_filter(needed.select("doc_id"))
    sets = rows.select("doc_id", "text", common.filter_bit("doc_id")).where("doc_id is not null").mapInArrow(common.tidy(_sets(width, bits)), "doc_id long, fp long, items binary")
    # a doc_id may be repeated: the class decides, one row of it is enough
    sets = common.stage(sets.join(needed, ["doc_id", "fp"], "left_semi").groupBy("fp").agg(F.first("items").alias("items")), "sets")

    def dealt(roots: DataFrame) -> DataFrame:
        return roots.select("fp", "n", "band", "shared", "sigs", "root").mapInArrow(common.tidy(_deal(parts)), _ROW_DDL).repartition(parts, "key")

    first = dealt(roles.withColumn("root", F.col("fp"))).mapInArrow(common.tidy(_leading), "a long, b long, hits long").groupBy("a", "b").agg(F.sum("hits").alias("hits"))
    edges = common.stage(_verified(first.groupBy("b").agg(F.max_by("a", F.struct("hits", "a")).alias("a")), sets), "links")
    trees = common.components(edges)
    rooted = roles.join(trees.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    open_ = common.stage(dealt(rooted).mapInArrow(common.tidy(_open), "sig long, fp long, root long, n long, band long"), "open")
    maps = open_.select("fp", "band").distinct().join(sets, "fp").select("fp", "band", "items").mapInArrow(common.tidy(_bitmaps), "fp long, band long, map binary")
    for closest in (True, False):  # first one pair per class and component, then whatever is still apart
        near = open_.join(maps, ["fp", "band"]).repartition(parts, "sig").mapInArrow(common.tidy(_near(closest)), "a long, b long").distinct()
        edges = edges.union(common.stage(_verified(near, sets), "links"))
        trees = common.components(edges)
        now = trees.toDF("fp", "now")
        open_ = open_.join(now, "fp", "left").select("sig", "fp", F.coalesce("now", "fp").alias("root"), "n", "band")
    # smallest doc_id of each component of classes
    with_root = classes.join(trees.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = with_root.groupBy("root").agg(F.min("rep").alias("component"))
    of_class = with_root.join(least, "root").select("fp", "component")
    out = members.join(of_class, "fp", "left")
    own = F.when((F.col("n") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
