"""Sequence packing by length patterns fitted with non-negative least squares (operator 4).

Documents become pieces of at most `limit` ids (an end id closes each document;
only longer ones are cut). Only the histogram of piece lengths, at most `limit`
numbers whatever the input, reaches the driver. There, patterns of few lengths
that fill a sequence are enumerated, repeat counts are fitted to the histogram by
non-negative least squares and rounded down, and what is left is packed best-fit,
again on counts. The plan says which repeat of which pattern takes the r-th piece
of each length; pieces get their rank from per-partition counts and look up
their place.

Nulls and ties: a null text is empty and gives one piece with the end id; null
doc_ids and repeated rows are packed like others. An empty table gives no rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poifuse.llm import common
from poifuse.llm.tokens import encoder

LIMIT = 2048
END_ID = 0
FULL = 0.998  # patterns take part in the fit if they fill so much of a sequence
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int64()), ("nth", pa.int64())])
_PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"


def _pieces(path: str, limit: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, seen = context.partitionId() if context else 0, np.zeros(limit + 1, dtype=np.int64)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for rows, ids, first in encoder(path).column(batch.column(1)):
                out: dict[str, list] = {f.name: [] for f in _PIECES}
                for i in range(rows.start, rows.stop):
                    own = np.append(ids[first[i - rows.start] : first[i - rows.start + 1]], np.uint32(end_id)).astype("<u4")
                    for k, at in enumerate(range(0, len(own), limit)):
                        cut = own[at : at + limit]
                        for name, value in (("doc_id", names[i]), ("piece", k), ("start", at), ("length", len(cut)), ("ids_crc32", zlib.crc32(cut.tobytes())), ("part", part), ("nth", int(seen[len(cut)]))):
                            out[name].append(value)
                        seen[len(cut)] += 1
                yield common.table(out, _PIECES)

    return run


def pieces(docs: DataFrame, tokenizer: str, limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """Pieces with their checksum, task number, and rank among the task's pieces of the same length; written once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return common.stage(rows.mapInArrow(common.tidy(_pieces(tokenizer, limit, end_id)), _PIECES_DDL), "pieces")


def nnls(rows: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative x near the least squares solution of A x = b: accelerated projected gradient with restarts.

    A is sparse: column k has a one, added up, at each of rows[k]; row 0 is padding and doesn't count."""

    def forward(x: np.ndarray) -> np.ndarray:
        out = np.bincount(rows.ravel(), weights=np.repeat(x, rows.shape[1]), minlength=len(b))
        out[0] = 0
        return out

    def back(y: np.ndarray) -> np.ndarray:
        return y[rows].sum(axis=1)

    v = np.ones(len(rows))
    for _ in range(30):
        v = back(forward(v))
        v /= max(np.linalg.norm(v), 1e-30)
    step = 1 / max(float(v @ back(forward(v))) * 1.01, 1e-30)
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(forward(y) - b))
        if (y - new) @ (new - x) > 0:
            t, y = 1.0, new
        nxt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / nxt * (new - x)
        x, t = new, nxt
    return x


def patterns(histogram: np.ndarray, limit: int, most: int = 4) -> list[tuple[int, ...]]:
    """Length patterns that fill a sequence: every pair with the rest, and from each length runs of most-wanted lengths."""
    have = np.flatnonzero(histogram)
    found: set[tuple[int, ...]] = set()
    for x in have[::-1].tolist():
        for pick in range(most):  # fill up from large to small, starting at different ranks
            rest, own, at = limit - x, [x], pick
            while rest > 0 and len(own) < most:
                fits = have[have <= min(rest, own[-1])]
                if not len(fits):
                    break
                y = int(fits[max(0, len(fits) - 1 - at * max(1, len(fits) // (2 * most)))])
                if len(own) == most - 1 or rest - y < have[0]:
                    y = int(fits[-1])
                own.append(y)
                rest -= y
                at = 0
            found.add(tuple(own))
        exact = have[(have <= x) & np.isin(limit - x - have, have)]
        for y in exact[:: max(1, len(exact) // 3)][:4].tolist():
            found.add(tuple(sorted((x, y, limit - x - y), reverse=True)))
    return sorted(found)


def plan(histogram: np.ndarray, limit: int = LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) rows that use each length exactly as often as the histogram says."""
    left = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...], repeats: int) -> None:
        for x in lengths:
            left[x] -= repeats
        out.append((lengths, repeats))

    if left[limit]:
        take((limit,), int(left[limit]))
    options = [p for p in patterns(left, limit) if sum(p) >= FULL * limit]
    if options:
        width = max(map(len, options))
        scale = max(1, int(left.max()))
        fit = nnls(np.array([p + (0,) * (width - len(p)) for p in options]), left / scale) * scale
        for k in np.argsort(-fit, kind="stable").tolist():
            need = np.bincount(options[k], minlength=limit + 1)
            used = np.flatnonzero(need)
            repeats = min(int(fit[k]), int((left[used] // need[used]).min()))
            if repeats > 0:
                take(options[k], repeats)
    while left.any():  # residuals: the largest length first, each time the best fit among what is left
        have = np.flatnonzero(left)
        own, rest = [int(have[-1])], limit - int(have[-1])
        need = {own[0]: 1}
        while True:
            fits = [x for x in have[have <= rest].tolist()[::-1][:64] if left[x] > need.get(x, 0)]
            if not fits:
                more = [x for x in have[have <= rest].tolist() if left[x] > need.get(x, 0)]
                if not more:
                    break
                fits = [more[-1]]
            own.append(fits[0])
            need[fits[0]] = need.get(fits[0], 0) + 1
            rest -= fits[0]
        take(tuple(own), max(1, min(int(left[x]) // k for x, k in need.items())))
    return out


def _lookup(rows: list[tuple[tuple[int, ...], int]], limit: int) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first rank of each slot, and the slot's first sequence, offset in the sequence."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for lengths, repeats in rows:
        offset = 0
        for x in lengths:
            slots.setdefault(x, []).append((repeats, sequence, offset))
            offset += x
        sequence += repeats
    return {x: (np.cumsum([0] + [r for r, _, _ in s])[:-1], np.array([q for _, q, _ in s]), np.array([o for _, _, o in s])) for x, s in slots.items()}


def pack(found: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Place staged pieces: adds sequence_id and offset, gapless from 0 in each sequence."""
    counts = found.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = np.zeros(limit + 1, dtype=np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `limit` rows
        histogram[row["length"]] = row["n"]
    where = found.sparkSession.sparkContext.broadcast(_lookup(plan(histogram, limit), limit))  # bounded by the number of patterns
    before = counts.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = found.join(before, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            for x in np.unique(length).tolist():
                own = np.flatnonzero(length == x)
                firsts, sequences, offsets = where.value[x]
                k = np.searchsorted(firsts, rank[own], side="right") - 1
                sequence[own], offset[own] = sequences[k] + rank[own] - firsts[k], offsets[k]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")], pa.array(sequence), pa.array(offset)], schema=schema)

    return ranked.mapInArrow(common.tidy(place), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of (doc_id, text)."""
    return pack(pieces(docs, tokenizer, limit, end_id), limit)
