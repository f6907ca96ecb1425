"""Bigram similarity of long tables of name pairs, a batch at a time.

The column builders in functions.text judge a pair by lists of bigrams, element by element. Here a task judges the
pairs of a batch together: the bigrams of all names as one array of numbers, sorted and counted. Results are the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A pair's number among those judged together and the two code points of a bigram share 63 bits.
POINT_BITS = 21
# Pairs that are judged together: few enough that their bigrams stay in a core's cache.
MOST_PAIRS = 2_000

Grams = tuple[np.ndarray, np.ndarray]


def _grams(names: pa.Array) -> Grams:
    """Distinct bigrams of each name, a pair's number and two code points in one number, sorted; and how often each occurs."""
    names = pc.fill_null(names, "").cast(pa.large_string())
    _, ends, data = names.buffers()
    ends = np.frombuffer(ends, np.int64)[names.offset : names.offset + len(names) + 1]
    raw = data[ends[0] : ends[-1]].to_pybytes() if data else b""
    ends = ends - ends[0]
    if raw.isascii():
        points = np.frombuffer(raw, np.uint8).astype(np.int64)
    else:
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])[ends]
    pairs = np.repeat(np.arange(len(names)), np.diff(ends))
    grams = (pairs[:-1] << 2 * POINT_BITS | points[:-1] << POINT_BITS | points[1:])[pairs[:-1] == pairs[1:]]
    grams.sort()
    firsts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])[: len(grams)])
    return grams[firsts], np.diff(np.append(firsts, len(grams)))


def _share(left: Grams, right: Grams, n: int, repeats: bool) -> np.ndarray:
    """Twice the bigrams that both names have over those of either, with their repeats or without; 0 if there are none."""
    (a, a_n), (b, b_n) = left, right
    at = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
    same = b[at] == a if len(b) else np.zeros(len(a), bool)
    each = np.minimum(a_n[same], b_n[at[same]]) if repeats else None
    shared = np.bincount(a[same] >> 2 * POINT_BITS, weights=each, minlength=n)
    total = sum(np.bincount(g >> 2 * POINT_BITS, weights=k if repeats else None, minlength=n) for g, k in (left, right))
    return np.divide(shared * 2.0, total, out=np.zeros(n), where=total > 0)


def _dice_multiset(a: pa.Array, b: pa.Array) -> np.ndarray:
    a, b = pc.fill_null(a, ""), pc.fill_null(b, "")
    equal = pc.equal(a, b).to_numpy(zero_copy_only=False)
    empty = pc.or_(pc.equal(a, ""), pc.equal(b, "")).to_numpy(zero_copy_only=False)
    return np.where(empty, 0.0, np.where(equal, 1.0, _share(_grams(a), _grams(b), len(a), repeats=True)))


def _dice_set(a: pa.Array, b: pa.Array) -> np.ndarray:
    padded = [pc.binary_join_element_wise("", names, "", "  ") for names in (a, b)]
    return _share(_grams(padded[0]), _grams(padded[1]), len(a), repeats=False)


def with_dice(pairs: DataFrame, multiset: tuple[str, str], padded: tuple[str, str]) -> DataFrame:
    """dice_multi (functions.text.dice_multiset) of two columns and dice_padded (dice_set) of two others, which are dropped."""
    made = pairs.drop(*multiset, *padded).withColumns({"dice_multi": F.lit(0.0), "dice_padded": F.lit(0.0)})
    schema, kept = made.schema, made.columns[:-2]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, MOST_PAIRS):
                batch = whole.slice(start, MOST_PAIRS)
                dice = [_dice_multiset(*[batch.column(c) for c in multiset]), _dice_set(*[batch.column(c) for c in padded])]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *[pa.array(d) for d in dice]], names=[*kept, "dice_multi", "dice_padded"])

    return pairs.mapInArrow(judge, schema)
