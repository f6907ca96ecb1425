"""Benchmark passages in training documents by suffix arrays over the training side (operator 13).

Each task takes its documents in shards of bounded size. The suffixes of a shard that
can start a match are sorted into a suffix array: ordered by their first `window`
words, which is as deep as a search goes. A suffix can start a match if its first
words (at most START) are in a fixed-size bitmap of the first words of benchmark
windows; the bitmap only spares work, it never decides. Every suffix of a benchmark
text that starts a window is then looked up by binary search, all together and word by
word, in every shard. Matches of consecutive windows on one diagonal are chained to the
longest verbatim match, with its place in the item and in the document.

The benchmark is the stated query set: it goes to the tasks in blocks of bounded size
(BLOCK_WORDS words, long items in pieces that overlap by a window), one pass after the
other, each pass adding to the rows of the one before. Documents are never shuffled or
grouped, so a passage that a third of them hold is work of all tasks alike; equal
benchmark windows are one window with a list of items.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z, compared by
64-bit hashes. Cases: a null or empty text has no words and no hits; an item without
words has no window; a null item_id counts as an item, but is not in the list of ids;
rows that repeat an item_id are one item with the windows of all of them. Repeated and
null doc_ids are judged row by row. Other columns pass through `decontaminate`; an
empty table gives no rows, an empty benchmark leaves all documents clean."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poifuse.llm import common
from poifuse.llm import wordbytes as wb

WINDOW = 10
START = 4  # words of a suffix that the bitmap looks at
BLOCK_WORDS = 500_000  # benchmark words in one pass, about
PIECE_WORDS = 5_000  # longer items are searched in pieces
SHARD_BYTES = 4 << 20  # text in one suffix array, about; one longer document is a shard of its own
FILTER_BITS = 1 << 22

#: Bytes of text as they are compared: A-Z in lower case, what is in no word as a space.
_BYTES = wb.LOWER.copy()
_BYTES[[b for b in range(128) if not chr(b).isalnum()]] = 0x20


def hashed(column: pa.Array, shard: int = SHARD_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """For shards of whole rows: the rows, the hashes of all their words, and each row's first word."""
    data, bounds = wb.text_column(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + shard, side="right")) - 1)
        piece = _BYTES[data[bounds[row] : bounds[stop]]]
        start, end, first = wb.split(piece, bounds[row : stop + 1] - bounds[row])
        yield slice(row, stop), wb.span_hash(wb.prefix_hash(wb._VALUES[piece]), start, end), first
        row = stop
    pa.default_memory_pool().release_unused()


def starts(prefix: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Bit of the words at each place."""
    return (wb.span_hash(prefix, at, at + width) % np.uint64(FILTER_BITS)).astype(np.int64)


class Queries:
    """The distinct windows of a block of benchmark texts, by length, with their items."""

    def __init__(self, items: list[int | None], texts: pa.Array, window: int = WINDOW) -> None:
        words, windows, owner, text_from = [], [], [], []
        base = 0
        for rows, hashes, first in hashed(texts):
            for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist()), rows.start):
                n = b - a
                text_from.append(base + a)
                for at in range(max(1, n - window + 1) if n else 0):
                    windows.append((base + a + at, min(window, n)))
                    owner.append(i)
            words.append(hashes)
            base += len(hashes)
        self.window = window
        self.words = np.concatenate([*words, np.zeros(window, dtype=np.uint64)])
        at = np.array(windows, dtype=np.int64).reshape(-1, 2)
        prefix = wb.prefix_hash(self.words)
        key = wb.span_hash(prefix, at[:, 0], at[:, 0] + at[:, 1])
        self.names = sorted({x for x in items if x is not None})
        number = {x: k for k, x in enumerate(self.names)} | {None: len(self.names)}
        own = np.array([number[items[i]] for i in owner], dtype=np.int64)
        distinct, example, inverse = np.unique(key, return_index=True, return_inverse=True)
        self.start, self.length = at[example, 0], at[example, 1]
        by_class = np.argsort(inverse, kind="stable")  # every place of each window
        self.places, self.owners = at[by_class, 0], own[by_class]
        self.place_from = np.searchsorted(inverse[by_class], np.arange(len(distinct) + 1))
        self.text_from = np.array(text_from, dtype=np.int64)
        self.class_at = np.full(len(self.words) + 1, -1, dtype=np.int64)
        self.class_at[at[:, 0]] = inverse
        pairs = np.unique(np.stack([inverse, own], axis=1), axis=0) if len(own) else np.zeros((0, 2), dtype=np.int64)
        self.items, self.item_from = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
        self.lengths = sorted(set(self.length.tolist()))
        self.bits = {}
        for n in self.lengths:  # windows as long or longer than START look at so many words
            width = min(n, START)
            bits = self.bits.setdefault(width, np.zeros(FILTER_BITS, dtype=bool))
            bits[starts(prefix, self.start[self.length == n], width)] = True


def suffix_array(words: np.ndarray, last: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes at the given places, sorted by their first `depth` words; a text's end comes before any word."""
    columns = []
    for d in range(depth):
        inside = at + d < last[at]
        columns.append(np.where(inside, words[np.minimum(at + d, len(words) - 1)], 0))
    return at[np.lexsort(columns[::-1])] if len(at) else at


def search(words: np.ndarray, last: np.ndarray, suffixes: np.ndarray, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
    """(query window, place in words) of every occurrence: binary search of each query, narrowed word by word."""
    low = np.zeros(len(queries.start), dtype=np.int64)
    high = np.full(len(low), len(suffixes), dtype=np.int64)

    def bound(q: np.ndarray, d: int, lo: np.ndarray, hi: np.ndarray, after: bool) -> np.ndarray:
        """First suffix in [lo, hi) whose word d is not below (or is above) the query's."""
        lo, hi, want = lo.copy(), hi.copy(), queries.words[queries.start[q] + d]
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            at = suffixes[np.minimum(mid, len(suffixes) - 1)] + d
            word = np.where(at < last[np.minimum(at - d, len(last) - 1)], words[np.minimum(at, len(words) - 1)], 0)
            less = (word <= want if after else word < want) & open_
            lo = np.where(less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)
        return lo

    for d in range(queries.window):
        q = np.flatnonzero((queries.length > d) & (low < high))
        if not len(q) or not len(suffixes):
            break
        new = bound(q, d, low[q], high[q], False), bound(q, d, low[q], high[q], True)
        low[q], high[q] = new
    count = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + low[which]
    return which, suffixes[at]


def occurrences(words: np.ndarray, first: np.ndarray, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of the block's windows in one shard."""
    last = np.repeat(first[1:], np.diff(first))
    if not len(words) or not queries.lengths:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    prefix, able = wb.prefix_hash(words), np.zeros(len(words), dtype=bool)
    for width, bits in queries.bits.items():
        at = np.flatnonzero(np.arange(len(words)) + width <= last)
        able[at] |= bits[starts(prefix, at, width)]
    suffixes = suffix_array(words, last, np.flatnonzero(able), queries.window)
    # windows shorter than the longest may end where a text ends
    which, at = search(words, last, suffixes, queries)
    return which, at


def _pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, text) with texts of bounded length: long items as pieces that share window - 1 words."""
    cut = F.expr(f"transform(sequence(0, greatest(size(w) - {window}, 0) div {PIECE_WORDS}), k -> array_join(slice(w, k * {PIECE_WORDS} + 1, {PIECE_WORDS + window - 1}), ' '))")
    words = F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), words.alias("w")).where("size(w) > 0").select("item_id", F.explode(cut).alias("text"))


def blocks(spark: SparkSession, benchmark: DataFrame, window: int, block_words: int) -> Iterator[Queries]:
    """The benchmark in blocks of about block_words words, one at a time."""
    pieces = common.stage(_pieces(benchmark, window), "benchmark")
    total = pieces.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1)).first()[0] or 0
    n = -(-total // block_words)
    for k in range(n):
        own = pieces.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).toArrow().sort_by([("item_id", "ascending"), ("text", "ascending")])
        yield Queries(own.column("item_id").to_pylist(), own.column("text").combine_chunks(), window)


def _judge(queries):
    """One pass: adds the pass's hit words (a bitmap) and items to each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = queries.value
        for batch in batches:
            names = batch.schema.names
            old_hit, old_items = batch.column(names.index("hit_bits")), batch.column(names.index("items"))
            for rows, words, first in hashed(batch.column(names.index("text"))):
                which, at = occurrences(words, first, block)
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + block.length[which], -1)
                hit = np.cumsum(edge)[:-1] > 0
                row = np.searchsorted(first, at, side="right") - 1
                # equal windows of a row count once
                seen = np.unique(row * np.int64(len(block.start) + 1) + which)
                row, which = np.divmod(seen, len(block.start) + 1)
                begin = np.searchsorted(row, np.arange(rows.stop - rows.start + 1))
                n_words, bits, items = np.diff(first), [], []
                for i in range(rows.stop - rows.start):
                    own = hit[first[i] : first[i + 1]]
                    before = old_hit[rows.start + i].as_py()
                    if before is not None and own.size:
                        own = own | np.unpackbits(np.frombuffer(before, dtype=np.uint8), count=own.size).astype(bool)
                    bits.append(np.packbits(own).tobytes())
                    mine = which[begin[i] : begin[i + 1]]
                    got = set(old_items[rows.start + i].as_py() or ())
                    if len(mine):
                        spans = [block.items[block.item_from[w] : block.item_from[w + 1]] for w in mine.tolist()]
                        got.update(block.names[k] if k < len(block.names) else None for k in np.unique(np.concatenate(spans)).tolist())
                    items.append(sorted(got, key=lambda x: (x is not None, x or 0)))
                made = {"n_words": pa.array(n_words), "hit_bits": pa.array(bits, type=pa.binary()), "items": pa.array(items, type=pa.list_(pa.int64()))}
                part = batch.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays([made[n] if n in made else part.column(n) for n in names], schema=batch.schema)

    return run


def marked(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(row: all columns of docs, text, n_words, hit_bits: packed bits of hit words, items: sorted ids of the items with an occurring window)."""
    spark = docs.sparkSession
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumns({"n_words": F.lit(None).cast("long"), "hit_bits": F.lit(None).cast("binary"), "items": F.lit(None).cast("array<long>")})
    passes = 0
    for block in blocks(spark, benchmark, window, block_words):
        if passes:
            rows = common.stage(rows, "passes")
        rows = rows.mapInArrow(_judge(spark.sparkContext.broadcast(block)), rows.schema)  # block_words words and their bitmaps
        passes += 1
    if not passes:
        rows = rows.mapInArrow(_judge(spark.sparkContext.broadcast(Queries([], pa.array([], type=pa.string()), window))), rows.schema)
    return rows


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_hit = [int(np.unpackbits(np.frombuffer(b, dtype=np.uint8)).sum()) for b in batch.column("hit_bits").to_pylist()]
        items = batch.column("items").to_pylist()
        text = [hashlib.sha256(",".join(sorted(str(x) for x in own if x is not None)).encode()).hexdigest() for own in items]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(n_hit, type=pa.int64()), pa.array([len(x) for x in items], type=pa.int64()), pa.array(text), pa.array([n > 0 for n in n_hit])],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    rows = marked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, window, block_words)
    rows = rows.select("row.doc_id", "n_words", "hit_bits", "items")
    return rows.mapInArrow(_digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without a hit word, with their own columns."""
    rows = marked(docs, benchmark, window, block_words)
    return rows.where("size(items) = 0").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def longest(at: np.ndarray, which: np.ndarray, queries: Queries) -> Iterator[tuple[int, int, int]]:
    """(place in the document, place in the block's words, words) of the longest match from each place that no match before it covers.

    at is ascending. All places of the first window are carried along the diagonal together until none goes on."""
    class_of: dict[int, list[int]] = {}
    for p, w in zip(at.tolist(), which.tolist()):
        class_of.setdefault(p, []).append(w)
    done = -1  # last window start that is part of a reported match
    for p, found in class_of.items():
        for w in found:
            spots = queries.places[queries.place_from[w] : queries.place_from[w + 1]]
            n = int(queries.length[w])
            if n < queries.window:
                yield p, int(spots[0]), n
            elif p > done:
                step = 0
                while True:
                    after = [c for c in class_of.get(p + step + 1, ()) if queries.length[c] == n]
                    on = spots[queries.class_at[spots + step + 1] == after[0]] if after else spots[:0]
                    if not len(on):
                        break
                    spots, step = on, step + 1
                done = p + step
                yield p, int(spots[0]), n + step


def _matches(queries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = queries.value
        owner_at = dict(zip(block.places.tolist(), block.owners.tolist()))
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for rows, words, first in hashed(batch.column(1)):
                which, at = occurrences(words, first, block)
                order = np.lexsort((block.length[which], at))
                out = []
                for p, spot, n in longest(at[order], which[order], block):
                    row = int(np.searchsorted(first, p, side="right")) - 1
                    item = owner_at[spot]
                    text = block.text_from[np.searchsorted(block.text_from, spot, side="right") - 1]
                    out.append((ids[rows.start + row], p - int(first[row]), block.names[item] if item < len(block.names) else None, spot - int(text), n))
                columns = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=["doc_id", "doc_word", "item_id", "item_word", "n_words"])

    return run


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Where documents repeat the benchmark: doc_id, doc_word, item_id, item_word, n_words, words counted from 0.

    From the first hit word of a document on, the longest verbatim match that starts
    there, then the longest one from the next window that it doesn't cover, and so on.
    An item stands for all that hold the same words; items of several blocks, and
    pieces of items above PIECE_WORDS words, are matched block by block and piece by
    piece, with item_word counted in the piece."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in blocks(spark, benchmark, window, block_words):
        found = rows.mapInArrow(_matches(spark.sparkContext.broadcast(block)), "doc_id long, doc_word long, item_id long, item_word long, n_words long")
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], "doc_id long, doc_word long, item_id long, item_word long, n_words long")


ORACLE_SQL = r"""
WITH texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS row, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark
), split AS (
  SELECT kind, row, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), items AS (
  SELECT id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i:i+9])) AS words FROM split WHERE kind = 'b' AND len(w) > 0
), windows AS (SELECT words, len(words) AS n, list(DISTINCT id) AS ids FROM items GROUP BY words),
places AS (
  SELECT d.row, d.w, l.n, unnest(range(1, len(d.w) - l.n + 2)) AS i FROM split d CROSS JOIN (SELECT DISTINCT n FROM windows) l WHERE d.kind = 'd' AND len(d.w) >= l.n
), found AS (SELECT p.row, p.i, p.n, w.ids FROM places p JOIN windows w ON w.words = p.w[p.i:p.i+p.n-1]),
hits AS (SELECT row, count(DISTINCT spot) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS spot FROM found) GROUP BY row),
holders AS (SELECT row, list_sort(list_transform(list_distinct(flatten(list(ids))), lambda x: x::VARCHAR)) AS ids FROM found GROUP BY row)
SELECT d.id AS doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(len(o.ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(o.ids, ','), '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM split d LEFT JOIN hits h USING (row) LEFT JOIN holders o USING (row) WHERE d.kind = 'd'
"""
