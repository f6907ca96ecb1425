"""Removal of repeated passages with an FM-index per shard (operator 3).

A window is `width` consecutive words of one document; a word goes if a window
that covers it also starts in a document with a smaller doc_id. Windows are dealt
to shards by content: the key of a window is the smallest hash of its runs of
GRAM words, and consecutive windows with one key form a segment. Equal windows
have equal keys, so each shard can be searched on its own:

1. one pass over the texts finds the keys that several documents have;
2. documents with such keys give the segments of these keys, equal segments once
   with the smallest doc_id that has them (others of larger doc_id go whole);
3. each shard indexes its segments; every segment is streamed through the index by
   backward search, which reports maximal matches of `width` words or more that
   occur with a smaller doc_id. A key with more words than an index takes is cut
   into several indexes, each of which reads all segments of the key;
4. spans are united per document and the words are removed.

Nulls and ties: a null text has no words; a text of fewer than `width` words is
kept. Rows with one doc_id are not compared with each other; equal rows of a
doc_id get equal results. A null doc_id has no order: the row stays whole and
removes nothing. Empty tables give empty results."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poifuse.llm import common
from poifuse.llm import wordbytes as wb
from poifuse.llm.fm_index import FmIndex, repeated_spans

WIDTH = 50
GRAM = 16
SHARD_WORDS = 200_000
_ROW = pa.schema([("key", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary())])
_ROW_DDL = "key long, kind int, blob binary"
_KEY = np.dtype([("mini", "<u8"), ("doc", "<i8"), ("sure", "?")])
_SEGMENT = np.dtype([("mini", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("fp", "<u8"), ("start", "<i4"), ("size", "<i4"), ("held", "?")])
_SPAN = np.dtype([("doc", "<i8"), ("fp", "<u8"), ("start", "<i4"), ("stop", "<i4")])


def _blobs(keys: np.ndarray, rows: np.ndarray, kind: int, parts: int) -> Iterator[pa.RecordBatch]:
    order = np.argsort(keys.astype(np.int32), kind="stable")
    rows, counts = rows[order], np.bincount(keys.astype(np.int64), minlength=parts)
    stops = np.cumsum(counts)
    at = np.flatnonzero(counts)
    if len(at):
        blobs = [rows[stops[k] - counts[k] : stops[k]].tobytes() for k in at.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(np.full(len(at), kind, dtype=np.int32)), common.binary_rows(blobs)], schema=_ROW)


def _bucket(ids: np.ndarray, parts: int) -> np.ndarray:
    return wb.mix(ids.view(np.uint64) if ids.dtype == np.int64 else ids) % np.uint64(parts)


def segments(chunk: wb.Words, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one key: row, first word, word count (both in the chunk), key."""
    n, spread = len(chunk.hash), width - gram + 1
    if n < width:
        return (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.uint64),)
    prefix = wb.prefix_hash(chunk.hash)
    at = np.arange(n - gram + 1)
    low, reach = wb.span_hash(prefix, at, at + gram), 1
    while 2 * reach <= spread:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < spread:
        low = np.minimum(low[: len(low) - (spread - reach)], low[spread - reach :])
    row = np.repeat(np.arange(len(chunk.first) - 1), np.diff(chunk.first))
    x = np.arange(len(low))
    valid = row[x] == row[x + width - 1]
    x, low, row = x[valid], low[valid], row[x[valid]]
    if not len(x):
        return (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.uint64),)
    new = np.append(True, (row[1:] != row[:-1]) | (low[1:] != low[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(x)) - 1
    return row[first], x[first], x[last] - x[first] + width, low[first]


def _keys(width: int, gram: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            names = batch.column(0).to_numpy()
            got = []
            for chunk in wb.words(batch.column(1)):
                row, _, _, mini = segments(chunk, width, gram)
                rows = np.zeros(len(row), dtype=_KEY)
                rows["mini"], rows["doc"] = mini, names[chunk.rows][row]
                got.append(rows)
            if not got:
                continue
            rows = np.unique(np.concatenate(got))
            if not len(rows):
                continue
            # a key of several documents of this batch is known to be shared: one row is enough for the others
            several = np.append(False, rows["mini"][1:] == rows["mini"][:-1])
            first = ~several
            rows["sure"][:-1] |= several[1:]
            yield from _blobs(_bucket(rows["mini"][first], parts), rows[first], 1, parts)
            rest = rows[several]
            yield from _blobs(_bucket(rest["doc"].copy(), parts), rest, 0, parts)

    return run


def _gather(batches: Iterator[pa.RecordBatch], kind: int, dtype: np.dtype, passed: list[pa.RecordBatch] | None = None) -> np.ndarray:
    got = []
    for batch in batches:
        for key, k, blob in zip(*[c.to_pylist() for c in batch.columns]):
            if k == kind:
                got.append(np.frombuffer(blob, dtype))
            elif passed is not None:
                passed.append((key, blob))
    return np.concatenate(got) if got else np.zeros(0, dtype=dtype)


def _shared(parts: int):
    """Keys that several documents have, now by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def seen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                forward = pa.compute.equal(batch.column("kind"), 0)
                out.append(batch.filter(forward))
                yield batch.filter(pa.compute.invert(forward))

        out: list[pa.RecordBatch] = []
        rows = _gather(seen(), 1, _KEY)
        yield from (b for b in out if b.num_rows)
        if not len(rows):
            return
        rows = rows[np.lexsort((rows["doc"], rows["mini"]))]
        at = np.flatnonzero(np.append(True, rows["mini"][1:] != rows["mini"][:-1]))
        stop = np.append(at[1:], len(rows))
        shared = (rows["doc"][at] != rows["doc"][stop - 1]) | np.logical_or.reduceat(rows["sure"], at)
        rows = rows[np.repeat(shared, stop - at)]
        yield from _blobs(_bucket(rows["doc"].copy(), parts), rows, 0, parts)

    return run


_FLAGS = pa.schema([("doc_id", pa.int64()), ("minis", pa.binary())])


def _by_doc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _gather(batches, 0, _KEY)
    if len(rows):
        rows = np.sort(rows[["doc", "mini"]].copy(), order=["doc", "mini"])
        at = np.flatnonzero(np.append(True, rows["doc"][1:] != rows["doc"][:-1]))
        for k in range(0, len(at), 5_000):
            some = at[k : k + 5_000]
            stop = np.append(at, len(rows))[k + 1 : k + 1 + len(some)]
            yield common.table({"doc_id": rows["doc"][some], "minis": [np.unique(rows["mini"][a:b]).tobytes() for a, b in zip(some.tolist(), stop.tolist())]}, _FLAGS)


def _five(words: np.ndarray) -> bytes:
    """5 bytes of each hash: the low four together, then the fifth."""
    return words.astype("<u4").tobytes() + (words >> np.uint64(32)).astype("u1").tobytes()


def _cut(width: int, gram: int, parts: int):
    """Segments of shared keys, by key; of equal ones in a batch only the smallest doc_id carries words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, flags = batch.column("doc_id").to_numpy(), batch.column("minis").to_pylist()
            heads, words = [], []
            for chunk in wb.words(batch.column("text")):
                row, first, size, mini = segments(chunk, width, gram)
                keep = np.zeros(len(row), dtype=bool)
                for r in np.unique(row).tolist():
                    own = slice(*np.searchsorted(row, [r, r + 1]).tolist())
                    wanted = np.frombuffer(flags[chunk.rows.start + r], "<u8")
                    at = np.minimum(np.searchsorted(wanted, mini[own]), len(wanted) - 1)
                    keep[own] = wanted[at] == mini[own]
                row, first, size, mini = row[keep], first[keep], size[keep], mini[keep]
                prefix = wb.prefix_hash(chunk.hash)
                head = np.zeros(len(row), dtype=_SEGMENT)
                head["mini"], head["doc"], head["size"] = mini, names[chunk.rows][row], size
                head["content"] = wb.span_hash(prefix, first, first + size)
                head["fp"] = wb.span_hash(prefix, chunk.first[:-1], chunk.first[1:])[row]
                head["start"] = first - chunk.first[row]
                heads.append(head)
                words += [chunk.hash[a : a + s] for a, s in zip(first.tolist(), size.tolist())]
            if not words:
                continue
            head = np.concatenate(heads)
            order = np.lexsort((head["doc"], head["content"]))
            least = order[np.append(True, head["content"][order][1:] != head["content"][order][:-1])]
            head["held"][least] = True
            keys = _bucket(head["mini"].copy(), parts).astype(np.int64)
            order = np.argsort(keys, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1):
                some = head[own]
                body = [words[k] for k in own[some["held"]].tolist()]
                blob = np.int64(len(some)).tobytes() + some.tobytes() + (_five(np.concatenate(body)) if body else b"")
                yield pa.RecordBatch.from_arrays([pa.array([keys[own[0]]]), pa.array([1], type=pa.int32()), pa.array([blob])], schema=_ROW)

    return run


def _segments_of(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, "<i8", 1)[0])
    head = np.frombuffer(blob, _SEGMENT, n, 8)
    at = 8 + n * _SEGMENT.itemsize
    m = (len(blob) - at) // 5
    low = np.frombuffer(blob[at : at + 4 * m], "<u4").astype(np.uint64)
    return head, low | np.frombuffer(blob, "u1", m, at + 4 * m).astype(np.uint64) << np.uint64(32)


def _search(width: int, parts: int, shard_words: int):
    """Index the segments of a partition shard by shard, stream them, and send the spans by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [_segments_of(x) for b in batches for x in b.column("blob").to_pylist()]
        if not got:
            return
        head = np.concatenate([h for h, _ in got])
        words = np.concatenate([w for _, w in got])
        got.clear()
        sizes = np.where(head["held"], head["size"], 0).astype(np.int64)
        at = np.cumsum(sizes) - sizes
        order = np.lexsort((~head["held"], head["doc"], head["content"], head["mini"]))
        head, at = head[order], at[order]
        new = np.append(True, (head["content"][1:] != head["content"][:-1]) | (head["mini"][1:] != head["mini"][:-1]))
        lead = np.flatnonzero(new)  # the smallest document of each content; it carries the words
        owner = np.repeat(head["doc"][lead], np.diff(np.append(lead, len(head))))
        later = head[head["doc"] > owner]
        yield from spans(later, later["start"], later["start"] + later["size"])
        rest = head[head["doc"] == owner]
        segment = (np.cumsum(new) - 1)[head["doc"] == owner]
        leads = head[lead]
        firsts, lengths = at[lead], leads["size"].astype(np.int64)
        group = np.flatnonzero(np.append(True, leads["mini"][1:] != leads["mini"][:-1]))
        stop = np.append(group[1:], len(leads))
        most = np.maximum.reduceat(leads["doc"], group)
        least = np.minimum.reduceat(leads["doc"], group)
        matches = []
        pending: list[np.ndarray] = []
        held = 0

        def read(indexed: np.ndarray, streamed: np.ndarray) -> None:
            def of(which: np.ndarray) -> np.ndarray:
                n = lengths[which]
                ends = np.cumsum(n)
                return words[np.repeat(firsts[which] - (ends - n), n) + np.arange(ends[-1])]

            names = np.unique(leads["doc"][np.concatenate([indexed, streamed])])
            index = FmIndex(of(indexed), lengths[indexed], np.searchsorted(names, leads["doc"][indexed]))
            which, a, b = repeated_spans(index, of(streamed), lengths[streamed], np.searchsorted(names, leads["doc"][streamed]), width)
            if len(which):
                matches.append(np.stack([streamed[which], a, b]))

        # of one key, the smallest document finds nothing smaller and the largest is never found
        asks = leads["doc"] > np.repeat(least, stop - group)
        gives = leads["doc"] < np.repeat(most, stop - group)
        for a, b in zip(group[most != least].tolist(), stop[most != least].tolist()):
            own = np.arange(a, b)
            total = int(lengths[own].sum())
            if total > shard_words:
                given = own[gives[own]]
                cuts = np.cumsum(lengths[given]) // shard_words
                for part in np.split(given, np.flatnonzero(np.diff(cuts)) + 1):
                    read(part, own[asks[own]])
                continue
            pending.append(own)
            held += total
            if held > shard_words:
                shard = np.concatenate(pending)
                read(shard[gives[shard]], shard[asks[shard]])
                pending, held = [], 0
        if pending:
            shard = np.concatenate(pending)
            read(shard[gives[shard]], shard[asks[shard]])
        if not matches:
            return
        which, a, b = np.concatenate(matches, axis=1)
        order = np.argsort(segment, kind="stable")  # rows of the leading document by segment
        low = np.searchsorted(segment[order], which, side="left")
        count = np.searchsorted(segment[order], which, side="right") - low
        rows = order[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        yield from spans(rest[rows], rest["start"][rows] + np.repeat(a, count), rest["start"][rows] + np.repeat(b, count))

    def spans(head: np.ndarray, start: np.ndarray, stop: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = np.zeros(len(head), dtype=_SPAN)
        rows["doc"], rows["fp"], rows["start"], rows["stop"] = head["doc"], head["fp"], start, stop
        yield from _blobs(_bucket(rows["doc"].copy(), parts), rows, 0, parts)

    return run


_SPANS = pa.schema([("doc_id", pa.int64()), ("spans", pa.binary())])


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _gather(batches, 0, _SPAN)
    if not len(rows):
        return
    rows = np.sort(rows, order=["doc", "fp", "start", "stop"])
    same = np.append(False, (rows["doc"][1:] == rows["doc"][:-1]) & (rows["fp"][1:] == rows["fp"][:-1]))
    # running end inside a row: number the rows and add a stride larger than any end
    row = np.cumsum(~same) - 1
    stride = int(rows["stop"].max()) + 1
    reach = np.maximum.accumulate(rows["stop"] + row * stride) - row * stride
    new = ~same | np.append(True, rows["start"][1:] > reach[:-1])
    first = np.flatnonzero(new)
    out = rows[first].copy()
    out["stop"] = reach[np.append(first[1:], len(rows)) - 1]
    at = np.flatnonzero(np.append(True, out["doc"][1:] != out["doc"][:-1]))
    stop = np.append(at[1:], len(out))
    for k in range(0, len(at), 5_000):
        yield common.table({"doc_id": out["doc"][at[k : k + 5_000]], "spans": [out[a:b].tobytes() for a, b in zip(at[k : k + 5_000].tolist(), stop[k : k + 5_000].tolist())]}, _SPANS)


def repeated(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Spans of words to remove, written once: doc_id and, as one value, (doc, text hash, from word, to word) rows."""
    parts = common.parts(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keys = rows.mapInArrow(common.tidy(_keys(width, gram, parts)), _ROW_DDL).repartition(parts, "key")
    shared = keys.mapInArrow(common.tidy(_shared(parts)), _ROW_DDL).repartition(parts, "key")
    flags = common.stage(shared.mapInArrow(common.tidy(_by_doc), "doc_id long, minis binary"), "flags")
    bits = common.id_filter(flags.select("doc_id"))
    some = rows.select("doc_id", "text", common.filter_bit("doc_id")).where("doc_id is not null").mapInArrow(common.tidy(_passing(bits)), "doc_id long, text string")
    cut = some.join(flags, "doc_id").select("doc_id", "text", "minis").mapInArrow(common.tidy(_cut(width, gram, parts)), _ROW_DDL).repartition(parts, "key")
    found = cut.mapInArrow(common.tidy(_search(width, parts, shard_words)), _ROW_DDL).repartition(parts, "key")
    return common.stage(found.mapInArrow(common.tidy(_unite), "doc_id long, spans binary"), "spans")


def _marked(batch: pa.RecordBatch, bits) -> tuple[np.ndarray, list[str]]:
    known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    return common.passes(bits.value, batch.column("bit").fill_null(0).to_numpy()) & known, [n for n in batch.schema.names if n != "bit"]


def _passing(bits):
    """Rows whose id may be in the filter, without the filter's column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, names = _marked(batch, bits)
            yield batch.filter(pa.array(ok)).select(names)

    return run


def _others(bits, work):
    """The work done on rows whose id surely isn't in the filter; they have no spans. One Python process does both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rest() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ok, names = _marked(batch, bits)
                kept = batch.filter(pa.array(~ok)).select(names)
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.nulls(len(kept), pa.binary())], names=[*names, "spans"])

        yield from work(rest())

    return run


def _kept(column: pa.Array, names: np.ndarray, spans: list[bytes | None]) -> Iterator[tuple[int, int, bytes]]:
    """Per row: words, removed words, and the kept words joined by one space."""
    for chunk in wb.words(column):
        n = len(chunk.hash)
        keep = np.ones(n, dtype=bool)
        fp = None
        for i in range(chunk.rows.start, chunk.rows.stop):
            if spans[i] is not None:
                if fp is None:
                    fp = wb.span_hash(wb.prefix_hash(chunk.hash), chunk.first[:-1], chunk.first[1:])
                own = np.frombuffer(spans[i], _SPAN)
                base = chunk.first[i - chunk.rows.start]
                for a, b in own[own["fp"] == fp[i - chunk.rows.start]][["start", "stop"]].tolist():
                    keep[base + a : base + b] = False
        total = np.concatenate([[0], np.cumsum(keep)])
        first, last = total[chunk.first[:-1]], total[chunk.first[1:]]
        at = np.flatnonzero(keep)
        # a kept word takes the byte after it as a space, but for the last of its row
        space = np.ones(len(at), dtype=np.int64)
        space[last[last > first] - 1] = 0
        size = chunk.end[at] - chunk.start[at] + space
        ends = np.cumsum(size)
        data = np.append(chunk.data, np.uint8(32))
        data[chunk.end] = 32  # never inside a word: the next byte is white space or another row's
        clash = chunk.end[chunk.end < len(chunk.data)]
        data[clash] = np.where(np.isin(clash, chunk.start), chunk.data[clash], 32)
        out = data[np.repeat(chunk.start[at] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        bound = np.concatenate([[0], ends]).astype(np.int64)
        for i in range(len(first)):
            words = int(chunk.first[i + 1] - chunk.first[i])
            yield words, words - int(last[i] - first[i]), out[bound[first[i]] : bound[last[i]]]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    for batch in batches:
        rows = list(_kept(batch.column("text"), None, batch.column("spans").to_pylist()))
        yield common.table({"doc_id": batch.column("doc_id"), "n_words": [r[0] for r in rows], "n_removed": [r[1] for r in rows], "kept_sha256": [hashlib.sha256(r[2]).hexdigest() for r in rows]}, schema)


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Same columns; texts that lose words become their kept words joined by one space."""
    for batch in batches:
        column, spans = batch.column("text"), batch.column("spans").to_pylist()
        old = column.to_pylist()
        texts = [kept.decode("utf-8") if removed else t for (_, removed, kept), t in zip(_kept(column, None, spans), old)]
        names = [n for n in batch.schema.names if n != "spans"]
        yield pa.RecordBatch.from_arrays([pa.array(texts, type=pa.string()) if n == "text" else batch.column(n) for n in names], names=names)


def _with_spans(docs: DataFrame, spans: DataFrame, work, ddl: str) -> DataFrame:
    """Run over all rows: those that may have spans are joined with them, the others need no shuffle."""
    bits = common.id_filter(spans.select("doc_id"))
    marked = docs.withColumn("bit", common.filter_bit("doc_id"))
    hit = marked.mapInArrow(common.tidy(_passing(bits)), docs.schema).join(spans, "doc_id", "left").select(*docs.columns, "spans")
    return hit.mapInArrow(common.tidy(work), ddl).union(marked.mapInArrow(common.tidy(_others(bits, work)), ddl))


def digest(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _with_spans(rows, spans, _digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of docs (any columns besides doc_id and text), with repeated passages cut out of their texts."""
    columns = docs.columns
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[docs[c].alias(f"_{k}") for k, c in enumerate(columns) if c not in ("doc_id", "text")])
    done = _with_spans(plain, repeated(docs, width), _rewrite, plain.schema)
    return done.select(*[F.col(c if c in ("doc_id", "text") else f"_{k}").cast(docs.schema[c].dataType).alias(c) for k, c in enumerate(columns)])
