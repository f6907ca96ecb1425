"""Token files: documents encoded, ended, packed into 64-bit words and written in doc_id order (operator 9).

A file is a Parquet file of block rows, so any store that Spark writes will do.
A block holds whole documents of about BLOCK_IDS ids: the documents' ids and
lengths, the words of `simple8b`, the word offset of each block of values, and
the ids that the file's partition held before. Partitions are ranges of doc_id in order.

Nulls and ties: a null text is empty (only the end id is written); null doc_ids
come first; rows that share a doc_id stand side by side, ordered by text. Other
columns of the input are not looked at. An empty table gives files without rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poifuse.llm import common, simple8b
from poifuse.llm.tokens import encoder

BLOCK_IDS = 1 << 16
END_ID = 1
_FILE = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("ids_before", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("words", pa.binary()), ("offsets", pa.binary()), ("escaped", pa.binary())])
_FILE_DDL = "part long, block long, ids_before long, n_ids long, doc_ids array<long>, lengths array<long>, words binary, offsets binary, escaped binary"
_DOCS = pa.schema([("doc_id", pa.int64()), ("part", pa.int64()), ("start_in_part", pa.int64()), ("ids", pa.binary())])


def _blocks(path: str, end_id: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, block, before = context.partitionId() if context else 0, 0, 0
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, held, size, block, before
            words, offsets, escaped = simple8b.encode(np.concatenate(held))
            row = pa.RecordBatch.from_pylist([{"part": part, "block": block, "ids_before": before, "n_ids": size, "doc_ids": docs, "lengths": [len(x) for x in held], "words": words.tobytes(), "offsets": offsets.tobytes(), "escaped": escaped.tobytes()}], schema=_FILE)
            before, block = before + size, block + 1
            docs, held, size = [], [], 0
            return row

        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            for rows, ids, first in encoder(path).column(batch.column(1)):
                for i in range(rows.start, rows.stop):
                    docs.append(ids_of[i])
                    held.append(np.append(ids[first[i - rows.start] : first[i - rows.start + 1]], np.uint32(end_id)))
                    size += len(held[-1])
                    if size >= block_ids:
                        yield flush()
        if docs:
            yield flush()

    return run


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Encode (doc_id, text), append end_id to each document, and write the blocks to path in doc_id order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranged = rows.repartitionByRange(common.parts(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    ranged.mapInArrow(common.tidy(_blocks(tokenizer, end_id, block_ids)), _FILE_DDL).write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = simple8b.decode(np.frombuffer(row["words"], dtype=np.uint64), np.frombuffer(row["offsets"], dtype=np.int64), np.frombuffer(row["escaped"], dtype=np.uint64), row["n_ids"]).astype("<u4")
            cuts = np.concatenate([[0], np.cumsum(row["lengths"])]).astype(np.int64)
            yield common.table({"doc_id": row["doc_ids"], "part": [row["part"]] * len(row["doc_ids"]), "start_in_part": cuts[:-1] + row["ids_before"], "ids": [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]}, _DOCS)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before), ids (little-endian unsigned 32-bit)."""
    blocks = spark.read.schema(_FILE_DDL).parquet(path)
    # one row per file part: as many as the writing job had tasks
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    docs = blocks.mapInArrow(common.tidy(_read), "doc_id long, part long, start_in_part long, ids binary")
    # that one row per task is small whatever the texts; without the hint the ids would be shuffled
    return docs.join(F.broadcast(before), "part").select("doc_id", (F.col("part_start") + F.col("start_in_part")).alias("start"), "ids")


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """One row per document read back: doc_id, start, n_tokens, ids_crc32."""
    read = read_token_files(spark, path)
    return read.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
