"""The corpus pipeline: stages over documents, each written as Parquet and read again.

Every stage works on all rows that its predecessor kept. Cases: null and empty
texts fail the quality rules; rows with the same doc_id and text are one document from
the second stage on; different texts that share a doc_id, and rows with a null doc_id,
are documents of their own, judged like others (substring_dedup leaves rows with a null
doc_id as they are). Columns besides doc_id, text, source and n_chars are carried along.
An empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poifuse.llm import common, cube, line_quality, packing, partenum, substring

#: Neither stage can be said in SQL as a whole; tests hold the stages against brute force.
ORACLE_SQL = None


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars of texts as they are now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that break a base limit or lose too many words go."""
    return _recounted(line_quality.clean(docs))


def _row_key():
    return F.xxhash64("doc_id", "text")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate documents the one with the smallest doc_id stays, of a group without ids the one with the smallest key."""
    keyed = docs.select("doc_id", _row_key().alias("key"), "text")
    groups = partenum.jaccard_groups(keyed.select(F.col("key").alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "component_id")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"].alias("key")
    stay = keyed.select("doc_id", "key").distinct().join(groups.distinct(), "key").groupBy("component_id").agg(best).select("key")
    rows = docs.select(_row_key().alias("key"), F.struct(*[F.col(f"`{c}`") for c in ["text", *[c for c in docs.columns if c != "text"]]]).alias("row"))
    # the join has brought rows of one key together; of rows that differ in other columns only, the smallest stays
    one = rows.join(stay, "key", "left_semi").groupBy("key").agg(F.min("row").alias("row"))
    return one.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document with a smaller doc_id has are cut out of texts."""
    return _recounted(substring.remove_repeats(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice. Equal rows are taken equally often."""
    times = cube.mix(docs).groupBy(F.xxhash64("doc_id", "row").alias("key")).agg(F.round(F.avg("times")).cast("int").alias("times"))
    rows = docs.select(F.xxhash64("doc_id", F.xxhash64("text")).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    times = common.stage(times.where("times > 0"), "times")  # Spark sees how small it is: texts move only when it is too large to broadcast
    taken = rows.join(times, "key").select("row", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return taken.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents packed into sequences."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = common.stage(function(spark, docs, sf_dir), name)
    return docs
