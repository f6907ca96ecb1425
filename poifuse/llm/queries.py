"""The registered query of each operator over its whole table, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from poifuse.llm import common, cube, decontaminate, hard_negatives, licence_classifier, line_quality, manifest, packing, page_template, partenum, projection_forest, substring, token_files, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_page_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_template.extract(_read(spark, sf_dir, "pages"))


@_query
def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.report(_read(spark, sf_dir, "documents"))


SQL["op2_line_quality"] = line_quality.ORACLE_SQL


@_query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return substring.digest(docs, substring.repeated(docs))


@_query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"), _tokenizer())


@_query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.stage_path(spark, "tokens")
    token_files.write_token_files(_read(spark, sf_dir, "documents"), _tokenizer(), path)
    return token_files.token_digest(spark, path)


@_query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    return url_filter.judge(_read(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


SQL["op5_url_filter"] = url_filter.ORACLE_SQL


@_query
def op6_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_forest.near_vectors(_read(spark, sf_dir, "embeddings"))


@_query
def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_classifier.report(_read(spark, sf_dir, "documents"))


@_query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_groups(_read(spark, sf_dir, "documents"))


@_query
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@_query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(_read(spark, sf_dir, "documents"))


SQL["op11_merkle_manifest"] = manifest.ORACLE_SQL


@_query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(_read(spark, sf_dir, "embeddings"))


SQL["op12_hard_negatives"] = hard_negatives.ORACLE_SQL


@_query
def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


SQL["op13_decontaminate"] = decontaminate.ORACLE_SQL
