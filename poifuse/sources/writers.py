"""Writers: region-partitioned features in stable order, and the review tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poifuse import schema
from poifuse.functions import provenance as prov
from poifuse.operators.skew import numbered


def stable_order(features: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Add position: rows with other sources first, then map-only rows, each by id in language order."""
    keyed = _keyed(features)
    return numbered(keyed, keys or ["region"], ["map_only", "id_key", "id"], "position").drop("map_only", "id_key")


def _keyed(features: DataFrame) -> DataFrame:
    return features.withColumn("map_only", prov.is_osm_only(F.col("sources"))).withColumn("id_key", F.collate("id", "UNICODE"))


def _ordered(features: DataFrame) -> DataFrame:
    """Spread by range of (region, order), so a large region fills many files instead of one task."""
    order = ["region", "map_only", "id_key"]
    return _keyed(features).repartitionByRange(*order).sortWithinPartitions(*order).drop("map_only", "id_key")


def write_features(features: DataFrame, path: str) -> None:
    """New snapshot version as Parquet, one folder per region, rows in stable order.

    Never write to the path being read.
    """
    _ordered(features).write.mode("errorifexists").partitionBy("region").parquet(path)


def feature_json() -> Column:
    """One GeoJSON feature as text; absent properties are left out."""
    properties = F.struct(*schema.FEATURE_PROPERTIES)
    geometry = F.struct(F.lit("Point").alias("type"), F.array("lng", "lat").alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties")))


def write_feature_lines(features: DataFrame, path: str) -> None:
    """Features as JSON lines per region in stable order (newline-delimited GeoJSON)."""
    _ordered(features).select("region", feature_json().alias("value")).write.mode("errorifexists").partitionBy("region").text(path)


def collection_lines(features: DataFrame) -> DataFrame:
    """The lines of one FeatureCollection per region: region, position, value.

    Line 0 opens the document, each feature is a line in stable order, the last line
    closes it. A region of any size is one document, and no task ever holds one."""
    placed = stable_order(features).select("region", F.col("position").cast("bigint").alias("position"), feature_json().alias("text"))
    sizes = features.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    body = placed.join(sizes, "region").select("region", "position", F.when(F.col("position") < F.col("n"), F.concat("text", F.lit(","))).otherwise(F.col("text")).alias("value"))
    ends = F.array(F.struct(F.lit(0).cast("bigint").alias("position"), F.lit('{"type":"FeatureCollection","features":[').alias("value")), F.struct((F.col("n") + 1).alias("position"), F.lit("]}").alias("value")))
    return body.unionByName(sizes.select("region", F.inline(ends)))


def write_collections(features: DataFrame, path: str) -> None:
    """One folder per region, whose part files in order of their names are one FeatureCollection document."""
    order = ["region", "position"]
    lines = collection_lines(features).repartitionByRange(*order).sortWithinPartitions(*order)
    lines.select("region", "value").write.mode("errorifexists").partitionBy("region").text(path)


def collections(features: DataFrame, per_document: int = 50_000) -> DataFrame:
    """FeatureCollection documents of at most per_document features in stable order, as values: region, part, value.

    For consumers that take documents as rows; write_collections writes a region of
    any size as one document."""
    placed = stable_order(features).withColumn("part", F.floor((F.col("position") - 1) / per_document))
    entry = F.struct("position", feature_json().alias("text"))
    grouped = placed.groupBy("region", "part").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    body = F.array_join(F.transform("entries", lambda e: e["text"]), ",")
    return grouped.select("region", "part", F.concat(F.lit('{"type":"FeatureCollection","features":['), body, F.lit("]}")).alias("value"))


def fixed(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", value)


def match_review_cells(review: DataFrame) -> DataFrame:
    return review.select(
        "region",
        "feature_id",
        "feature_name",
        "osm_ref",
        "osm_name",
        fixed(F.col("score"), 2).alias("score"),
        fixed(F.col("distance_m"), 1).alias("distance_m"),
        fixed(F.col("name_sim"), 2).alias("name_sim"),
    )


def write_match_review(review: DataFrame, path: str) -> None:
    """Every cell quoted, quotes doubled."""
    writer = match_review_cells(review).orderBy("region", "feature_id").write.mode("errorifexists")
    writer.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))


def dedup_review_lines(review: DataFrame) -> DataFrame:
    """Review rows as CSV text: only names and addresses are quoted."""
    cells = [
        F.col("region"), F.col("hops_id"), F.col("osm_id"), fixed(F.col("meters"), 1), fixed(F.col("sim"), 2),
        quoted(F.col("hops_name")), quoted(F.col("osm_name")), quoted(F.col("hops_addr")), quoted(F.col("osm_addr")),
    ]
    return review.select("region", "hops_id", F.concat_ws(",", *cells).alias("value"))


def write_dedup_review(review: DataFrame, path: str) -> None:
    """CSV lines in order of region and id; the header is the first line of the first file."""
    header = "region,hops_id,osm_id,meters,sim,hops_name,osm_name,hops_addr,osm_addr"
    first = review.sparkSession.createDataFrame([("", "", header)], "region STRING, hops_id STRING, value STRING")
    lines = first.unionByName(dedup_review_lines(review)).orderBy("region", "hops_id")
    lines.select("value").write.mode("errorifexists").text(path)


def remaining_review(review: DataFrame, outcome: DataFrame) -> DataFrame:
    """Review rows that were not confirmed."""
    done = outcome.filter(F.col("outcome") == "confirmed").select("region", "feature_id", "osm_ref").distinct()
    return review.join(done, ["region", "feature_id", "osm_ref"], "left_anti")


def rewrite_review(review: DataFrame, outcome: DataFrame, path: str) -> bool:
    """Write the remaining rows to a new path; nothing is written when none is left."""
    rest = remaining_review(review, outcome)
    if rest.isEmpty():
        return False
    write_match_review(rest, path)
    return True
