"""Readers. Every schema is explicit, so that open maps never become structs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from poifuse import schema


def parse_collections(raw: DataFrame) -> DataFrame:
    """Feature rows from parsed collection rows with columns path and features."""
    spread = raw.select("path", F.posexplode("features").alias("ord", "f"))
    columns = [F.col(f"f.properties.{name}").alias(name) for name in schema.FEATURE_PROPERTIES]
    return spread.select(
        F.col("path").alias("region"),
        F.col("ord").cast("bigint").alias("ord"),
        F.col("f.geometry.coordinates")[0].alias("lng"),
        F.col("f.geometry.coordinates")[1].alias("lat"),
        *columns,
    )


def _relative_path(path: Column, root: str) -> Column:
    return F.regexp_replace(F.url_decode(path), "^.*?" + re.escape(root.rstrip("/")) + "/", "")


def hidden_files(spark: SparkSession, root: str, suffix: str) -> list[str]:
    """Files whose name starts with an underscore; Spark's own listing passes them over."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    listing = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while listing.hasNext():
        file = listing.next().getPath()
        if file.getName().startswith("_") and file.getName().endswith(suffix):
            found.append(file.toString())
    return sorted(found)


def read_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Whole text of listed files: file, value. Each task opens its own share of the files."""
    listed = spark.createDataFrame([(p,) for p in paths], "file STRING")

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for file in batch["file"]:
                system, inner = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", file))
                with system.open_input_stream(inner) as stream:
                    yield pd.DataFrame({"file": [file], "value": [stream.read().decode("utf-8")]})

    spread = listed.repartition(max(1, min(len(paths), 10_000)), "file")
    return spread.mapInPandas(load, "file STRING, value STRING")


def _collection_rows(spark: SparkSession, root: str, ddl: str) -> DataFrame:
    """Parsed collection files below a folder, including those with hidden names: path, features."""
    files = spark.read.schema(ddl).option("multiLine", True).option("recursiveFileLookup", True)
    shown = files.option("pathGlobFilter", "*.geojson").json(root)
    rows = shown.select(_relative_path(F.col("_metadata.file_path"), root).alias("path"), "features")
    hidden = hidden_files(spark, root, ".geojson")
    if hidden:
        parsed = F.from_json("value", StructType.fromDDL(ddl))
        docs = read_documents(spark, hidden).select(_relative_path(F.col("file"), root).alias("path"), parsed["features"].alias("features"))
        rows = rows.unionByName(docs)
    return rows


def read_features(spark: SparkSession, root: str, regions: DataFrame | None = None) -> DataFrame:
    """All GeoJSON collections below a folder, one row per feature, ord = position in the file.

    The region is the slug whose path is the file's, or the path itself.
    """
    rows = parse_collections(_collection_rows(spark, root, schema.GEOJSON_DDL))
    if regions is None:
        return rows
    named = regions.select(F.col("path").alias("region"), "slug")
    return rows.join(named, "region", "left").withColumn("region", F.coalesce("slug", "region")).drop("slug")


def read_property_keys(spark: SparkSession, root: str) -> DataFrame:
    """Raw property text per feature, for the check of undeclared keys: region, ord, properties_json."""
    raw = _collection_rows(spark, root, "features ARRAY<STRUCT<properties: STRING>>")
    spread = raw.select("path", F.posexplode("features").alias("ord", "f"))
    return spread.select(F.col("path").alias("region"), F.col("ord").cast("bigint").alias("ord"), F.col("f.properties").alias("properties_json"))


def parse_region_entries(lines: list[str]) -> list[dict]:
    """Entries of a region list in YAML: one `- key: value` block per region, plain or quoted scalars, lists in brackets.

    Other YAML (anchors, nested blocks, multi-line text) is refused."""
    entries: list[dict] = []
    for number, line in enumerate(lines, 1):
        text = re.sub(r"(^|\s)#.*$", "", line).rstrip()
        if not text.strip() or text.strip() in ("---", "regions:"):
            continue
        m = re.match(r"""\s*(-\s+)?([A-Za-z_][\w-]*):\s+(\[[^\]]*\]|"[^"]*"|'[^']*'|[^\s&*{|>\[][^{]*)$""", text)
        if not m or not (m[1] or entries):
            raise ValueError(f"line {number} is no entry of a region list: {line.strip()}")
        if m[1]:
            entries.append({})
        value = m[3].strip()
        if value.startswith("["):
            entries[-1][m[2]] = [v.strip().strip("\"'") for v in value[1:-1].split(",") if v.strip()]
        elif value.lower() in ("true", "false"):
            entries[-1][m[2]] = value.lower() == "true"
        else:
            entries[-1][m[2]] = int(value) if re.fullmatch(r"-?\d+", value) else value.strip("\"'")
    return entries


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Region list from YAML, a JSON array, JSON lines, CSV or a Parquet table; list order in ord."""
    if path.endswith((".yml", ".yaml")):  # a configuration file, read as one row
        text = spark.read.text(path, wholetext=True).first()
        return regions_table(spark, parse_region_entries(text[0].splitlines() if text else []))
    if path.endswith(".csv"):
        return spark.read.schema(schema.REGION_DDL).option("header", True).csv(path)
    if path.endswith(".json") or path.endswith(".jsonl"):
        return spark.read.schema(schema.REGION_DDL).option("multiLine", path.endswith(".json")).json(path)
    return spark.read.schema(schema.REGION_DDL).parquet(path)


def regions_table(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Region list from parsed configuration entries with a bbox of [w, s, e, n]."""
    rows = []
    for i, entry in enumerate(entries):
        w, s, e, n = [float(v) for v in entry["bbox"]]
        rows.append(
            (i, entry["slug"], entry["path"], entry["prefix"], entry["iso3166_2"], entry.get("admin_level"), w, s, e, n,
             entry.get("role"), entry.get("bbox_clip"))
        )
    return spark.createDataFrame(rows, schema.REGION_DDL)


def read_elements(spark: SparkSession, path: str, single_document: bool = False) -> DataFrame:
    """Map element snapshot: JSON lines, or documents with an "elements" array."""
    if not single_document:
        return spark.read.schema(schema.ELEMENT_DDL).json(path)
    docs = spark.read.schema(f"elements ARRAY<{_record(schema.ELEMENT_DDL)}>").option("multiLine", True).json(path)
    return docs.select(F.explode("elements").alias("e")).select("e.*")


def _record(ddl: str) -> str:
    return StructType.fromDDL(ddl).simpleString()


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Seed records of a JSON array with their 1-based position, skipped records included."""
    return parse_seed(spark.read.text(path, wholetext=True))


def parse_seed(docs: DataFrame) -> DataFrame:
    """Seed records from a text column "value" holding one JSON array."""
    kept = [c for c in docs.columns if c != "value"]
    records = F.from_json("value", f"ARRAY<{_record(schema.SEED_DDL)}>")
    spread = docs.select(*kept, F.posexplode(records).alias("pos", "k"))
    return spread.select(*kept, (F.col("pos") + 1).cast("bigint").alias("ord"), "k.*")


def parse_result_cells(rows: DataFrame) -> DataFrame:
    """Search-result rows of text cells to typed columns; unreadable JSON and empty text become null."""
    def cell(name: str) -> Column:
        return F.when(F.col(name) != "", F.col(name))

    return rows.select(
        cell("input_id").alias("feature_id"),
        F.col("ord"),
        cell("title").alias("title"),
        cell("latitude").try_cast("double").alias("lat"),
        cell("longitude").try_cast("double").alias("lng"),
        F.from_json(cell("about"), schema.ABOUT_DDL).alias("about"),
        F.from_json(cell("open_hours"), schema.OPEN_HOURS_DDL).alias("open_hours"),
        cell("place_id").alias("place_id"),
        cell("cid").alias("cid"),
    )


def read_search_results(spark: SparkSession, path: str) -> DataFrame:
    """Place-search CSV with JSON cells; ragged rows are kept, ord is the row order within a file."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
    rows = reader.option("mode", "PERMISSIVE").csv(path)
    for name in ("input_id", "title", "latitude", "longitude", "about", "open_hours", "place_id", "cid"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    return parse_result_cells(rows.withColumn("ord", F.monotonically_increasing_id()))


REVIEW_DDL = (
    "region STRING, feature_id STRING, feature_name STRING, osm_ref STRING, osm_name STRING, "
    "score DOUBLE, distance_m DOUBLE, name_sim DOUBLE"
)


def parse_review_lines(lines: DataFrame) -> DataFrame:
    """Review rows from a text column "value" of quoted CSV lines."""
    return lines.select(F.from_csv("value", REVIEW_DDL, {"quote": '"', "escape": '"'}).alias("r")).select("r.*")


def read_review(spark: SparkSession, path: str) -> DataFrame:
    """Review CSV with quoted cells and doubled quotes."""
    return spark.read.schema(REVIEW_DDL).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_dedup_review(spark: SparkSession, path: str) -> DataFrame:
    ddl = (
        "region STRING, hops_id STRING, osm_id STRING, meters DOUBLE, sim DOUBLE, "
        "hops_name STRING, osm_name STRING, hops_addr STRING, osm_addr STRING"
    )
    return spark.read.schema(ddl).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def parse_vocabulary(raw: DataFrame) -> DataFrame:
    """Vocabulary rows from a text column "value" holding one JSON object: slug, de, group, ord."""
    entries = F.from_json("value", "MAP<STRING, STRING>")
    kept = [c for c in raw.columns if c != "value"]
    spread = raw.select(*kept, F.posexplode(entries).alias("ord", "slug", "body")).filter(~F.col("slug").startswith("$"))
    body = F.from_json("body", "STRUCT<de: STRING, `group`: STRING>")
    return spread.select(*kept, "slug", body["de"].alias("de"), body["group"].alias("group"), "ord")


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return parse_vocabulary(spark.read.text(path, wholetext=True))


def parse_place_lines(lines: DataFrame) -> DataFrame:
    """Place results from a text column "value", one JSON object per line; bad lines are skipped."""
    ddl = (
        "STRUCT<title: STRING, latitude: DOUBLE, longitude: DOUBLE, longtitude: DOUBLE, place_id: STRING, cid: STRING>"
    )
    parsed = lines.withColumn("r", F.from_json("value", ddl)).filter(F.col("r").isNotNull() & F.col("value").rlike(r"^\s*\{.*\}\s*$"))
    kept = [c for c in lines.columns if c != "value"]
    return parsed.select(
        *kept, "r.title", F.col("r.latitude").alias("lat"), F.coalesce("r.longitude", "r.longtitude").alias("lng"), "r.place_id", "r.cid"
    )


def read_place_lines(spark: SparkSession, path: str) -> DataFrame:
    """Place results as JSON lines or as one array per file; malformed records are skipped."""
    ddl = "title STRING, latitude DOUBLE, longitude DOUBLE, longtitude DOUBLE, place_id STRING, cid STRING"
    rows = spark.read.schema(ddl).option("mode", "DROPMALFORMED").json(path)
    return rows.select("title", F.col("latitude").alias("lat"), F.coalesce("longitude", "longtitude").alias("lng"), "place_id", "cid")
