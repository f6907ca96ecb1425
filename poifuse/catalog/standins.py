"""Stand-in tables derived from the driver tables.

The driver tables hold no points of interest. Each stand-in is a list of
select expressions in SQL that Spark and DuckDB read alike, so that both sides
of a comparison start from the same rows; Spark then nests them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poifuse import schema
from poifuse.functions import provenance as prov
from poifuse.operators.skew import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part, dealt over tasks: few bytes a row in the file, but wide rows in what is made of them."""
    return dealt(table(spark, sf_dir, "part"), "p_partkey")


def choose(selector: str, values: list[str | None]) -> str:
    """CASE over a small number; None leaves the value null."""
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {selector} {arms} END"


HALF = "(p_partkey - p_partkey % 2) / 2"
LAT = f"CAST(50.0 + ({HALF} % 41) * 0.0003 + FLOOR({HALF} / 1517) * 0.02 + (p_partkey % 2) * ({HALF} % 7) * 0.00003 AS DOUBLE)"
LNG = f"CAST(8.0 + ({HALF} % 37) * 0.0004 + (p_partkey % 2) * ({HALF} % 5) * 0.00004 AS DOUBLE)"

# Points: even keys are existing features, odd keys fresh ones a few metres away.
POI = ["p_partkey AS id", "p_partkey % 2 AS side", "p_partkey AS ord", "p_name AS name", f"{LAT} AS lat", f"{LNG} AS lng"]

NAMES = [
    "Kiosk", "Trinkhalle", "Späti", "Bar Li", "Alimentación", "Getränkemarkt", "ONCE", "Prensa y Revistas",
    "Café", "Fristo", "王记", "Your Song", "Supermercado DIA", "Jin Tonic", "Bazar Chino", "Getränke  Quelle",
    "Wu Tang Club", "Öztürk Büdchen", "Hot-Shop", "Bodega Ñandú", "Open 24", "Restaurante Wang", "Straßenladen", "24h Market",
]
NAME = f"{choose('p_partkey % 24', NAMES)} || ' ' || p_name"
HOURS = [
    "Mo-Fr 08:00-20:00", "24/7", "00:00-00:00", "Mo-Su 0:00 - 0:00; PH 00:00-00:00", " Mo-Sa 09:00-22:00 ", "",
    "Mo 00:00-00:00; Tu 10:00-12:00", None, "PH off",
]

ELEMENT = [
    "p_partkey AS k",
    choose("p_partkey % 3", ["node", "way", "relation"]) + " AS type",
    "CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_partkey % 7 AS INT) END AS version",
    f"CASE WHEN p_partkey % 11 <> 0 THEN {LAT} END AS lat",
    f"CASE WHEN p_partkey % 11 <> 0 THEN {LNG} END AS lng",
    f"CASE WHEN p_partkey % 22 = 0 THEN {LAT} END AS c_lat",
    f"CASE WHEN p_partkey % 22 = 0 THEN {LNG} END AS c_lng",
    choose("p_partkey % 3", ["ES-MD", "DE-HE", "ES-CT"]) + " AS iso",
    choose("p_partkey % 3", ["em", "fr", "ec"]) + " AS prefix",
    f"CASE WHEN p_partkey % 19 = 0 THEN NULL WHEN p_partkey % 48 = 6 THEN 'Once' ELSE {NAME} END AS name",
    choose("p_partkey % 6", ["kiosk", "beverages", "convenience", None, "alcohol", "kiosk"]) + " AS shop",
    "CASE WHEN p_partkey % 6 = 3 OR p_partkey % 35 = 0 THEN " + choose("p_partkey % 5", ["bar", "cafe", "pub", "vending_machine", "fast_food"]) + " END AS amenity",
    choose("p_partkey % 13", ["Trinkgut", "Prensa Ibérica"]) + " AS brand",
    "CASE WHEN p_partkey % 17 = 0 THEN 'Q1' END AS brand_wikidata",
    choose("p_partkey % 23", ["Getränke Hoffmann GmbH", "Frutería Pepe", "Organización ONCE", "once", "Tienda Galp"]) + " AS operator",
    choose("p_partkey % 29", ["yes", "no"]) + " AS lottery",
    choose("p_partkey % 31", ["only"]) + " AS self_service",
    choose("p_partkey % 37", ["yes", "no"]) + " AS automated",
    choose("p_partkey % 5", ["yes", "no", "only", "limited", None]) + " AS pay_cash",
    choose("FLOOR(p_partkey / 5) % 5", ["yes", "no", None, "maybe", None]) + " AS pay_credit",
    choose("FLOOR(p_partkey / 25) % 4", ["yes", "no", "no", None]) + " AS pay_debit",
    choose("p_partkey % 7", ["yes", "no", None, None, "only", "no", None]) + " AS pay_contactless",
    choose("p_partkey % 8", ["yes", "no"]) + " AS pay_girocard",
    choose("p_partkey % 10", ["yes", "no", "some"]) + " AS pay_ec",
    choose("p_partkey % 27", ["yes", "no"]) + " AS pay_apple",
    choose("p_partkey % 33", ["no", "yes"]) + " AS pay_google",
    "CASE WHEN p_partkey % 4 <> 0 THEN 'Straße ' || CAST(p_partkey % 90 AS STRING) END AS street",
    "CASE WHEN p_partkey % 4 <> 1 THEN CAST(p_partkey % 60 AS STRING) END AS housenumber",
    choose("p_partkey % 4", ["60311", "1234", "ABCDE", "28001"]) + " AS postcode",
    choose("p_partkey % 3", ["Frankfurt", None, "Madrid"]) + " AS city",
    choose("p_partkey % 5", ["Nordend", None, None, "Ostend", None]) + " AS suburb",
    choose("p_partkey % 5", ["Kiez", "Barri", None, None, "Viertel"]) + " AS neighbourhood",
    choose("p_partkey % 9", HOURS) + " AS opening_hours",
    choose("p_partkey % 6", ["yes", "no"]) + " AS toilets",
    choose("p_partkey % 7", ["yes", "limited"]) + " AS wheelchair",
    choose("p_partkey % 8", ["yes", "no"]) + " AS outdoor_seating",
    choose("p_partkey % 9", ["yes"]) + " AS indoor_seating",
    choose("p_partkey % 11", ["yes", "no"]) + " AS seating",
    choose("p_partkey % 12", ["yes", "outside", "no"]) + " AS smoking",
    choose("p_partkey % 13", ["yes"]) + " AS covered",
    choose("p_partkey % 14", ["drinks", "beverages", "candy"]) + " AS vending",
]
TAG_COLUMNS = {
    "name": "name", "shop": "shop", "amenity": "amenity", "brand": "brand", "brand:wikidata": "brand_wikidata",
    "operator": "operator", "lottery": "lottery", "self_service": "self_service", "automated": "automated",
    "payment:cash": "pay_cash", "payment:credit_cards": "pay_credit", "payment:debit_cards": "pay_debit",
    "payment:contactless": "pay_contactless", "payment:girocard": "pay_girocard", "payment:ec_cards": "pay_ec",
    "payment:apple_pay": "pay_apple", "payment:google_pay": "pay_google", "addr:street": "street",
    "addr:housenumber": "housenumber", "addr:postcode": "postcode", "addr:city": "city", "addr:suburb": "suburb",
    "addr:neighbourhood": "neighbourhood", "opening_hours": "opening_hours", "toilets": "toilets",
    "wheelchair": "wheelchair", "outdoor_seating": "outdoor_seating", "indoor_seating": "indoor_seating",
    "seating": "seating", "smoking": "smoking", "covered": "covered", "vending": "vending",
}

# Existing features, one per part, with values, stamps and sources that vary by key.
SLUGS = ["fr", "em", "ec", "bk"]
FEATURE = [
    "p_partkey AS k",
    "p_partkey AS ord",
    choose("p_partkey % 4", SLUGS) + " AS region",
    f"'tk_' || {choose('p_partkey % 4', SLUGS)} || '_' || CAST(1000000 + p_partkey AS STRING) AS id",
    f"{LAT} AS lat",
    f"{LNG} AS lng",
    f"CASE WHEN p_partkey % 21 = 0 THEN {NAME} ELSE p_name END AS name",
    "CASE WHEN p_partkey % 3 = 0 THEN 'about ' || p_type END AS description",
    "CASE WHEN p_partkey % 5 <> 0 THEN 'Straße ' || CAST(p_partkey % 80 AS STRING) END AS street",
    "CASE WHEN p_partkey % 6 = 0 THEN '' WHEN p_partkey % 6 < 4 THEN CAST(p_partkey % 60 AS STRING) END AS number",
    choose("p_partkey % 7", ["60311", None, "60313", None, "1234"]) + " AS postalcode",
    choose("p_partkey % 4", ["Frankfurt", None, "Madrid"]) + " AS city",
    choose("p_partkey % 9", ["Altstadt"]) + " AS district",
    "CASE p_partkey % 8 WHEN 0 THEN 'Mo-Fr 08:00-20:00' WHEN 1 THEN 'Mo-Su 10:00-22:00' WHEN 2 THEN '00:00-00:00' WHEN 3 THEN '24/7' END AS hours",
    "CASE WHEN p_partkey % 4 = 1 THEN 'bier' END AS tag_a",
    "CASE WHEN p_partkey % 6 = 1 THEN 'wc' END AS tag_b",
    "p_partkey % 10 <> 9 AS has_payment",
    "CASE WHEN p_partkey % 10 <> 9 THEN " + choose("p_partkey % 6", ["yes", "no", "unknown", None, "yes", None]) + " END AS cash",
    "CASE WHEN p_partkey % 10 <> 9 THEN " + choose("p_partkey % 7", ["yes", "no", "unknown", None, None, None]) + " END AS cards",
    "CASE WHEN p_partkey % 10 <> 9 THEN " + choose("p_partkey % 8", ["no", None, "yes", "unknown", None]) + " END AS contactless",
    "CASE WHEN p_partkey % 10 <> 9 THEN " + choose("p_partkey % 9", ["yes", "no", None]) + " END AS girocard",
    choose("p_partkey % 5", ["osm", "hopfenstop", "apple", "google", None]) + " AS st_name",
    choose("p_partkey % 6", ["osm", "google", "user", None, "apple", "nobody"]) + " AS st_hours",
    choose("p_partkey % 7", ["user", "photon", None, "hopfenstop", "google"]) + " AS st_street",
    choose("p_partkey % 9", ["apple", "osm", None, "google", "hopfenstop"]) + " AS st_cash",
    choose("p_partkey % 4", ["google", "osm", "apple", None]) + " AS st_cards",
    "p_partkey % 3 <> 1 AS s_osm",
    "p_partkey % 3 = 1 OR p_partkey % 7 = 0 AS s_seed",
    "p_partkey % 5 = 0 AS s_apple",
    choose("p_partkey % 8", ["payment", "ChIJ1", None, "gmaps", "ChIJ2"]) + " AS gmaps_id",
    "p_partkey % 16 = 5 AS osm_removed",
    choose("p_partkey % 11", ["bar", "convenience", "vending_machine"]) + " AS kind",
    choose("p_partkey % 3", ["2023-12-01", "2024-01-15", None]) + " AS created",
    choose("p_partkey % 4", ["2024-01-20", "2024-02-01", None, "not a date"]) + " AS updated",
    choose("p_partkey % 5", ["2024-01-10", "2024-02-05", None, "bad", "2024-01-16"]) + " AS apple_id_attempted",
    choose("p_partkey % 6", ["2024-01-10", "2024-02-05", None]) + " AS apple_attempted",
    choose("p_partkey % 7", ["2024-01-10", "2024-02-05", None]) + " AS google_attempted",
]
STAMP_COLUMNS = {"name": "st_name", "hours": "st_hours", "address.street": "st_street", "payment.cash": "st_cash", "payment.cards": "st_cards"}
AS_OF = "2024-02-15"


def cte(name: str, columns: list[str], source: str = "part", where: str = "") -> str:
    return f"{name} AS (SELECT {', '.join(columns)} FROM {source} {where})"


def poi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts(spark, sf_dir).selectExpr(*POI)


def flat_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts(spark, sf_dir).selectExpr(*ELEMENT)


def _string_map(pairs: dict[str, Column]) -> Column:
    parts = [p for key, value in pairs.items() for p in (F.lit(key), value)]
    return F.map_filter(F.create_map(*parts), lambda _, v: v.isNotNull())


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw element rows with their tag map; iso and prefix of the asking region alongside."""
    flat = flat_elements(spark, sf_dir)
    return flat.select(
        "k",
        "type",
        F.col("k").alias("id"),
        F.col("k").alias("ord"),
        "version",
        "lat",
        F.col("lng").alias("lon"),
        F.when(F.col("c_lat").isNotNull(), F.struct(F.col("c_lat").alias("lat"), F.col("c_lng").alias("lon"))).alias("center"),
        _string_map({key: F.col(column) for key, column in TAG_COLUMNS.items()}).alias("tags"),
        "iso",
        "prefix",
        F.col("prefix").alias("region"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows in the nested model (plus k, the part key)."""
    f = parts(spark, sf_dir).selectExpr(*FEATURE)
    c = F.col
    number = F.when(c("k") % 3 == 0, "node/").otherwise("way/")
    sources = F.array_compact(
        F.array(
            F.when(c("s_seed"), prov.source_entry("hopfenstop", F.concat(F.lit("h"), c("k").cast("string")))),
            F.when(c("s_osm"), prov.source_entry("osm", F.concat(number, c("k").cast("string")), F.lit(1))),
            F.when(c("s_apple"), prov.source_entry("apple", F.concat(F.lit("a"), c("k").cast("string")))),
            F.when(c("gmaps_id").isNotNull(), prov.source_entry("gmaps", c("gmaps_id"))),
        )
    )
    tags = F.array_compact(F.array("tag_a", "tag_b"))
    stamps = _string_map({path: c(column) for path, column in STAMP_COLUMNS.items()})
    return f.select(
        "k", "region", "ord", "lng", "lat", "id", "name", "description",
        F.struct(*schema.ADDRESS_KEYS).alias("address"),
        F.when(c("hours").isNotNull(), F.struct(c("hours").alias("raw"))).alias("hours"),
        F.when(F.size(tags) > 0, tags).alias("tags"),
        F.when(c("has_payment"), F.struct(*schema.PAYMENT_KEYS)).alias("payment"),
        sources.alias("sources"),
        F.when(c("osm_removed"), F.lit(True)).alias("osm_removed"),
        "kind", "created", "updated", "apple_id_attempted", "apple_attempted", "google_attempted",
        F.when(F.size(stamps) > 0, stamps).alias("sources_by_field"),
    )


# Nested blocks as text, so that results of both engines compare by value.


def sources_text(sources: Column) -> Column:
    entry = lambda s: F.concat_ws(":", s["type"], s["id"], s["version"].cast("string"))
    return F.array_join(F.transform(sources, entry), ",")


def stamps_text(stamps: Column) -> Column:
    entries = F.transform(F.map_entries(stamps), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.coalesce(F.array_join(F.array_sort(entries), ","), F.lit(""))


def address_columns() -> list[Column]:
    return [F.col(f"address.{key}").alias(key) for key in schema.ADDRESS_KEYS]


def payment_columns(block: str = "payment") -> list[Column]:
    return [F.col(f"{block}.{key}").alias(key) for key in schema.PAYMENT_KEYS]


def flat(df: DataFrame, *columns: str) -> DataFrame:
    """Chosen parts of feature rows as plain columns."""
    parts = {
        "address": address_columns(),
        "payment": payment_columns(),
        "hours": [F.col("hours.raw").alias("hours")],
        "tags": [F.array_join("tags", ",").alias("tags")],
        "sources": [sources_text(F.col("sources")).alias("sources")],
        "stamps": [stamps_text(F.col("sources_by_field")).alias("stamps")],
    }
    return df.select(*[c for name in columns for c in parts.get(name, [F.col(name)])])


# SQL text for the same values.

FEATURE_SOURCES_SQL = (
    "CASE WHEN s_seed THEN ['hopfenstop:h' || k] ELSE [] END"
    " || CASE WHEN s_osm THEN ['osm:' || CASE WHEN k % 3 = 0 THEN 'node/' ELSE 'way/' END || k || ':1'] ELSE [] END"
    " || CASE WHEN s_apple THEN ['apple:a' || k] ELSE [] END"
    " || CASE WHEN gmaps_id IS NOT NULL THEN ['gmaps:' || gmaps_id] ELSE [] END"
)


def joined_sql(values: dict[str, str]) -> str:
    """Sorted "path=value" text of the non-null values."""
    items = ", ".join(f"'{path}=' || ({value})" for path, value in values.items())
    return f"array_to_string(list_sort(list_filter([{items}], lambda x: x IS NOT NULL)), ',')"


def tags_sql(*values: str) -> str:
    """Sorted distinct tag text; null when there is none."""
    items = ", ".join(values)
    return f"NULLIF(array_to_string(list_sort(list_distinct(list_filter([{items}], lambda x: x IS NOT NULL))), ','), '')"


def rank_sql(source: str) -> str:
    ranks = " ".join(f"WHEN '{name}' THEN {rank}" for name, rank in schema.SOURCE_RANK.items())
    return f"CASE WHEN {source} IS NULL OR {source} = '' THEN {schema.DEFAULT_RANK} ELSE CASE {source} {ranks} ELSE 0 END END"


def spell_sql(x: str) -> str:
    return f"replace(replace(replace(replace(lower({x}), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss')"


def norm_a_sql(x: str) -> str:
    words = "kiosk|trinkhalle|wasserhaeuschen|spaeti|spaetkauf|laden|shop|store"
    text = f"regexp_replace({spell_sql(x)}, '[^\\p{{L}}\\p{{N}}\\s]', ' ', 'g')"
    return f"trim(regexp_replace(regexp_replace({text}, '\\b({words})\\b', ' ', 'g'), '\\s+', ' ', 'g'))"


def fold_sql(x: str) -> str:
    return f"trim(regexp_replace(replace(strip_accents(lower({x})), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g'))"


def chain_sql(x: str) -> str:
    return f"trim(regexp_replace({spell_sql(x)}, '[^a-z0-9]+', ' ', 'g'))"


def spanish_sql(x: str) -> str:
    return f"lower(strip_accents({x}))"


def slug_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({spell_sql(x)}, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"


def grams_sql(x: str) -> str:
    return f"list_transform(range(1, length({x})), lambda i: substr({x}, i, 2))"


def dice_a_sql(a: str, b: str) -> str:
    ga, gb = grams_sql(a), grams_sql(b)
    shared = (
        f"list_sum(list_transform(list_distinct({ga}), lambda g: least(len(list_filter({ga}, lambda y: y = g)), "
        f"len(list_filter({gb}, lambda y: y = g)))))"
    )
    return (
        f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN {a} = {b} THEN 1.0 WHEN length({a}) < 2 OR length({b}) < 2 THEN 0.0 "
        f"ELSE coalesce({shared}, 0) * 2.0 / (length({a}) + length({b}) - 2) END"
    )


def dice_b_sql(a: str, b: str) -> str:
    ga, gb = (f"list_distinct({grams_sql(p)})" for p in (f"('  ' || {a} || '  ')", f"('  ' || {b} || '  ')"))
    return f"len(list_intersect({ga}, {gb})) * 2.0 / (len({ga}) + len({gb}))"


def haversine_sql(lat_a: str, lng_a: str, lat_b: str, lng_b: str, radius: str = "6371008.8") -> str:
    return (
        f"2 * {radius} * asin(sqrt(pow(sin(({lat_b} - {lat_a}) * pi() / 180 / 2), 2) + cos({lat_a} * pi() / 180) * "
        f"cos({lat_b} * pi() / 180) * pow(sin(({lng_b} - {lng_a}) * pi() / 180 / 2), 2)))"
    )


def near_sql(a: str, b: str, degrees: str = "0.002") -> str:
    """Coarse box that keeps the comparison of all pairs cheap."""
    return f"abs({a}.lat - {b}.lat) < {degrees} AND abs({a}.lng - {b}.lng) < {degrees}"
