"""Explicit schemas and fixed vocabularies of the point-of-interest model.

A feature is one row. The nested blocks (address, hours, payment, sources,
provenance map) stay nested so that "block absent" and "block present but
empty" remain different values.
"""

from __future__ import annotations

# Names of the nested keys, the source ranks and the enumerations.
ADDRESS_KEYS = ["street", "number", "postalcode", "city", "district"]
PAYMENT_KEYS = ["cash", "cards", "contactless", "girocard"]
SOURCE_RANK = {"hopfenstop": 1, "osm": 2, "photon": 2, "apple": 3, "google": 4, "user": 5}
DEFAULT_RANK = 2
SOURCE_TYPES = ["osm", "hopfenstop", "user", "manual", "gmaps", "apple"]
KINDS = ["vending_machine", "convenience", "bar"]
TRI_STATES = ["yes", "no", "unknown"]
WEEK = ["Mo", "Tu", "We", "Th", "Fr", "Sa", "Su"]

ADDRESS = "STRUCT<street: STRING, number: STRING, postalcode: STRING, city: STRING, district: STRING>"
HOURS = "STRUCT<raw: STRING>"
PAYMENT = "STRUCT<cash: STRING, cards: STRING, contactless: STRING, girocard: STRING>"
SOURCES = "ARRAY<STRUCT<type: STRING, id: STRING, version: INT>>"
STAMPS = "MAP<STRING, STRING>"

FEATURE_PROPERTIES = {
    "id": "STRING",
    "name": "STRING",
    "description": "STRING",
    "address": ADDRESS,
    "hours": HOURS,
    "tags": "ARRAY<STRING>",
    "payment": PAYMENT,
    "sources": SOURCES,
    "osm_removed": "BOOLEAN",
    "kind": "STRING",
    "created": "STRING",
    "updated": "STRING",
    "apple_id_attempted": "STRING",
    "apple_attempted": "STRING",
    "google_attempted": "STRING",
    "sources_by_field": STAMPS,
}
FEATURE_COLUMNS = ["region", "ord", "lng", "lat", *FEATURE_PROPERTIES]
FEATURE_DDL = "region STRING, ord BIGINT, lng DOUBLE, lat DOUBLE, " + ", ".join(
    f"{name} {kind}" for name, kind in FEATURE_PROPERTIES.items()
)
PROPERTIES_DDL = "STRUCT<" + ", ".join(f"{n}: {k}" for n, k in FEATURE_PROPERTIES.items()) + ">"
GEOJSON_DDL = (
    "type STRING, features ARRAY<STRUCT<type: STRING, "
    "geometry: STRUCT<type: STRING, coordinates: ARRAY<DOUBLE>>, properties: " + PROPERTIES_DDL + ">>"
)

REGION_DDL = (
    "ord INT, slug STRING, path STRING, prefix STRING, iso3166_2 STRING, admin_level INT, "
    "w DOUBLE, s DOUBLE, e DOUBLE, n DOUBLE, role STRING, bbox_clip BOOLEAN"
)
ELEMENT_DDL = (
    "type STRING, id BIGINT, version INT, lat DOUBLE, lon DOUBLE, "
    "center STRUCT<lat: DOUBLE, lon: DOUBLE>, tags MAP<STRING, STRING>"
)
SEED_DDL = (
    "kioskId STRING, name STRING, description STRING, "
    "address STRUCT<street: STRING, number: STRING, city: STRING, postalcode: STRING, "
    "district: STRING, geolat: STRING, geolng: STRING>, "
    "kioskTimes ARRAY<STRUCT<day: STRING, openTime: ARRAY<INT>, closeTime: ARRAY<INT>>>, "
    "kioskTags ARRAY<STRUCT<tag: STRING, tagVotes: STRUCT<totalVotes: INT>>>"
)
AMENITIES_DDL = "ARRAY<STRUCT<amenityPresent: BOOLEAN, amenityId: STRING>>"
WEEKLY_DDL = "ARRAY<STRUCT<day: ARRAY<STRING>, timeRange: ARRAY<STRUCT<`from`: INT, `to`: INT>>>>"
BUSINESS_HOURS_DDL = f"STRUCT<weeklyHours: {WEEKLY_DDL}>"
ABOUT_DDL = "ARRAY<STRUCT<name: STRING, options: ARRAY<STRUCT<name: STRING, enabled: BOOLEAN>>>>"
OPEN_HOURS_DDL = "MAP<STRING, ARRAY<STRING>>"
