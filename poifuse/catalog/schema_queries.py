"""Queries on raw features: every schema rule broken by some rows; the region list as a file; results per asking row."""

from __future__ import annotations

import copy
import json
import uuid

from pyspark.sql import functions as F

from poifuse import schema
from poifuse.catalog import standins as st
from poifuse.catalog.registry import query
from poifuse.catalog.spatial_queries import ALL_POI, ANSWERS, BOXES, _poi, answers
from poifuse.operators import linking, schema_rules
from poifuse.session import shared_folder
from poifuse.sources import readers

VALID = {
    "type": "Feature",
    "geometry": {"type": "Point", "coordinates": [8.5, 50.1]},
    "properties": {
        "id": "tk_fr_1", "name": "N", "description": "d", "address": {"street": "S", "number": "1", "postalcode": "60311", "city": "C", "district": "D"}, "hours": {"raw": "24/7"}, "tags": ["a", "b-c"],
        "payment": dict.fromkeys(schema.PAYMENT_KEYS, "yes"), "sources": [{"type": "osm", "id": "node/1", "version": 2}], "osm_removed": True, "kind": "bar",
        **{k: "2024-02-29" for k in ("created", "updated", "apple_id_attempted", "apple_attempted", "google_attempted")}, "sources_by_field": {"hours": "osm"},
    },
}
P = "properties."
GONE = object()
#: One change of a valid feature per entry: path, new value, and the rules that it breaks.
CHANGES: list[tuple[str, object, list[str]]] = [
    ("", GONE, []), ("type", "Thing", ["type value"]), ("type", GONE, ["type required"]), ("geometry", GONE, ["geometry required"]), ("geometry", 5, ["geometry type"]), ("extra", 1, ["undeclared extra"]),
    ("geometry.type", "Line", ["geometry.type value"]), ("geometry.type", GONE, ["geometry.type required"]), ("geometry.coordinates", GONE, ["geometry.coordinates required"]), ("geometry.extra", 1, ["geometry undeclared extra"]),
    ("geometry.coordinates", "8,50", ["geometry.coordinates type"]), ("geometry.coordinates", [8.5], ["geometry.coordinates size"]), ("geometry.coordinates", [8.5, 50.1, 1, 2], ["geometry.coordinates size"]),
    ("geometry.coordinates", [8.5, 50.1, 100], []), ("geometry.coordinates", [8.5, "50.1"], ["geometry.coordinates numbers"]), ("geometry.coordinates", [181, 50], ["geometry.coordinates longitude"]), ("geometry.coordinates", [8, -90.5], ["geometry.coordinates latitude"]),
    ("properties", [], ["properties type"]), ("properties", GONE, ["properties required"]), (P + "id", GONE, ["properties.id required"]), (P + "name", GONE, ["properties.name required"]), (P + "address", GONE, ["properties.address required"]), (P + "extra", 1, ["properties undeclared extra"]),
    (P + "id", 7, ["properties.id type"]), (P + "id", "tk_FR_1", ["properties.id pattern"]), (P + "name", 7, ["properties.name type"]), (P + "name", "", ["properties.name length"]), (P + "name", "n" * 201, ["properties.name length"]), (P + "name", None, ["properties.name type"]),
    (P + "description", False, ["properties.description type"]), (P + "description", "d" * 2001, ["properties.description length"]), (P + "address", "S 1", ["properties.address type"]), (P + "address.extra", 1, ["properties.address undeclared extra"]),
    *[(f"{P}address.{k}", "x" * (n + 1), [f"properties.address.{k} length"]) for k, n in (("street", 200), ("number", 20), ("city", 100), ("district", 100))], *[(f"{P}address.{k}", 1, [f"properties.address.{k} type"]) for k in schema.ADDRESS_KEYS],
    (P + "address.postalcode", "6031", ["properties.address.postalcode pattern"]), (P + "hours", "24/7", ["properties.hours type"]), (P + "hours.raw", 1, ["properties.hours.raw type"]), (P + "hours.extra", 1, ["properties.hours undeclared extra"]),
    (P + "tags", "a", ["properties.tags type"]), (P + "tags", ["a", 1], ["properties.tags items"]), (P + "tags", ["A"], ["properties.tags pattern"]), (P + "tags", ["a", "a"], ["properties.tags unique"]),
    (P + "payment", [], ["properties.payment type"]), (P + "payment.extra", 1, ["properties.payment undeclared extra"]), *[(f"{P}payment.{k}", "maybe", [f"properties.payment.{k} value"]) for k in schema.PAYMENT_KEYS], (P + "payment.cash", True, ["properties.payment.cash value"]),
    (P + "sources", {}, ["properties.sources type"]), (P + "sources", ["osm"], ["properties.sources items"]), (P + "sources", [{"id": "1"}], ["properties.sources.type required"]), (P + "sources", [{"type": "osm"}], ["properties.sources.id required"]),
    (P + "sources", [{"type": "bing", "id": "1"}], ["properties.sources.type value"]), (P + "sources", [{"type": "osm", "id": 1}], ["properties.sources.id type"]), (P + "sources", [{"type": "osm", "id": "1", "version": -1}], ["properties.sources.version value"]),
    (P + "sources", [{"type": "osm", "id": "1", "version": 1.5}], ["properties.sources.version value"]), (P + "sources", [{"type": "osm", "id": "1", "extra": 1}], ["properties.sources undeclared extra"]), (P + "osm_removed", "yes", ["properties.osm_removed type"]),
    (P + "kind", "pub", ["properties.kind value"]), (P + "kind", 1, ["properties.kind value"]), *[(f"{P}{k}", v, [f"properties.{k} {r}"]) for k in ("created", "updated", "apple_id_attempted", "apple_attempted", "google_attempted") for v, r in (("2024-02-30", "date"), (20240229, "type"))],
    (P + "sources_by_field", [], ["properties.sources_by_field type"]), (P + "sources_by_field", {"hours": "nobody"}, ["properties.sources_by_field value"]), (P + "sources_by_field", {}, []),
]


def changed(path: str, value: object) -> dict:
    """A valid feature with one value set or taken away."""
    out = copy.deepcopy(VALID)
    *above, last = path.split(".")
    place = out
    for key in above:
        place = place[key]
    if value is GONE:
        place.pop(last, None)
    else:
        place[last] = value
    return out


EXPECTED = ", ".join(f"({i}, '{rule}')" for i, (_, _, rules) in enumerate([*CHANGES, ("", None, ["json"])]) for rule in rules)


@query("DQ1", f"SELECT p_partkey AS k, e.rule FROM part JOIN (VALUES {EXPECTED}) e(i, rule) ON p_partkey % {len(CHANGES) + 1} = e.i")
def raw_schema_rules(spark, sf):
    """Raw features, one per part; each breaks the rules that its change breaks; the last kind isn't JSON."""
    texts = [json.dumps(changed(path, value)) for path, value, _ in CHANGES] + ["{not json"]
    kind = (F.col("p_partkey") % len(texts)).cast("int")
    raw = st.parts(spark, sf).select(F.col("p_partkey").alias("k"), F.get(F.from_json(F.lit(json.dumps(texts)), "array<string>"), kind).alias("value"))
    return schema_rules.raw_violations(raw)


@query(
    "SRC2",
    f"WITH {st.cte('b', BOXES, 'nation')} SELECT ord::INTEGER AS ord, slug, path, prefix, round(w, 6) AS w, round(s, 6) AS s, round(e, 6) AS e, round(n, 6) AS n, role FROM b",
)
def region_list_file(spark, sf):
    """The region list written as one YAML file and read back."""
    b = st.table(spark, sf, "nation").selectExpr(*BOXES)
    number = lambda c: F.format_string("%.6f", c)
    lines = F.concat_ws(
        "\n", F.concat(F.lit("- slug: '"), "slug", F.lit("'")), F.concat(F.lit("  path: "), "path", F.lit("  # file")), F.concat(F.lit('  prefix: "'), "prefix", F.lit('"')), F.lit("  iso3166_2: DE-HE"),
        F.concat(F.lit("  bbox: ["), F.concat_ws(", ", *[number(c) for c in ("w", "s", "e", "n")]), F.lit("]")), F.concat(F.lit("  role: "), "role"),
    )
    path = f"{shared_folder(spark)}/regions-{uuid.uuid4().hex}.yml"
    b.orderBy("ord").select(lines.alias("value")).coalesce(1).write.text(path)
    out = readers.read_regions(spark, path)
    return out.select("ord", "slug", "path", "prefix", *[F.round(c, 6).alias(c) for c in ("w", "s", "e", "n")], "role")


@query(
    "AGG13",
    f"WITH {ALL_POI}, a AS ({ANSWERS}) SELECT feature_id, count(*) AS n, count(place_id) AS n_places, string_agg(coalesce(place_id, '-'), ',' ORDER BY ord) AS in_order FROM a GROUP BY feature_id",
)
def results_per_feature(spark, sf):
    """Search results grouped by the asking feature, in result order."""
    grouped = linking.results_by_feature(answers(_poi(spark, sf)), ["place_id"])
    listed = F.transform("results", lambda r: F.coalesce(r["place_id"], F.lit("-")))
    return grouped.select("feature_id", F.size("results").cast("long").alias("n"), F.size(F.filter("results", lambda r: r["place_id"].isNotNull())).cast("long").alias("n_places"), F.array_join(listed, ",").alias("in_order"))
