"""Schema rules on raw features, before a typed reader turns what doesn't fit into nulls.

A feature is parsed once into a VARIANT, so wrong types, undeclared keys at every depth,
bad geometry and missing fields are all still visible. A rule is named by its path and
what is wrong there. The rules of a field's content apply to values of the right type
only; a value of the wrong type breaks the rule "type" alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poifuse import schema

# Keys, limits and patterns of the feature schema.
OBJECTS = {
    "": (["type", "geometry", "properties"], ["type", "geometry", "properties"]),
    "geometry": (["type", "coordinates"], ["type", "coordinates"]),
    "properties": (list(schema.FEATURE_PROPERTIES), ["id", "name", "address"]),
    "properties.address": (schema.ADDRESS_KEYS, []),
    "properties.hours": (["raw"], []),
    "properties.payment": (schema.PAYMENT_KEYS, []),
}
LENGTHS = {
    "properties.name": (1, 200), "properties.description": (0, 2000), "properties.address.street": (0, 200), "properties.address.number": (0, 20),
    "properties.address.city": (0, 100), "properties.address.district": (0, 100),
}
PATTERNS = {"properties.id": "^tk_[a-z0-9]+_[a-z0-9_-]+$", "properties.address.postalcode": "^[0-9]{5}$"}
TEXTS = ["properties.hours.raw"]
DATES = [f"properties.{n}" for n in ("created", "updated", "apple_id_attempted", "apple_attempted", "google_attempted")]
ENUMS = {"type": ["Feature"], "geometry.type": ["Point"], "properties.kind": schema.KINDS} | {f"properties.payment.{k}": schema.TRI_STATES for k in schema.PAYMENT_KEYS}
SOURCE_KEYS, SOURCE_REQUIRED = ["type", "id", "version"], ["type", "id"]
TAG = "^[a-z][a-z0-9_-]*$"


LISTS = ["geometry.coordinates", "properties.tags", "properties.sources"]
STAMPS = "properties.sources_by_field"


def _paths() -> list[str]:
    """Every path that a rule looks at."""
    children = [f"{path}.{key}".lstrip(".") for path, (_, required) in OBJECTS.items() for key in required]
    return list(dict.fromkeys([*OBJECTS, *children, *LENGTHS, *PATTERNS, *TEXTS, *DATES, *ENUMS, "properties.osm_removed", *LISTS, STAMPS]))


def _name(path: str) -> str:
    return path.replace(".", "_") or "root"


def _at(path: str) -> Column:
    return F.col(f"value_{_name(path)}")


def _is(path: str, kind: str) -> Column:
    return _of_kind(F.col(f"type_{_name(path)}"), kind)


def _type(value: Column) -> Column:
    """Start of a value's type name; null where there is nothing."""
    return F.substring(F.schema_of_variant(value), 1, 7)


def _of_kind(name: Column, kind: str) -> Column:
    """A type name against OBJECT, ARRAY, STRING, BOOLEAN or NUMBER. The name is used once, as it may be an expression."""
    if kind in ("OBJECT", "ARRAY"):
        return F.coalesce(name.startswith(kind), F.lit(False))
    if kind == "NUMBER":
        return F.coalesce(~name.rlike("^(OBJECT|ARRAY|STRING$|BOOLEAN$|VOID$)"), F.lit(False))
    return F.coalesce(name == kind, F.lit(False))


def _broken(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def _text(path: str) -> Column:
    """The text of a string; null for anything else."""
    return F.when(_is(path, "STRING"), F.try_variant_get(_at(path), "$", "string"))


def _item_is(value: Column, kind: str) -> Column:
    return _of_kind(_type(value), kind)


def _item_text(value: Column) -> Column:
    return F.when(_item_is(value, "STRING"), F.try_variant_get(value, "$", "string"))


def _item_number(value: Column) -> Column:
    return F.when(_item_is(value, "NUMBER"), F.try_variant_get(value, "$", "double"))


def _items(path: str) -> Column:
    return F.col(f"items_{_name(path)}")


def _undeclared(value: Column, is_object: Column, known: list[str], path: str) -> Column:
    keys = F.when(is_object, F.json_object_keys(F.to_json(value)))
    found = F.array_except(keys, F.array(*[F.lit(k) for k in known]))
    return F.coalesce(F.transform(found, lambda k: F.concat(F.lit(f"{path} undeclared ".lstrip()), k)), F.array().cast("array<string>"))


def _taken_apart(parsed: DataFrame) -> DataFrame:
    """Values, type names and list items of all paths of doc as columns, so that each is taken once per row and not once per rule."""
    values = parsed.select("row", F.col("doc").isNull().alias("not_json"), *[F.try_variant_get("doc", f"$.{p}" if p else "$", "variant").alias(f"value_{_name(p)}") for p in _paths()])
    typed = values.select("*", *[_type(_at(p)).alias(f"type_{_name(p)}") for p in _paths()])
    lists = [F.when(_is(p, "ARRAY"), F.try_variant_get(_at(p), "$", "array<variant>")).alias(f"items_{_name(p)}") for p in LISTS]
    return typed.select("*", *lists)


def is_date(text: Column) -> Column:
    return text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull()


def broken_rules() -> Column:
    """Names of the rules that a feature breaks, from the columns of _taken_apart."""
    checks: dict[str, Column] = {"json": F.col("not_json")}
    lists: list[Column] = []

    def wrong_type(path: str, kind: str) -> None:
        checks[f"{path} type".lstrip()] = _at(path).isNotNull() & ~_is(path, kind)

    for path, (known, required) in OBJECTS.items():
        wrong_type(path, "OBJECT")
        lists.append(_undeclared(_at(path), _is(path, "OBJECT"), known, path))
        for key in required:
            checks[f"{path}.{key} required".lstrip(".")] = _is(path, "OBJECT") & _at(f"{path}.{key}".lstrip(".")).isNull()
    for path in [*LENGTHS, *PATTERNS, *TEXTS, *DATES]:
        wrong_type(path, "STRING")
    for path, (least, most) in LENGTHS.items():
        checks[f"{path} length"] = _broken(~F.length(_text(path)).between(least, most))
    for path, pattern in PATTERNS.items():
        checks[f"{path} pattern"] = _broken(~_text(path).rlike(pattern))
    for path in DATES:
        checks[f"{path} date"] = _text(path).isNotNull() & ~_broken(is_date(_text(path)))
    for path, values in ENUMS.items():
        checks[f"{path} value"] = _at(path).isNotNull() & ~_broken(_text(path).isin(values))
    wrong_type("properties.osm_removed", "BOOLEAN")

    place = _items("geometry.coordinates")
    wrong_type("geometry.coordinates", "ARRAY")
    checks["geometry.coordinates size"] = _broken(~F.size(place).between(2, 3))
    checks["geometry.coordinates numbers"] = _broken(F.exists(place, lambda v: ~_item_is(v, "NUMBER")))
    checks["geometry.coordinates longitude"] = _broken(~_item_number(F.get(place, 0)).between(-180, 180))
    checks["geometry.coordinates latitude"] = _broken(~_item_number(F.get(place, 1)).between(-90, 90))

    tags = _items("properties.tags")
    wrong_type("properties.tags", "ARRAY")
    checks["properties.tags items"] = _broken(F.exists(tags, lambda v: ~_item_is(v, "STRING")))
    checks["properties.tags pattern"] = _broken(F.exists(tags, lambda v: ~_item_text(v).rlike(TAG)))
    texts = F.transform(tags, lambda v: F.to_json(v))
    checks["properties.tags unique"] = _broken(F.size(F.array_distinct(texts)) < F.size(tags))

    sources = _items("properties.sources")
    part = lambda v, key: F.try_variant_get(v, f"$.{key}", "variant")
    wrong_type("properties.sources", "ARRAY")
    checks["properties.sources items"] = _broken(F.exists(sources, lambda v: ~_item_is(v, "OBJECT")))
    for key in SOURCE_REQUIRED:
        checks[f"properties.sources.{key} required"] = _broken(F.exists(sources, lambda v: _item_is(v, "OBJECT") & part(v, key).isNull()))
    checks["properties.sources.type value"] = _broken(F.exists(sources, lambda v: part(v, "type").isNotNull() & ~_broken(_item_text(part(v, "type")).isin(schema.SOURCE_TYPES))))
    checks["properties.sources.id type"] = _broken(F.exists(sources, lambda v: part(v, "id").isNotNull() & ~_item_is(part(v, "id"), "STRING")))
    whole = lambda v: _broken((_item_number(v) >= 0) & (_item_number(v) == F.floor(_item_number(v))))
    checks["properties.sources.version value"] = _broken(F.exists(sources, lambda v: part(v, "version").isNotNull() & ~whole(part(v, "version"))))
    more = F.transform(sources, lambda v: _undeclared(v, _item_is(v, "OBJECT"), SOURCE_KEYS, "properties.sources"))
    lists.append(F.coalesce(F.array_distinct(F.flatten(more)), F.array().cast("array<string>")))

    wrong_type(STAMPS, "OBJECT")
    values = F.map_values(F.when(_is(STAMPS, "OBJECT"), F.try_variant_get(_at(STAMPS), "$", "map<string,variant>")))
    checks[f"{STAMPS} value"] = _broken(F.exists(values, lambda v: ~_broken(_item_text(v).isin(list(schema.SOURCE_RANK)))))
    found = F.array_compact(F.array(*[F.when(test, F.lit(rule)) for rule, test in checks.items()]))
    return F.concat(found, *lists)


def raw_violations(raw: DataFrame, value: str = "value") -> DataFrame:
    """One row per broken rule of raw features (a JSON text per row): the other columns and rule."""
    names = [c for c in raw.columns if c != value]
    # the feature is parsed once per row, not once per rule
    parsed = raw.select(F.struct(*names).alias("row"), F.explode(F.array(F.try_parse_json(value))).alias("doc"))
    judged = _taken_apart(parsed).select("row", broken_rules().alias("rules"))
    # explode would filter rows by the size of rules first, and work all of them out once more, below the columns they are taken from
    return judged.select("row", F.explode_outer("rules").alias("rule")).filter("rule IS NOT NULL").select("row.*", "rule")


class SchemaError(ValueError):
    """Features that break the schema, with the first of them."""


def require_valid(raw: DataFrame, value: str = "value", shown: int = 10) -> None:
    """Stop if a feature breaks a rule; the message counts them and shows a few."""
    found = raw_violations(raw, value)
    n = found.count()
    if n:
        raise SchemaError(f"{n} broken rules, such as {[tuple(r) for r in found.limit(shown).collect()]}")
