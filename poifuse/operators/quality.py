"""Data-quality reports: schema rules, region lint, vocabulary, duplicates, completeness gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poifuse import schema
from poifuse.functions import geo, provenance, rules, text
from poifuse.operators.skew import salted_join

MAX_MISSING_SHARE, MIN_EXPECTED = 0.2, 10
DATE_FIELDS = ["created", "updated", "apple_id_attempted", "apple_attempted", "google_attempted"]


def feature_rules() -> dict[str, Column]:
    """Rule name to "is broken"; every rule is checked on every feature."""
    def bad(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    rules = {
        "lng range": bad(~F.col("lng").between(-180, 180)) | F.col("lng").isNull(),
        "lat range": bad(~F.col("lat").between(-90, 90)) | F.col("lat").isNull(),
        "id required": F.col("id").isNull(),
        "id pattern": bad(~F.col("id").rlike("^tk_[a-z0-9]+_[a-z0-9_-]+$")),
        "name required": F.col("name").isNull(),
        "name length": bad(~F.length("name").between(1, 200)),
        "description length": bad(F.length("description") > 2000),
        "address required": F.col("address").isNull(),
        "postalcode pattern": bad(~F.col("address.postalcode").rlike("^[0-9]{5}$")),
        "tag pattern": bad(F.exists("tags", lambda t: ~t.rlike("^[a-z][a-z0-9_-]*$"))),
        "tags unique": bad(F.size("tags") != F.size(F.array_distinct("tags"))),
        "source fields": bad(F.exists("sources", lambda s: s["type"].isNull() | s["id"].isNull())),
        "source type": bad(F.exists("sources", lambda s: ~s["type"].isin(schema.SOURCE_TYPES))),
        "source version": bad(F.exists("sources", lambda s: s["version"] < 0)),
        "kind": bad(~F.col("kind").isin(schema.KINDS)),
        "stamp source": bad(F.exists(F.map_values("sources_by_field"), lambda v: ~v.isin(list(schema.SOURCE_RANK)))),
    }
    for part, limit in {"street": 200, "number": 20, "city": 100, "district": 100}.items():
        rules[f"{part} length"] = bad(F.length(f"address.{part}") > limit)
    for key in schema.PAYMENT_KEYS:
        rules[f"payment.{key}"] = bad(~F.col(f"payment.{key}").isin(schema.TRI_STATES))
    for field in DATE_FIELDS:
        day = F.col(field)
        rules[f"{field} date"] = day.isNotNull() & ~(bad(day.rlike(r"^\d{4}-\d{2}-\d{2}$")) & day.try_cast("date").isNotNull())
    return rules


def violations(features: DataFrame, undeclared: Column | None = None) -> DataFrame:
    """One row per broken rule; `undeclared` is an array of unknown property names."""
    found = F.array_compact(F.array(*[F.when(broken, F.lit(rule)) for rule, broken in feature_rules().items()]))
    if undeclared is not None:
        found = F.concat(found, F.transform(undeclared, lambda key: F.concat(F.lit("undeclared "), key)))
    return features.select("region", "id", F.explode(found).alias("rule"))


def undeclared_keys(properties_json: Column) -> Column:
    known = F.array(*[F.lit(name) for name in schema.FEATURE_PROPERTIES])
    return F.array_except(F.json_object_keys(properties_json), known)


def duplicates(df: DataFrame, key: Column, label: str, show: str) -> DataFrame:
    """Rows whose key value occurs more than once: one result row per member, with the count."""
    keyed = df.select(key.alias("value"), F.col(show).alias("member"))
    counts = keyed.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return salted_join(keyed, counts, ["value"]).select(F.lit(label).alias("field"), "value", "n", "member")


def lint_regions(regions: DataFrame) -> DataFrame:
    """Every problem of the region list: duplicates and malformed fields, one row per region."""
    dupes = [duplicates(regions, F.col(field), field, "slug") for field in ("slug", "path", "prefix")]
    problems = dupes[0].unionByName(dupes[1]).unionByName(dupes[2])
    dupe_rows = problems.select(F.concat(F.lit("duplicate "), "field").alias("problem"), "value", F.col("member").alias("slug"))
    checks = {
        "prefix": ~F.col("prefix").rlike("^[a-z0-9]+$"),
        "iso3166_2": ~F.col("iso3166_2").rlike("^[A-Z]{2}(-[A-Z0-9]+)?$"),
        "role": F.col("role").isNotNull() & ~F.col("role").isin("city", "rest"),
    }
    found = F.array_compact(
        F.array(*[F.when(test, F.struct(F.lit(f"malformed {field}").alias("problem"), F.col(field).alias("value"))) for field, test in checks.items()])
    )
    broken = regions.select("slug", F.explode(found).alias("hit")).select("hit.problem", "hit.value", "slug")
    return dupe_rows.unionByName(broken)


def match_vocabulary(labels: DataFrame, vocab: DataFrame, column: str = "tag") -> DataFrame:
    """Add the vocabulary slug of a free label: by slug first, else by slugified display label.

    Each distinct label is looked up once, so a word that a third of all rows carry is
    one row of the lookup; rows then meet their label on a salted key."""
    first = F.min(F.struct("ord", "slug"))["slug"]
    by_label = vocab.groupBy(text.tag_slug(F.col("de")).alias("key")).agg(first.alias("by_label"))
    by_slug = vocab.select(F.col("slug").alias("key"), F.col("slug").alias("by_slug")).distinct()
    distinct = labels.select(F.col(column).alias("label")).distinct().withColumn("key", text.tag_slug(F.col("label")))
    found = distinct.join(by_slug, "key", "left").join(by_label, "key", "left")
    found = found.select(F.col("label").alias(column), F.coalesce("by_slug", "by_label").alias("slug")).filter("slug is not null")
    return salted_join(labels, found, [column], "left")


def unknown_labels(matched: DataFrame, column: str = "tag", top: int = 30) -> DataFrame:
    """The most frequent labels without a slug."""
    counts = matched.filter(F.col("slug").isNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(top)


def expected_ids(features: DataFrame) -> DataFrame:
    """Live element ids per region and query group, one row each."""
    live = features.filter(~F.coalesce("osm_removed", F.lit(False)))
    group = rules.group_of_kind(F.col("kind")).alias("query_group")
    return live.select("region", group, F.explode(provenance.osm_ids(F.col("sources"))).alias("osm_id")).distinct()


def missing_share(expected: DataFrame, answers: DataFrame) -> DataFrame:
    """Share of expected ids that each answer lacks; zero where few are expected.

    `answers` lists (region, query_group, mirror) and `answer_ids` its ids; an
    answer may be empty, so both come in one table with a nullable osm_id.
    """
    keys = ["region", "query_group"]
    want = expected.groupBy(*keys).agg(F.count(F.lit(1)).alias("expected"))
    got = answers.filter(F.col("osm_id").isNotNull()).select(*keys, "mirror", "osm_id").distinct()
    hits = got.join(expected, [*keys, "osm_id"], "left_semi").groupBy(*keys, "mirror").agg(F.count(F.lit(1)).alias("found"))
    mirrors = answers.select(*keys, "mirror").distinct()
    joined = mirrors.join(want, keys, "left").join(hits, [*keys, "mirror"], "left")
    expected_n, found = F.coalesce("expected", F.lit(0)), F.coalesce("found", F.lit(0))
    share = F.when(expected_n < MIN_EXPECTED, F.lit(0.0)).otherwise((expected_n - found) / expected_n)
    return joined.select(*keys, "mirror", expected_n.alias("expected"), share.alias("share"))


def accept_answers(shares: DataFrame) -> DataFrame:
    """First acceptable mirror per region and group, and what follows if there is none.

    Without an acceptable answer the kiosk group fails its whole region; any
    other group is only frozen for this run.
    """
    good = F.when(F.col("share") <= MAX_MISSING_SHARE, F.col("mirror"))
    chosen = shares.groupBy("region", "query_group").agg(F.min(good).alias("mirror"))
    return chosen.withColumn("status", _group_status())


def _group_status() -> Column:
    return F.when(F.col("mirror").isNotNull(), "accepted").when(F.col("query_group") == "kiosk", "region failed").otherwise("group frozen")


def judged_groups(asked: DataFrame, accepted: DataFrame) -> DataFrame:
    """Status of every asked or answered (region, query_group); one that nobody answered fails like a refused one."""
    keys = ["region", "query_group"]
    every = asked.select(keys).union(accepted.select(keys)).distinct()
    return every.join(accepted.select(*keys, "mirror"), keys, "left").withColumn("status", _group_status())


def valid_points(points: DataFrame) -> DataFrame:
    return points.filter(geo.valid_point(F.col("lng"), F.col("lat")))
