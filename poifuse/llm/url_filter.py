"""URL rules through a cascade of Bloom filters (operator 5).

Every suffix of a url's host, joined with every start of its path that is as long
as some rule's path, is a key. The keys of all urls together are the universe. A
cascade is exact over it: level 1 holds the listed keys, level 2 the other keys
of the universe that level 1 takes for listed, level 3 the listed keys that level
2 takes for unlisted, and so on until nothing is mistaken. The first level that
says no decides. One cascade tells listed keys, a second one over the listed keys
tells which of them allow. Urls are then judged without a join: the longest
listed key (then the longer host) is the rule; without one the url is allowed,
as it is on no list.

A filter's size depends on the listed keys and the logarithm of the universe; it is
checked against MAX_BYTES before it is broadcast. Nulls and ties: a null url or one
without "://" has an empty host and path and no rule; a rule listed twice counts
once, as a block if the two differ; a null rule part is empty. Empty tables give
no rows, an empty list gives no rule."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poifuse.llm import common
from poifuse.llm import wordbytes as wb

RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
MAX_BYTES = 256 << 20


@dataclass
class Level:
    bits: np.ndarray  # 32-bit words
    hashes: int
    salt: int

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), dtype=bool)
        for at in places(keys, len(self.bits) * 32, self.hashes, self.salt):
            out &= (self.bits[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1
        return out


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """Membership of 64-bit key hashes, exact for keys of the universe."""
        out = np.zeros(len(keys), dtype=bool)
        open_ = np.arange(len(keys))
        for k, level in enumerate(self.levels):
            yes = level.holds(keys[open_])
            out[open_[~yes]] = k % 2 == 1
            open_ = open_[yes]
        out[open_] = len(self.levels) % 2 == 1
        return out


def places(keys: np.ndarray, bits: int, hashes: int, salt: int) -> Iterator[np.ndarray]:
    for k in range(hashes):
        yield (wb.mix(keys.view(np.uint64) + np.uint64((salt * 64 + k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))) % np.uint64(bits)).astype(np.int64)


def _level(keys: DataFrame, count: int, rate: float, salt: int) -> Level:
    """Filter of the hashes in a one-column table: partial bitmaps by task, or-ed by word."""
    words = max(1, int(np.ceil(count * np.log(1 / rate) / np.log(2) ** 2 / 32)))
    if words * 4 > MAX_BYTES:
        raise ValueError(f"a filter of {count} listed keys needs {words * 4} bytes, more than MAX_BYTES")
    hashes = max(1, round(np.log2(1 / rate)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(list(places(batch.column(0).to_numpy(), words * 32, hashes, salt))) if batch.num_rows else np.zeros(0, dtype=np.int64)
            where, inverse = np.unique(at >> 5, return_inverse=True)
            bits = np.zeros(len(where), dtype=np.uint32)
            np.bitwise_or.at(bits, inverse, np.uint32(1) << (at & 31).astype(np.uint32))
            yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(bits.astype(np.int64))], names=["word", "bits"])

    rows = keys.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most `words` rows
    out = np.zeros(words, dtype=np.uint32)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return Level(out, hashes, salt)


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade for two one-column tables of distinct 64-bit key hashes."""
    spark, key = listed.sparkSession, listed.columns[0]
    inside = common.stage(listed.distinct(), "listed")
    outside = common.stage(universe.toDF(key).distinct().join(inside, key, "left_anti"), "unlisted")
    cascade = Cascade()
    mine, other = inside, outside
    counts = [inside.count(), outside.count()]
    while counts[0]:
        salt = len(cascade.levels)
        rate = min(0.5, counts[0] * 0.5**0.5 / max(1, counts[1])) if salt == 0 else 0.5
        level = _level(mine, counts[0], rate, salt)
        cascade.levels.append(level)
        if not counts[1]:
            break
        held = spark.sparkContext.broadcast(level)

        def mistaken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(held.value.holds(batch.column(0).to_numpy())))

        wrong = common.stage(other.mapInArrow(mistaken, f"{key} long"), "mistaken")
        mine, other = wrong, mine
        counts = [wrong.count(), counts[0]]
    return cascade


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def keys_of(host: Column, path: Column, lengths: list[int], labels_most: int) -> Column:
    """Every suffix of the host at a dot, of as many labels as a rule can have, with every start of the path of a given length."""
    labels = F.split(host, r"\.", -1)
    hosts = F.transform(F.sequence(F.greatest(F.lit(1), F.size(labels) - labels_most + 1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.filter(F.array(*[F.when(F.length(path) >= n, path.substr(1, n)) for n in lengths]), lambda x: x.isNotNull()) if lengths else F.array().cast("array<string>")
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.struct(h.alias("host"), F.concat(h, p).alias("rule")))))


def judge(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict to urls; rules has host, path and verdict (allow or block)."""
    spark = urls.sparkSession
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    urls = urls.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(url).alias("url"))  # no name of theirs clashes
    rules = rules.select(F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    rules = rules.groupBy("host", "path").agg((F.min(F.col("verdict") == "allow")).alias("allow"))
    rules = common.stage(rules.select(F.xxhash64(F.concat("host", "path")).alias("key"), F.length("path").alias("n"), F.size(F.split("host", r"\.", -1)).alias("labels"), "allow"), "rules")
    lengths = sorted(r[0] for r in rules.select("n").distinct().collect())  # distinct lengths of rule paths
    most = rules.agg(F.max("labels")).first()[0] or 0
    host, path = host_and_path(F.col("url"))
    keyed = urls.select("row", host.alias("host"), path.alias("path")).withColumn("keys", keys_of(F.col("host"), F.col("path"), lengths, most))
    universe = keyed.select("host", "path", "keys").distinct().select(F.explode("keys.rule").alias("rule")).distinct().select(F.xxhash64("rule").alias("key"))
    listed = build(rules.select("key"), universe)
    allowed = build(rules.where("allow").select("key"), rules.select("key"))
    if sum(x.bits.nbytes for c in (listed, allowed) for x in c.levels) > MAX_BYTES:
        raise ValueError("the cascades are larger than MAX_BYTES")
    held = spark.sparkContext.broadcast((listed, allowed))
    order = F.array_sort("keys", lambda x, y: F.coalesce(F.nullif(F.length(y["rule"]) - F.length(x["rule"]), F.lit(0)), F.length(y["host"]) - F.length(x["host"])))
    sorted_ = keyed.withColumn("keys", order).withColumn("hashes", F.transform("keys", lambda x: F.xxhash64(x["rule"])))
    sorted_ = sorted_.select("row", "host", "path", F.transform("keys", lambda x: x["rule"]).alias("rules"), "hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, size = batch.column("hashes").flatten().to_numpy(), batch.column("hashes").value_lengths().to_numpy()
            owner = np.repeat(np.arange(len(batch)), size)
            member = np.flatnonzero(held.value[0].contains(hashes))
            first = member[np.append(True, owner[member][1:] != owner[member][:-1])] if len(member) else member
            allow = held.value[1].contains(hashes[first])
            verdict, rule = np.full(len(batch), "allow", dtype=object), np.full(len(batch), None, dtype=object)
            verdict[owner[first]] = np.where(allow, "allow", "block")
            texts = batch.column("rules").flatten()
            rule[owner[first]] = texts.take(pa.array(first)).to_pylist()
            names = [n for n in batch.schema.names if n not in ("rules", "hashes")]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(rule, type=pa.string()), pa.array(verdict, type=pa.string())], names=[*names, "rule", "verdict"])

    plain = sorted_.drop("rules", "hashes").withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(None).cast("string"))
    judged = sorted_.mapInArrow(run, plain.schema)
    return judged.select(*[F.col("row")[c].alias(c) for c in kept], "host", "path", "rule", "verdict")


ORACLE_SQL = """
WITH rules(h, p, v) AS (VALUES """ + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES) + r"""),
u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1), '^[^?#]*', 0) AS path FROM u)
SELECT page_id, host, path, max_by(h || p, length(h || p) * 1000 + length(h)) AS rule, coalesce(max_by(v, length(h || p) * 1000 + length(h)), 'allow') AS verdict
FROM s LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id, host, path
"""
