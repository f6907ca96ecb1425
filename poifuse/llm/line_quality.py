"""Line-first quality rules, in built-in column functions only (operator 2).

Each line that holds a word is judged on its own; a line fails if it
* is a navigation line: two or more bars or chevrons between its words;
* is mostly marks: over a tenth of its non-space characters are of #*$%&|<>;
* shouts: at least five words, and over six tenths of its letters are capitals;
* stammers: at least ten words, over half of which equal the next word;
* carries a boilerplate phrase and has at most 25 words;
* has no sentence punctuation anywhere and at least twenty words, or under three words and no end mark.
Failing lines are removed. A document is rejected if it breaks a base limit or if
failing lines hold more than LOSS of its words.

Nulls and ties: a null text has no words and fails the base; other columns are
passed through; repeated rows are judged alike. An empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poifuse.functions.text import let

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LOSS = 0.5
MIN_WORDS = 50
PHRASES = (
    "all rights reserved", "accept cookies", "we use cookies", "cookie policy", "privacy policy", "terms of use", "terms of service",
    "enable javascript", "javascript is disabled", "lorem ipsum", "sign up for", "subscribe to our", "click here", "share this", "read more",
    "powered by", "skip to content", "back to top",
)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _words(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(WORD), F.lit(0))


def _stammers(words: Column) -> Column:
    return F.size(F.filter(F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("b")), lambda x: x["a"] == x["b"]))


def line_fails(line: Column) -> Column:
    """The rules, on measures that are taken once per line where several rules use them."""
    measures = F.struct(F.regexp_count(line, F.lit(WORD)).alias("n"), F.lower(line).alias("low"))
    return let(measures, lambda m: _fails(line, m["n"], m["low"]))


def _fails(line: Column, count: Column, low: Column) -> Column:
    solid = F.length(F.regexp_replace(line, SPACE, ""))
    marks = F.length(line) - F.length(_without(line, SYMBOLS))
    bars = F.length(line) - F.length(_without(line, "|»›"))
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    capitals = F.length(F.regexp_replace(line, r"[^\p{Lu}]+", ""))
    ends = F.rtrim(line).rlike(r"""[.!?…:;"'”’)\]]$""")
    phrase = F.lit(False)
    for text in PHRASES:
        phrase = phrase | low.contains(text)
    return (
        ((bars >= 2) & (bars * 20 >= count))
        | ((marks > 0) & (marks * 10 > solid))
        | ((count >= 5) & (capitals * 10 > letters * 6))
        | ((count >= 10) & (_stammers(_words(line)) * 2 > count))
        | ((count <= 25) & phrase)
        | ((count >= 20) & ~line.rlike(r"[.!?…]"))
        | ((count < 3) & ~ends)
    )


_MADE = {f"q_{n}" for n in ("text", "list", "lines", "runs", "sorted", "at", "failing", "words", "word_chars", "symbols", "dup_lines", "repeat_words", "lost_words", "cleaned", "base_failed", "kept", "all")}


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds q_words, q_word_chars, q_symbols, q_dup_lines, q_repeat_words, q_lost_words, q_base_failed, q_kept, q_cleaned.

    Columns of these names in the input are replaced."""
    names = [c for c in docs.columns if c not in _MADE]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    step = docs.select(*names, whole.alias("q_text")).withColumn("q_list", _words(F.col("q_text")))
    step = step.withColumn("q_lines", F.filter(F.split("q_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    size = F.size("q_list")
    run = F.when(size >= 3, F.transform(F.sequence(F.lit(0), size - 3), lambda i: F.xxhash64(F.get("q_list", i), F.get("q_list", i + 1), F.get("q_list", i + 2))))
    step = step.withColumn("q_runs", F.coalesce(run, F.array().cast("array<bigint>")))
    pairs = F.sort_array(F.transform("q_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct("q_runs")) < F.size("q_runs")  # else there is nothing to look for
    step = step.withColumn("q_sorted", F.when(some, pairs))
    twice = F.filter("q_sorted", lambda x, k: F.coalesce(F.get("q_sorted", k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("q_sorted", k + 1)["h"] == x["h"], F.lit(False)))
    step = step.withColumn("q_at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(F.transform("q_at", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("q_at", k + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)
    step = step.withColumn("q_failing", F.transform("q_lines", lambda x: line_fails(x)))
    lost = F.aggregate(F.transform("q_lines", lambda x, k: F.when(F.get("q_failing", k), F.regexp_count(x, F.lit(WORD))).otherwise(0)), F.lit(0).cast("long"), lambda a, x: a + x)
    step = step.select(
        *names,
        size.cast("long").alias("q_words"),
        F.length(F.regexp_replace("q_text", SPACE, "")).cast("long").alias("q_word_chars"),
        (F.length("q_text") - F.length(_without(F.col("q_text"), SYMBOLS))).cast("long").alias("q_symbols"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("q_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("q_repeat_words"),
        lost.alias("q_lost_words"),
        F.concat_ws("\n", F.filter("q_lines", lambda x, k: ~F.get("q_failing", k))).alias("q_cleaned"),
    )
    failed = (F.col("q_words") < MIN_WORDS) | (100 * F.col("q_repeat_words") > 50 * F.col("q_words"))
    step = step.withColumn("q_base_failed", failed)
    step = step.withColumn("q_kept", ~failed & (F.col("q_lost_words") <= LOSS * F.col("q_words")))
    # one row in, one row out: a filter on the verdict isn't pushed below and doesn't repeat the work
    marks = [c for c in step.columns if c not in names]
    return step.select(*names, F.explode(F.array(F.struct(*marks))).alias("q_all")).select(*names, *[F.col("q_all")[c].alias(c) for c in marks])


def report(docs: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text")).select(
        F.col("doc_id"), F.col("q_words").alias("n_words"), F.col("q_word_chars").alias("word_chars"), F.col("q_symbols").alias("n_symbols"),
        F.col("q_dup_lines").alias("n_dup_lines"), F.col("q_repeat_words").alias("n_repeat_words"), F.col("q_base_failed").alias("base_failed"), F.col("q_kept").alias("kept"),
    )


def clean(docs: DataFrame) -> DataFrame:
    """The documents that are kept, same columns (of any name), with failing lines removed from their texts."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("text"))
    judged = judge(rows).where("q_kept")
    changed = F.when(F.col("q_lost_words") > 0, F.col("q_cleaned")).otherwise(F.col("row.text"))
    return judged.select(*[changed.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


_FAILS = " OR ".join([
    r"(bars >= 2 AND bars * 20 >= n)", r"marks * 10 > solid", r"(n >= 5 AND capitals * 10 > letters * 6)", r"(n >= 10 AND len(list_filter(range(1, n), lambda i: w[i] = w[i + 1])) * 2 > n)",
    "(n <= 25 AND (" + " OR ".join(f"contains(lower(l), '{p}')" for p in PHRASES) + "))",
    r"(n >= 20 AND NOT regexp_matches(l, '[.!?…]'))", r"""(n < 3 AND NOT regexp_matches(rtrim(l), '[.!?…:;"''”’)\]]$'))""",
])

ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
p AS (SELECT rid, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
g AS (SELECT rid, i, x, lead(x) OVER s AS y, lead(x, 2) OVER s AS z FROM p WINDOW s AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x, y, z) AS c FROM g WHERE z IS NOT NULL) WHERE c > 1),
rep AS (SELECT rid, sum(least(3, coalesce(nxt - i, 3))) AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM r) GROUP BY rid),
l AS (SELECT rid, l FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM w) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
lm AS (SELECT rid, l, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS w, len(w) AS n, length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) AS solid,
  length(l) - length(translate(l, '#*$%&|<>', '')) AS marks, length(l) - length(translate(l, '|»›', '')) AS bars,
  length(regexp_replace(l, '[^\p{{L}}]+', '', 'g')) AS letters, length(regexp_replace(l, '[^\p{{Lu}}]+', '', 'g')) AS capitals FROM l),
ld AS (SELECT rid, count(*) - count(DISTINCT l) AS dup, sum(CASE WHEN {_FAILS} THEN n ELSE 0 END) AS lost FROM lm GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(ld.dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
  (len(w) < {MIN_WORDS} OR 100 * coalesce(rep.n, 0) > 50 * len(w)) AS base_failed,
  NOT (len(w) < {MIN_WORDS} OR 100 * coalesce(rep.n, 0) > 50 * len(w)) AND coalesce(ld.lost, 0) <= {LOSS} * len(w) AS kept
FROM w LEFT JOIN rep USING (rid) LEFT JOIN ld USING (rid)
"""
