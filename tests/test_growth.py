"""Work and memory of a task on larger tables: how rows are dealt, what is broadcast, what is evaluated per row."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from poifuse.catalog import standins as st
from poifuse.operators import skew

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def many_parts(spark, tmp_path_factory):
    """part 500 times over, with shifted keys."""
    folder = str(tmp_path_factory.mktemp("parts"))
    part = st.table(spark, SMALL, "part")
    most = part.agg(F.max("p_partkey")).first()[0]
    copies = part.crossJoin(spark.range(500)).withColumn("p_partkey", F.col("p_partkey") + F.col("id") * most).drop("id")
    copies.coalesce(1).write.parquet(f"{folder}/part.parquet")
    return folder


def test_rows_of_a_compact_table_are_dealt_over_tasks_by_number(spark, monkeypatch):
    rows = spark.range(1001).toDF("p_partkey")
    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    dealt = skew.dealt(rows, "p_partkey")
    assert dealt.rdd.getNumPartitions() == 11
    assert sorted(r[0] for r in dealt.collect()) == list(range(1001))


def test_wide_rows_from_a_small_file_are_not_broadcast(spark, many_parts):
    plan = queries()["backfilled_features"](spark, many_parts)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_tag_maps_joined_to_features_by_element_are_not_broadcast(spark, many_parts):
    """The join of a backfill (backfilled_table): features with the tags of their chosen elements."""
    detail = st.elements(spark, many_parts).select("k", F.col("tags").alias("c_tags"), "version")
    plan = st.features(spark, many_parts).join(detail, "k", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_schema_rules_are_worked_out_once_per_row(spark):
    raw = spark.createDataFrame([(1, "{}")], "k int, value string")
    from poifuse.operators import schema_rules

    plan = schema_rules.raw_violations(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert "size(" not in "".join(line for line in plan.splitlines() if "Filter" in line)
    assert plan.count("try_variant_get(doc") <= len(schema_rules._paths())


def test_runs_of_words_carry_no_whole_text(spark):
    from poifuse.catalog.element_queries import _words

    plan = _words(spark, SMALL)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Generate":
        plan = plan.children().apply(0)
    assert [a for a in plan.outputSet().mkString(",").split(",") if a.startswith(("parts", "text"))] == []


def test_odd_texts_give_the_runs_of_the_split(spark, tmp_path):
    from poifuse.catalog.element_queries import _words

    texts = ["", " ", "a", "a b c", "a b c ", "a b c d", "  a\nb  c\n", "a b c d e f g\n", "é 😀 x y", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    want = set()
    for k, parts in ((k, t.split(" ")) for k, t in enumerate(texts) if t is not None):
        want |= {(k, i, " ".join(parts[i : i + 3]), " ".join(parts[i + 1 : i + 5])) for i in range(0, len(parts), 3)}
    rows = [tuple(r) for r in _words(spark, str(tmp_path)).select("doc_id", "pos", "name", "other").collect()]
    assert len(rows) == len(want) and set(rows) == want


def test_what_forms_of_a_name_share_is_worked_out_once(spark):
    from poifuse.functions import text

    names = ["Café Späti", "KIOSK am Shop", "a_kiosk_b", "kiosk", "", "shops 24/7!", "Bodega Ñandú", "王记 laden", "x\u001ckiosk\ty", "K\u212a İx", None]
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    forms = {"generic": text.normalise_name, "folded": text.fold_name, "chain": text.chain_name, "spanish": text.spanish_name, "slug": text.tag_slug}
    made = text.name_forms(rows, "name", {f: f for f in forms})
    alone = rows.select("name", *[make(F.col("name")).alias(f) for f, make in forms.items()])
    assert made.collect() == alone.collect()
    first = {r["name"]: r["generic"] for r in made.collect()}
    assert first["KIOSK am Shop"] == "am" and first["a_kiosk_b"] == "a b" and first["kiosk"] == "" and first["Café Späti"] == "café" and first["王记 laden"] == "王记"


def test_filters_do_not_move_before_the_dealing(spark, monkeypatch):
    """anchor_split_rows and others: what a filter needs would be worked out by the one task that reads the file."""
    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    wanted = skew.dealt(st.table(spark, SMALL, "part"), "p_partkey").filter(F.length("p_name") + F.col("p_size") > 3)
    plan = wanted._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RepartitionByExpression")
    assert "length(p_name" in above and "length(p_name" not in below


def test_the_nearest_anchor_is_worked_out_once_per_row(spark):
    from poifuse.operators import spatial

    points = spark.range(5).select(F.col("id"), (F.col("id") * 1.0).alias("lng"), F.lit(50.0).alias("lat"))
    placed = spatial.nearest_anchor(points, [{"lat": 50.0, "lng": 0.0, "slug": "a"}]).filter("dropped IS NULL")
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ASIN(") + plan.count("asin(") == 1


def test_days_and_runs_of_an_order_are_found_where_its_lines_are(spark, monkeypatch):
    from poifuse.catalog import feature_queries

    monkeypatch.setattr(feature_queries, "TASK_LINES", 1000)
    out = queries()["day_run_rows"](spark, SMALL)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "REPARTITION_BY_NUM" in plan
    assert out.count() > 0


def test_bigrams_outside_the_basic_plane_and_repeats(spark):
    from poifuse.functions import text

    rows = spark.createDataFrame([("😀a😀a", 3, 3), ("aaaa", 3, 3), ("é", 0, 0), ("", 0, 0), (None, 0, 0)], "t string, n int, d int")
    got = rows.select("n", F.size(F.array_distinct(text.bigram_multiset(F.col("t")))).alias("m"), text.strip_accents(F.col("t")).alias("s")).collect()
    assert all(r["n"] == r["m"] for r in got)
    assert [r["s"] for r in got] == ["😀a😀a", "aaaa", "e", "", None]


def test_forms_of_a_whole_text_give_those_of_its_runs(spark, tmp_path):
    """name_similarity: texts are normalised once, not each run of words."""
    import random

    from poifuse.catalog.element_queries import _words
    from poifuse.functions import text

    draw = random.Random(6)
    letters = ["a", "B", "z", "0", "é", "Ü", "ß", "ẞ", "Σ", "İ", "Ḱ", "́", "王", "😀", "ﬁ", "Ǆ", "-", ".", "_", "\n", "\t", "\x1f", " ", "'", " ", " ", " ", "kiosk", "Shop", "späti"]
    texts = ["", " ", "\x1f", " - - ", "Kiosk-Shop am  Späti, a_kiosk x\x1fladen", "ΟΔΟΣ ΟΔΟΣ Σ Σ. ΑΣ", None] + ["".join(draw.choices(letters, k=draw.randrange(60))) for _ in range(400)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    runs = _words(spark, str(tmp_path), forms=("generic", "folded"))
    for c in ("name", "other"):
        for form, made, alone in (("generic", text.generic_of_run, text.normalise_name), ("folded", text.folded_of_run, text.fold_name)):
            wrong = runs.select(c, made(F.col(f"{c}_{form}")).alias("got"), alone(F.col(c)).alias("want")).where("not got <=> want")
            assert wrong.collect() == []


def test_pairs_judged_in_batches_are_those_of_the_columns(spark, monkeypatch):
    import random

    from poifuse.functions import text
    from poifuse.operators import similarity

    draw = random.Random(7)
    names = ["", "a", "aa", "aaaa", "kiosk am see", "😀a😀a", "王记", None, "\U0010ffff\U0010ffff", "  a  "] + ["".join(draw.choices("ab é😀", k=draw.randrange(1, 12))) for _ in range(30)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate((a, b) for a in names for b in names)], "i int, a string, b string")
    want = rows.select("i", text.dice_multiset(F.col("a"), F.col("b")).alias("m"), text.dice_set(F.col("a"), F.col("b")).alias("s")).orderBy("i").collect()
    pairs = rows.select("i", "a", "b", F.col("a").alias("a2"), F.col("b").alias("b2"))
    monkeypatch.setattr(similarity, "MOST_PAIRS", 7)
    for table in (pairs, pairs.repartition(5)):
        got = similarity.with_dice(table, multiset=("a", "b"), padded=("a2", "b2")).orderBy("i").collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_similarity_of_runs_evaluates_nothing_element_by_element(spark):
    plan = queries()["name_similarity"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction(" not in plan and "MapInArrow" in plan
    after = plan[: plan.index("Generate ")]
    assert "lower(" not in after and "\\p{" not in after
