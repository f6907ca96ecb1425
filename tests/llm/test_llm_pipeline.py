"""The pipeline, stage by stage, against brute force on a small corpus."""

import re

from test_llm_operators import WORD, brute_groups, brute_removal, corpus

import corpus_pipeline
from poifuse.llm import common

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_hand_on_what_they_decide(spark):
    # sentences, so that the quality rules have something to keep
    rows = [(d, t and re.sub(r"((?:\S+ ){11}\S+) ", r"\1. ", t), s) for d, t, s in corpus(5)]
    docs = spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in [*rows, rows[0]]], COLUMNS)
    out = {}
    for name, function in corpus_pipeline.STAGES:
        docs = out[name] = common.stage(function(spark, docs, ""), name)
        if name != "best_fit_packing":
            assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    of = lambda name: sorted((r["doc_id"], r["text"], r["source"]) for r in out[name].collect())
    quality, joined, cut, mixed = (of(n) for n in ("quality_rules", "jaccard_join", "substring_dedup", "source_mix"))
    assert {d for d, _, _ in quality} == {d for d, t, _ in rows if t and len(WORD.findall(t)) >= 50 and not t.startswith("spam") and not t.isupper()}
    assert [d for d, _, _ in joined] == sorted({g for _, n, g in brute_groups(quality)})
    want = {d: n - gone for d, n, gone, _ in brute_removal(joined)}
    assert {d: len(WORD.findall(t)) for d, t, _ in cut} == want
    times = {d: sum(x == d for x, _, _ in mixed) for d, _, _ in cut}
    assert set(times.values()) <= {0, 1, 2} and {d for d, _, _ in mixed} <= set(want)
    pieces = out["best_fit_packing"].collect()
    assert {d: sum(r["doc_id"] == d and r["piece"] == 0 for r in pieces) for d in times} == times


def test_empty_corpus(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for name, function in corpus_pipeline.STAGES:
        docs = common.stage(function(spark, docs, ""), name)
    assert docs.count() == 0
