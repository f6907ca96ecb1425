"""Ids that are null, repeated or beyond doubles, columns with clashing names, and scores against numpy."""

import math

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from poifuse.llm import cube, licence_classifier, line_quality, page_template, projection_forest, url_filter

BIG = 2**53


def test_mix_keeps_every_id(spark):
    rows = [(BIG + i, "word " * (3 + i % 4), "s", "not a number") for i in range(30)] + [(None, "one two", "s", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row string")
    got = cube.mix(docs, block=7).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == sorted((r[0] for r in rows), key=str)
    stage = corpus_pipeline.source_mix(spark, docs, "")
    taken = {(r["doc_id"], r["text"]): r["times"] for r in cube.mix(docs).join(docs.withColumn("h", F.xxhash64("text")).select(F.col("doc_id").alias("d"), "h", "text"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("h"))).collect()}
    out = [(r["doc_id"], r["text"]) for r in stage.collect()]
    assert {k: out.count(k) for k in taken} == taken and stage.columns == docs.columns


def test_landing_keeps_the_number_of_documents():
    draw = np.random.default_rng(1)
    for _ in range(50):
        size, p = draw.integers(1, 900, 60).astype(float), draw.random(60)
        moved = cube.flight(size, p, draw.random(100))
        out = cube.landing(size, p, moved, 0.3)
        assert set(out) <= {0.0, 1.0} and abs(out.sum() - p.sum()) < 2 and abs((size * out).sum() - (size * p).sum()) < 60


def brute_links(rows):
    links = [set() for _ in rows]
    for a, (_, x, l) in enumerate(rows):
        for b, (_, y, m) in enumerate(rows[:a]):
            if l == m and len(x) == len(y):
                p, q = np.array(x) / max(map(abs, x)), np.array(y) / max(map(abs, y))
                if p @ q / math.sqrt((p @ p) * (q @ q)) >= 0.93:
                    links[a].add(b), links[b].add(a)
    return links


def test_vectors_with_null_repeated_and_large_values(spark):
    rows = [(None, [5.0, 5.0], 1), (None, [5.0, 5.1], 1), (7, [5.0, 5.0], 1), (1, [1.0, 0.0], 2), (1, [0.0, 1.0], 2), (2, [1.0, 0.01], 2), (3, [0.01, 1.0], 2), (4, [1e39, 1e39], 3), (5, [1e300, 1.1e300], 3), (6, [1e-300, 1e-300], 3)]
    got = projection_forest.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    links = brute_links(rows)

    def component(i):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j), todo.append(j)
        return min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)

    want = [(r[0], len(links[i]), component(i) if r[0] is not None else None) for i, r in enumerate(rows)]
    assert sorted(map(str, ((r["vec_id"], r["n_links"], r["component_id"]) for r in got))) == sorted(map(str, want))


def test_columns_of_any_name_stay(spark):
    text = " ".join(f"word{i} then word{i}x follows{i}." for i in range(40))
    docs = spark.createDataFrame([(1, text, 0.5, "own", "x")], "doc_id long, text string, q_score double, q_kept string, `a.b` string")
    assert [tuple(r) for r in line_quality.clean(docs).collect()] == [(1, text, 0.5, "own", "x")]
    pages = spark.createDataFrame([("http://example.com/en/", 1, 2, 3, 4)], "url string, keys int, rules int, hashes int, row int")
    rules = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    got = url_filter.judge(pages, rules).collect()[0].asDict()
    assert got == {"url": "http://example.com/en/", "keys": 1, "rules": 2, "hashes": 3, "row": 4, "host": "example.com", "path": "/en/", "rule": got["rule"], "verdict": got["verdict"]}


def test_hosts_of_many_labels(spark):
    pages = spark.createDataFrame([(1, "http://" + "a." * 3000 + "net/es/")], "page_id long, url string")
    rules = spark.createDataFrame([("net", "/es/", "block"), ("a.net", "/", "allow")], "host string, path string, verdict string")
    assert [r["verdict"] for r in url_filter.judge(pages, rules).collect()] == ["block"]


def test_licence_lines_row_by_row(spark):
    lines = [
        (None, "Released under the MIT License."), (5, "Released under the MIT License."), (5, "nothing of that kind"), (6, "This file is NOT licensed under the Apache License, Version 2.0."),
        (7, "We discussed the MIT License in class and then released under the tree a box of mice."), (8, None), (9, "a\n\nAll rights reserved.\nLicensed under CC BY-SA 4.0."), (5, "Released under the MIT License."),
    ]
    docs = spark.createDataFrame(lines, "doc_id long, text string").withColumns({"found": F.lit(1), "made": F.lit(2), "row": F.lit(3)})
    got = sorted(((r["doc_id"], r["n_paragraphs"], r["families"]) for r in licence_classifier.report(docs).collect()), key=str)
    assert got == sorted([(None, 1, "mit"), (5, 1, "mit"), (5, 1, "mit"), (5, 1, ""), (6, 1, ""), (7, 1, ""), (8, 0, ""), (9, 3, "cc-by-sa,reserved")], key=str)


def test_licence_scores_against_numpy(spark):
    docs = spark.createDataFrame([(i, f"plain line {i} of words, number {i}.") for i in range(150)], "doc_id long, text string")
    weights, biases, limit = licence_classifier.train(spark, docs)
    lines = [t for _, t in licence_classifier.variants(seed=3)][::9] + ["of the", "the terms of the license", "x", ""]
    got = {r["id"]: r for r in licence_classifier.score(spark.createDataFrame([(t, t) for t in lines], "id string, line string"), weights, biases).collect()}
    families = list(biases)
    for line in lines:
        words = licence_classifier._plain_words(line)
        runs = {" ".join(words[i : i + n]) for n in (2, 3) for i in range(len(words) - n + 1)} & set(weights)
        if not runs:
            assert line not in got
            continue
        logits = np.array([biases[f] for f in families]) + sum(np.array(weights[g]) for g in runs)
        p = np.exp(logits - logits.max())
        p /= p.sum()
        assert families[int(np.argmax(p[:-1]))] == got[line]["family"] and abs(p[:-1].max() - got[line]["probability"]) < 1e-9
    assert 0.5 <= limit <= 1.0


def align(words, wanted):
    best, row = 0, [0] * (len(wanted) + 1)
    for w in words:
        new = [0]
        for j, t in enumerate(wanted, 1):
            new.append(max(0, row[j - 1] + (2 if t == w else -2), row[j] - 1, new[j - 1] - 1))
        row, best = new, max(best, *new)
    return best


def test_alignment_against_loops(spark):
    draw = np.random.default_rng(4)
    pairs = [(["abcd"[k] for k in draw.integers(0, 4, draw.integers(0, 12))], ["abcd"[k] for k in draw.integers(0, 4, draw.integers(1, 7))]) for _ in range(60)]
    rows = spark.createDataFrame(pairs, "w array<string>, t array<string>")
    got = rows.select("w", "t", licence_classifier.alignment(F.col("w"), F.col("t")).alias("s")).collect()
    assert all(r["s"] == align(r["w"], r["t"]) for r in got)


def test_deep_pages_and_names_that_end_apart(spark):
    deep = "<body>" + "<div>" * 40_000 + "<article><p>Text at the bottom.</p><div class='post-ad'>AD</div><div class='entry-header'>Head</div></article>" + "</div>" * 40_000
    wide = "<body><div class='content'>" + "<div><p>a</p></i></div>" * 20_000 + "</div><div class='article-sidebar'>Side</div><div class='content share-links content-share'>Share</div>"
    got = {r["page_id"]: r["text"] for r in page_template.extract(spark.createDataFrame([(1, "http://a.com/", deep), (2, "http://b.com/", wide)], "page_id long, url string, html string")).collect()}
    assert got == {1: "Text at the bottom. Head", 2: " ".join(["a"] * 20_000)}
