"""Cases in which an operator once did less than the whole job."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from poifuse.llm import common, licence_classifier, packing, page_template, partenum, token_files
from poifuse.llm.queries import _tokenizer
from poifuse.llm.tokens import encoder

PAGES = "page_id long, url string, html string"


def texts(spark, pages):
    return {r["page_id"]: r["text"] for r in page_template.extract(spark.createDataFrame(pages, PAGES)).collect()}


def test_host_decides_against_article_cards(spark):
    page = (
        "<html><body><div class='story'><h2>Head {i}</h2><p>Long text number {i} of the page, which stands in a plain element {i} and goes on for a while.</p>"
        "<ul class='more'><li><a href='/x'>See {i} also</a></li></ul></div>"
        "<div class='teasers'><article><a href='/y'>Card {i}</a><p>Blurb {i}</p></article><article><p>Other {i}</p></article></div></body></html>"
    )
    got = texts(spark, [(i, "http://cards.com/a", page.format(i=i)) for i in range(8)])
    assert got == {i: f"Head {i} Long text number {i} of the page, which stands in a plain element {i} and goes on for a while." for i in range(8)}


def test_fixed_text_of_any_length_does_not_choose_the_main_slot(spark):
    notice = "always the same words " * 40
    page = "<html><body><div class='box'><article><p>" + notice + "</p></article></div><div class='text'><p>Own text {i} and more of {i}</p></div></body></html>"
    got = texts(spark, [(i, "http://fixed.com/a", page.format(i=i)) for i in range(8)])
    assert got == {i: f"Own text {i} and more of {i}" for i in range(8)}


def test_wrappers_are_not_set_apart(spark):
    inner = "<article><h1>Head {i}</h1><p>Text {i} of this page, some words long.</p></article><div class='sidebar'>Side {i}</div>"
    layouts = [
        "<body class='right-sidebar'>" + inner, "<body><div class='container with-sidebar'>" + inner + "</div>", "<body><form id='aspnet' action='/'>" + inner + "</form>",
        "<html class='no-notice'><body><div class='widget'><form>" + inner + "</form></div>", "<body><div class='has-promo'>" + inner.replace("article", "div") + "</div>",
    ]
    pages = [(100 * k + i, f"http://{'big' if i else 'small'}{k}.com/", page.format(i=i)) for k, page in enumerate(layouts) for i in range(6)]
    got = texts(spark, pages)
    assert got == {k: f"Head {k % 100} Text {k % 100} of this page, some words long." for k, _, _ in pages}


def test_search_form_and_comments_stay_apart(spark):
    page = "<body><form><p>Find it {i}</p></form><article><p>Text {i} of this page, some words long.</p></article><section class='comments'><article><p>Nice {i}</p></article></section></body>"
    got = texts(spark, [(i, f"http://{'a' if i else 'b'}.com/", page.format(i=i)) for i in range(6)])
    assert got == {i: f"Text {i} of this page, some words long." for i in range(6)}


def test_equal_signatures_of_two_bands_are_two_groups():
    draw = np.random.default_rng(1)
    maps = [draw.bytes(256), draw.bytes(288), draw.bytes(864)]
    # (sig, fp, root, n, band, map): two near pairs with one signature, in bands with maps of their own length; a third band with one class
    rows = [(7, 1, 1, 60, 3, maps[0]), (7, 2, 2, 60, 3, maps[0]), (7, 3, 3, 500, 9, maps[1]), (7, 4, 4, 500, 9, maps[1]), (7, 5, 5, 1500, 12, maps[2])]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["sig", "fp", "root", "n", "band", "map"])
    got = [p for b in partenum._near_pairs(iter([batch]), False) for p in zip(*[c.to_pylist() for c in b.columns])]
    assert sorted(got) == [(1, 2), (3, 4)]
    entries = np.zeros(len(rows), dtype=partenum._ENTRY)
    for k, (sig, fp, root, n, band, _) in enumerate(rows):
        entries[k] = (sig, fp, root, n, k, band)
    blob = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([entries.tobytes()])], names=["key", "blob"])
    found, at, stop = partenum._groups(iter([blob]))
    assert [sorted(found["fp"][a:b].tolist()) for a, b in zip(at, stop)] == [[1, 2], [3, 4]]
    leading = [p for b in partenum._leading(iter([blob])) for p in zip(*[c.to_pylist() for c in b.columns])]
    assert sorted((min(a, b), max(a, b)) for a, b, _ in leading) == [(1, 2), (3, 4)]


SPECIAL = ["a b", "x <|endoftext|> y", None, "<|startoftext|>A,b<|endoftext|>", "<|ENDOFTEXT|> c.", "", "d<|endoftext|><|endoftext|>"]


def test_strings_of_added_tokens_give_their_ids():
    fresh = Tokenizer.from_file(_tokenizer())
    texts = SPECIAL + ["word, " * 300_000, "tail <|endoftext|>"]  # several chunks
    seen = 0
    for rows, ids, first in encoder(_tokenizer()).column(pa.array(texts)):
        for i in range(rows.start, rows.stop):
            assert ids[first[i - rows.start] : first[i - rows.start + 1]].tolist() == fresh.encode(texts[i] or "", add_special_tokens=False).ids
            seen += 1
    assert seen == len(texts) and 49407 in fresh.encode(SPECIAL[1], add_special_tokens=False).ids


def test_token_files_and_pieces_with_added_tokens(spark):
    fresh = Tokenizer.from_file(_tokenizer())
    docs = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string")
    path = common.stage_path(spark, "tokens")
    token_files.write_token_files(docs, _tokenizer(), path)
    ids = [np.array([*fresh.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4") for t in SPECIAL]
    starts = np.cumsum([0, *map(len, ids)])
    want = [(i, int(starts[i]), len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(ids)]
    assert sorted(map(tuple, token_files.token_digest(spark, path).collect())) == want
    assert sorted((r["doc_id"], r["length"]) for r in packing.pack_documents(docs, _tokenizer()).collect()) == [(i, len(x)) for i, x in enumerate(ids)]


def test_licences_are_fitted_and_calibrated_on_every_line(spark):
    draw = np.random.default_rng(2)
    words = [w for f, t in licence_classifier.TEMPLATES for w in [licence_classifier._plain_words(t)] if f in ("mit", "bsd", "gpl-3.0", "mpl-2.0")]

    def window():
        w = [x for x in words[draw.integers(len(words))] if not x.startswith(("licen", "copyright"))]
        start = draw.integers(len(w))
        return " ".join(w[start : start + draw.integers(2, 9)])

    lines = [(f"{window()} {k} {window()}", True) for k in range(9_000)] + [(f"plain line {k} of words", False) for k in range(6_000)]
    halves = spark.createDataFrame(lines, "text string, noticed boolean").where(F.col("noticed") == (F.pmod(F.hash("text"), F.lit(2)) == 1))
    docs = spark.createDataFrame(halves.select("text").toPandas()).withColumn("doc_id", F.lit(1))
    weights, biases, limit = licence_classifier.train(spark, docs)
    held = docs.select(F.col("text").alias("id"), F.col("text").alias("line")).where(F.pmod(F.hash("line"), F.lit(2)) == 1)
    scores = np.sort([r["probability"] for r in licence_classifier.score(held, weights, biases).collect()])[::-1]
    assert abs(limit - max(0.5, scores[held.count() // 100])) < 1e-8 and limit > 0.5
    # one more line in the half that is fitted changes the fit
    more = spark.createDataFrame([(f"{k} free of charge to any person", 2) for k in range(40)], "text string, doc_id int").where(F.pmod(F.hash("text"), F.lit(2)) == 0).limit(1)
    again, _, _ = licence_classifier.train(spark, docs.union(more))
    assert abs(np.array(again["free of"]) - np.array(weights["free of"])).max() > 1e-6


def test_highest_value_above_a_weight(spark):
    draw = np.random.default_rng(3)
    p = np.concatenate([draw.random(500), draw.random(300) * 1e-9 + 0.7, np.full(200, 0.25), [0.0, 1.0, 1.0]])
    rows = spark.createDataFrame([(float(x), 0.5) for x in p], "p double, weight double")
    order = np.sort(p)[::-1]
    for k in (0, 1, 2, 150, 333, 700, len(p) - 1):
        assert licence_classifier.highest_above(rows, 0.5 * k) == order[k]
    assert licence_classifier.highest_above(rows, 0.5 * len(p)) == 0.0 == licence_classifier.highest_above(rows.limit(0), 0.0)
