"""Manifest, hard negatives and decontamination against brute force, with nulls, ties, repeated rows and clashing columns."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from poifuse.llm import decontaminate, hard_negatives, manifest

# --- op11 -----------------------------------------------------------------------------


def sha(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def entry(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def proof(levels, i):
    out = []
    for nodes in levels[:-1]:
        out.append((nodes[i ^ 1] if (i ^ 1) < len(nodes) else None, i & 1))
        i >>= 1
    return out


def brute_manifest(rows):
    """rows of (doc_id, source, lang, n_chars, text)"""
    groups = {}
    for d, s, l, n, t in rows:
        leaf = sha(map(entry, (d, s, l, n, t)))
        hit = d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0
        groups.setdefault(l, []).append((d is not None, d or 0, leaf, sha(map(entry, (d, s, l, n + 1, t))) if hit else leaf, d))
    order = sorted(groups, key=lambda l: (l is not None, (l or "").encode()))
    for own in groups.values():
        own.sort(key=lambda x: x[:3])
    trees = {k: tree([x[2] for x in groups[k]]) for k in order}
    top, out = tree([trees[k][-1][0] for k in order]), []
    for g, k in enumerate(order):
        for i, (_, _, leaf, used, d) in enumerate(groups[k]):
            steps = proof(trees[k], i) + proof(top, g)
            for beside, right in steps:
                used = sha([used] if beside is None else [beside, used] if right else [used, beside])
            out.append((d, leaf, trees[k][-1][0], top[-1][0], sha(s for s, _ in steps if s), used, used == top[-1][0]))
    return sorted(map(str, out))


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def documents(spark, rows):
    extra = [(*r, 1, "x", "y", 2) for r in rows]
    return spark.createDataFrame(extra, DOCS + ", place long, grp string, leaf string, total long").repartition(5)


def got_manifest(spark, rows):
    return sorted(map(str, map(tuple, manifest.manifest(documents(spark, rows)).collect())))


def test_manifest_with_repeated_and_null_ids(spark):
    langs = ["en", None, "é", "z", "-", ""]
    rows = [(None if i % 11 == 0 else (i * 7919) % 40 * (1 if i % 3 else -70000), f"s{i % 2}", langs[i % 6], None if i % 13 == 0 else 2**63 - 1 if i % 17 == 0 else i % 9, f"t{i % 5}" if i % 6 else None) for i in range(600)]
    rows += [rows[5]] * 2100 + [(2**63 - 1, "s", "en", 1, "x"), (-(2**63), "s", "en", 1, "x"), *[(None,) * 5] * 2, (3, "s", "en", 0, "word " * 50_000)]
    assert got_manifest(spark, rows) == brute_manifest(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1024, 1025])
def test_manifest_sizes(spark, n):
    rows = [(5 * i, None, None, i, "") for i in range(n)]
    assert got_manifest(spark, rows) == brute_manifest(rows) if n else got_manifest(spark, rows) == []


@pytest.mark.parametrize("n", [0, 1, 50, manifest.FEW, manifest.FEW + 1, 60_000])
def test_containers_rank(n):
    draw = np.random.default_rng(n)
    at = np.sort(draw.choice(1 << 16, n, replace=False)).astype(np.int64)
    count = np.where(draw.random(n) < 0.1, draw.integers(2, 1 << 40, n), 1).astype(np.int64)
    blob = manifest.pack_container(at, count)
    back = manifest.offsets(blob)
    assert (back[0] == at).all() and (back[1] == count).all()
    before, own = manifest.rank(blob, at)
    assert (before == np.cumsum(count) - count).all() and (own == count).all()


# --- op12 -----------------------------------------------------------------------------


def brute_negatives(rows, every=100, k=5):
    used, seen = [], set()
    for i, e, l in rows:
        if l is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        l = int(math.fmod(l + 1, 10)) if i is not None and i % 7 == 0 else l
        if (i, l, tuple(e)) not in seen:
            seen.add((i, l, tuple(e)))
            used.append((i, l, [math.floor(256 * x) for x in e], len(used)))
    dot = lambda p, q: sum(a * b for a, b in zip(p, q))
    out = []
    for a in used:
        if a[0] is None or a[0] % every:
            continue
        order = lambda r: (-dot(a[2], r[2]), math.inf if r[0] is None else r[0])
        others = sorted((r for r in used if r[1] != a[1]), key=order)
        for p in sorted((r for r in used if r[1] == a[1] and r[3] != a[3]), key=order)[:k]:
            score = dot(a[2], p[2])
            own = [r for r in others if 80 * score <= 100 * dot(a[2], r[2]) <= 100 * score][:k]
            out += [(a[0], p[0], j + 1, r[0], score, dot(a[2], r[2])) for j, r in enumerate(own)]
    return sorted(out, key=str)


def got_negatives(spark, rows, **options):
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, grp long, rid long").repartition(4)
    return sorted(map(tuple, hard_negatives.mine(table, **options).collect()), key=str)


def vectors(seed, n=400, width=24):
    draw = np.random.default_rng(seed)
    base = draw.normal(size=(5, width)) * 0.3
    rows = [(i, (base[i % 5] + draw.normal(size=width) * 0.2).astype(np.float32).tolist(), int(draw.integers(0, 3))) for i in range(n)]
    copies = [(1000 + i, rows[3][1], i % 2) for i in range(150)]  # ties
    odd = [(2000, None, 1), (2001, [None] * width, 1), (2002, [math.nan] * width, 1), (2003, [math.inf] * width, 1), (2004, rows[5][1], None), (None, rows[3][1], 0), (None, rows[3][1], 1), (2005, rows[3][1][:7], 1), (2100, [], 0)]
    return rows + copies + odd + [rows[0], rows[100], copies[0]]


@pytest.mark.parametrize("options", [{}, {"group_bytes": 8 * 24 * 70, "block": 2}])
def test_hard_negatives(spark, options):
    rows = vectors(1)
    got = got_negatives(spark, rows, **options)
    assert got == brute_negatives(rows) and len(got) > 20


def test_hard_negatives_of_negative_scores_and_large_numbers(spark):
    rows = [(i, [(-1.0) ** (i % 3) * (i % 5), 0.1 * (i % 7)], i % 2) for i in range(0, 400, 4)]
    assert got_negatives(spark, rows, anchor_every=20) == brute_negatives(rows, 20)
    big = [(i, [2.0**20 * (i % 5 + 1) + i, 2.0**19 * (i % 3)], i % 3 % 2) for i in range(0, 200, 4)]
    assert max(abs(r[4]) for r in brute_negatives(big, 20)) > 2**54 and got_negatives(spark, big, anchor_every=20) == brute_negatives(big, 20)
    huge = [(i, [3.0e38 * (1 if i % 2 else -1)], i % 2) for i in range(0, 300, 10)]
    assert all(abs(r[4]) <= 2**63 for r in got_negatives(spark, huge))
    assert got_negatives(spark, []) == []


def test_slice_index_finds_all_that_reach_the_threshold():
    draw = np.random.default_rng(2)
    x, a = np.floor(draw.normal(size=(300, 40)) * 60 * draw.random(40)), np.floor(draw.normal(size=(9, 40)) * 60)
    index = hard_negatives.SliceIndex(x)
    ordered = a[:, index.dims]
    for share in (0.9, 0.6, 0.3, 0.0, -0.5):
        least = share * (x @ a.T).max(axis=0)
        rows, sums, able = index.scores(ordered, index.norms(ordered), least)
        exact = x[rows] @ a.T
        assert (sums[able] == exact[able]).all()
        found = {(int(rows[r]), int(q)) for r, q in zip(*np.nonzero(able & (sums >= least)))}
        assert found == {(int(r), int(q)) for r, q in zip(*np.nonzero(x @ a.T >= least))}


# --- op13 -----------------------------------------------------------------------------

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(t):
    return ITEM_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_report(docs, items, window=10):
    windows = {}
    for i, t in items:
        w = item_words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add(i)
    sizes, out = sorted({len(w) for w in windows}), []
    for d, t in docs:
        w = item_words(t)
        hit, found = [False] * len(w), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                own = windows.get(tuple(w[p : p + n]))
                if own:
                    found |= own
                    hit[p : p + n] = [True] * n
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((d, len(w), sum(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), any(hit)))
    return sorted(map(str, out))


def passages(seed=5):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcé9Z") for _ in range(draw.randint(1, 3))) for _ in range(60)]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    items = [(i, text(draw.choice([1, 2, 3, 9, 10, 11, 40, 200]))) for i in range(40)]
    items += [(50, None), (51, " ,.;"), (52, items[20][1]), (None, text(30)), (7, text(25)), (53, "a a a a a a a a a a a a a a a")]
    docs = []
    for i in range(120):
        parts = [text(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 3)):
            own = (items[draw.randrange(len(items))][1] or "").split()
            a = draw.randint(0, len(own))
            parts += [", ".join(own[a : a + draw.randint(5, 60)]).upper() if i % 2 else "\n".join(own[a:]), text(draw.randint(0, 9))]
        docs.append((i, ". ".join(parts)))
    docs += [(200, None), (201, ""), (202, "!!"), (None, items[25][1]), (3, items[26][1]), docs[3], (204, text(30_000) + " " + items[27][1]), (205, "a " * 300)]
    return docs, items


@pytest.mark.parametrize("block_words", [500_000, 200])
def test_decontamination_report(spark, block_words):
    docs, items = passages()
    table = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, n_words long, items long").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(str, map(tuple, decontaminate.report(table, bench, block_words=block_words).collect())))
    assert got == brute_report(docs, items)
    clean = decontaminate.decontaminate(table, bench, block_words=block_words)
    want = [d for d, line in zip(docs, [brute_report([d], items)[0] for d in docs]) if line.endswith("False)")]
    assert clean.columns == table.columns and sorted(map(str, ((r["doc_id"], r["text"]) for r in clean.collect()))) == sorted(map(str, want))
    assert decontaminate.report(table.limit(0), bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.report(table, bench.limit(0)).collect())


def test_long_items_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 40)
    docs, items = passages(6)
    got = decontaminate.report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(str, map(tuple, got.collect()))) == brute_report(docs, items)


def test_longest_matches(spark):
    docs, items = passages(7)
    items = [(i, t) for i, t in items if i is not None and t and len(item_words(t)) >= 10]
    rows = decontaminate.matches(spark.createDataFrame(docs[:120], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    texts = {i: [item_words(t) for j, t in items if j == i] for i, _ in items}
    words, covered = {d: item_words(t) for d, t in docs[:120]}, {}

    def longest(w, p):
        best = 0
        for own in (x for many in texts.values() for x in many):
            for k in range(len(own)):
                n = 0
                while p + n < len(w) and k + n < len(own) and w[p + n] == own[k + n]:
                    n += 1
                best = max(best, n)
        return best

    for r in rows:
        w = words[r["doc_id"]]
        found = w[r["doc_word"] : r["doc_word"] + r["n_words"]]
        assert any(found == own[r["item_word"] : r["item_word"] + r["n_words"]] for own in texts[r["item_id"]])
        assert r["n_words"] == longest(w, r["doc_word"])
        covered.setdefault(r["doc_id"], set()).update(range(r["doc_word"], r["doc_word"] + r["n_words"]))
    hits = {d: int(h) for d, h in ((eval(x)[0], eval(x)[2]) for x in brute_report(docs[:120], items))}
    assert {d: len(covered.get(d, ())) for d in hits} == hits and any(hits.values())


def test_suffix_array_and_search():
    draw = np.random.default_rng(3)
    words = draw.integers(1, 4, 300).astype(np.uint64)
    first = np.array([0, 90, 91, 91, 300])
    last = np.repeat(first[1:], np.diff(first))
    order = decontaminate.suffix_array(words, last, np.arange(300), 6)
    keys = [words[p : min(p + 6, last[p])].tolist() for p in order.tolist()]
    assert keys == sorted(keys)
    texts = pa.array([" ".join("abcd"[v] for v in draw.integers(1, 4, n)) for n in (4, 6, 12)])
    queries = decontaminate.Queries([1, 2, 3], texts, window=6)
    code = {int(h): k for k, h in enumerate(queries.words[:-6].tolist())}
    some = queries.words[draw.integers(0, len(code), 300)]
    which, at = decontaminate.search(some, last, decontaminate.suffix_array(some, last, np.arange(300), 6), queries)
    want = {(q, p) for q in range(len(queries.start)) for p in range(300) if p + queries.length[q] <= last[p] and (some[p : p + queries.length[q]] == queries.words[queries.start[q] : queries.start[q] + queries.length[q]]).all()}
    assert set(zip(which.tolist(), at.tolist())) == want
