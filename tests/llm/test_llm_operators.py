"""Every operator against brute force on small tables with nulls, empty, long, tied and repeated rows and extra columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from poifuse.llm import common, cube, fm_index, licence_classifier, line_quality, packing, page_template, partenum, projection_forest, simple8b, substring, token_files, url_filter, wordbytes
from poifuse.llm.queries import _tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, fp long, n long, bit long, row long, q_kept string, key string"


def corpus(seed=3):
    """Documents of invented words: copies, edited copies, a passage in many, odd rows."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdefgeé") for _ in range(draw.randint(1, 6))) for _ in range(400)]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    passage = text(70)
    rows = []
    for i in range(60):
        kind = i % 6
        if kind == 0:
            base = text(120)
            rows.append(base)
        elif kind == 1:
            rows.append(base.upper() if i % 12 == 1 else base)
        elif kind == 2:
            cut = base.split(" ")
            for _ in range(draw.randint(1, 6)):
                cut[draw.randrange(len(cut))] = "edit" + str(draw.random())
            rows.append("\n".join([" ".join(cut[:60]), " ".join(cut[60:])]))
        elif kind == 3:
            rows.append(text(40) + ".\n" + passage + "\t" + text(30))
        elif kind == 4:
            rows.append(text(draw.randint(1, 8)))
        else:
            rows.append("spam " * 90 + text(10))
    rows += [None, "", " \n\t ", "word", text(9000) + " " + passage, "a b c d e", "a b c d e", "A B C D E"]
    return [(i, t, f"s{i % 3}" if i % 7 else None) for i, t in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, "x", "y") for r in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    own = corpus()
    return [*own, own[6], own[7]]  # two rows come twice


def test_words_of_bytes():
    texts = ["a  b\x0bc", None, "", " é x \x1f ", "x" * 3000, "a", "b"]
    got = [[] for _ in texts]
    for chunk in wordbytes.words(pa.array(texts), chunk=8):
        for i in range(chunk.rows.start, chunk.rows.stop):
            a, b = chunk.first[i - chunk.rows.start : i - chunk.rows.start + 2]
            got[i] = [chunk.data[s:e].tobytes().decode() for s, e in zip(chunk.start[a:b], chunk.end[a:b])]
    assert got == [WORD.findall(t or "") for t in texts]


@pytest.mark.parametrize("size", [0, 1, 255, 256, 257, 4000])
def test_simple8b_round_trip(size):
    draw = np.random.default_rng(size)
    for top in (2, 50_000, 1 << 40, 1 << 63):
        values = draw.integers(0, top, size, dtype=np.uint64) >> (draw.integers(0, 63, size).astype(np.uint64) * np.uint64(size % 2))
        assert (simple8b.decode(*simple8b.encode(values), size) == values).all()


def test_fm_index_against_loops():
    draw = np.random.default_rng(1)
    for trial in range(20):
        least, letters = int(draw.choice([3, 10])), int(draw.choice([1, 3, 500]))
        base = draw.integers(0, letters, 260).astype(np.uint64)
        seqs = [base[i : i + int(draw.integers(1, 90))] for i in draw.integers(0, 170, 12)]
        owner = draw.integers(0, 6, 12)
        seen = {}
        for q, o in zip(seqs, owner):
            for i in range(len(q) - least + 1):
                seen[tuple(q[i : i + least])] = min(o, seen.get(tuple(q[i : i + least]), 99))
        want = [{p for i in range(len(q) - least + 1) if seen[tuple(q[i : i + least])] < o for p in range(i, i + least)} for q, o in zip(seqs, owner)]
        flat, sizes = np.concatenate(seqs), np.array([len(q) for q in seqs])
        got = [set() for _ in seqs]
        for k, a, b in zip(*fm_index.repeated_spans(fm_index.FmIndex(flat, sizes, owner), flat, sizes, owner, least, piece=30)):
            got[k] |= set(range(a, b))
        assert got == want, trial


def brute_removal(rows, width=50):
    words = [(d, WORD.findall(t or "")) for d, t, _ in rows]
    first = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - width + 1):
                key = tuple(w[i : i + width])
                first[key] = min(d, first.get(key, d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if d is not None and first[tuple(w[i : i + width])] < d:
                gone |= set(range(i, i + width))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_substring_removal(spark, rows):
    rows = [*rows, (None, rows[0][1], "s")]
    docs = frame(spark, rows)
    got = substring.digest(docs, substring.repeated(docs, shard_words=300))
    assert sorted(map(tuple, got.collect()), key=str) == brute_removal(rows)
    text = substring.remove_repeats(docs)
    assert text.columns == docs.columns and text.count() == len(rows)


def brute_groups(rows):
    sets = []
    for d, t, _ in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((d, {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)), key=lambda k: sets[k][0])
                root[y] = x
    return sorted((d, len(s), sets[find(i)][0]) for i, (d, s) in enumerate(sets))


def test_jaccard_groups(spark, rows):
    got = partenum.jaccard_groups(frame(spark, rows))
    assert sorted(map(tuple, got.collect())) == brute_groups(rows)


def test_jaccard_large_group_of_edited_copies(spark):
    draw = random.Random(1)
    base = [f"w{draw.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(draw.randint(0, 14)):
            w[draw.randrange(150)] = f"e{draw.random()}"
        rows.append((i, " ".join(w), "s"))
    got = partenum.jaccard_groups(frame(spark, rows))
    assert sorted(map(tuple, got.collect())) == brute_groups(rows)


def test_signatures_meet_for_every_linked_pair():
    """Pairs at the threshold share as many parts as the bound says, in own or upper band, or both have spare signatures."""
    draw = np.random.default_rng(5)
    for trial in range(300):
        n = int(draw.integers(4, 700))
        a = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        swaps = int(len(a) * 0.25 / 1.75)
        b = np.unique(np.concatenate([a[draw.permutation(len(a))[swaps:]], draw.integers(0, 2**63, int(draw.integers(0, swaps + 1))).astype(np.uint64)]))
        inter = len(np.intersect1d(a, b))
        if 100 * inter < 75 * (len(a) + len(b) - inter):
            continue
        small, large = sorted((a, b), key=len)
        band = partenum.band_of(np.array([len(large)]))
        sigs, parts = [], []
        for s in (small, large):
            sig, _ = partenum.signatures(s, np.array([len(s)]), band)
            sigs.append(set(sig.tolist()))
            parts.append(len(sig) > len(s) // 3)
        own = partenum.band_of(np.array([len(small)]))
        assert own == band or (own + 1 == band and len(small) >= 0.75 * (partenum.upper(own) + 1)[0])
        if any(parts):
            assert len(sigs[0] & sigs[1]) >= max(len(x) - len(s) // 3 for x, s in zip(sigs, (small, large)))


@pytest.mark.parametrize("path", [[(1, 2), (2, 3), (3, 4)], [(i, i + 1) for i in range(40)], [(1, 9), (2, 9), (5, 5)], []])
def test_components(spark, path):
    edges = spark.createDataFrame(path, "a long, b long").repartition(7)
    got = {r["node"]: r["root"] for r in common.components(edges).collect()}
    assert got == {x: min(y for p in path for y in p if p[0] != p[1]) for p in path for x in p if p[0] != p[1] and x != min(y for q in path for y in q)}


def test_line_quality(spark, rows):
    import duckdb

    docs = frame(spark, [(d, t, s) for d, t, s in rows if True])
    got = sorted(map(tuple, line_quality.report(docs).collect()), key=str)
    con = duckdb.connect()
    table = pa.table({"doc_id": [r[0] for r in rows], "text": pa.array([r[1] for r in rows], pa.string())})
    con.register("documents", table)
    assert got == sorted(con.execute(line_quality.ORACLE_SQL).fetchall(), key=str)
    kept = line_quality.clean(docs)
    assert kept.columns == docs.columns
    lines = ["This is a fine line of words, and it ends well.", "Home | About | Contact | News | Shop", "BUY NOW!! CHEAP!! GOOD!! FAST!! TODAY!!"]
    flags = spark.createDataFrame([(x,) for x in lines], "x string").select(line_quality.line_fails(F.col("x"))).collect()
    assert [r[0] for r in flags] == [False, True, True]


def test_repeat_words_by_loop(spark):
    draw = random.Random(8)
    texts = [" ".join(draw.choice("abc") for _ in range(draw.randint(0, 40))) for _ in range(80)]
    got = [r["n_repeat_words"] for r in line_quality.report(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).orderBy("doc_id").collect()]
    for t, n in zip(texts, got):
        w = t.split()
        runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        assert n == len({p for i, r in enumerate(runs) if runs.count(r) > 1 for p in range(i, i + 3)})


def encoded(text, end):
    from poifuse.llm.tokens import encoder

    return np.append(np.array(encoder(_tokenizer()).tokenizer.encode(text or "", add_special_tokens=False).ids, dtype="<u4"), np.uint32(end)).astype("<u4")


def test_token_files(spark, rows):
    path = common.stage_path(spark, "tokens")
    token_files.write_token_files(frame(spark, rows), _tokenizer(), path, block_ids=500)
    got = sorted(map(tuple, token_files.token_digest(spark, path).collect()))
    want, start = [], 0
    for d, t, _ in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = encoded(t, 1)
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == sorted(want)


def test_odd_texts_are_encoded_as_the_library_does():
    from poifuse.llm.tokens import encoder

    own = encoder(_tokenizer())
    odd = ["a,b c'd.e", "it's O'Neil's", "…,a é, b. ≮x", "\x01 a\x01,b", "1,2.3a!", "ΑΣ, ΑΣ.", "<|endoftext|>,", "≮ a≮", "", "  "]
    for rows, ids, first in own.column(pa.array(odd)):
        for i, text in enumerate(odd):
            assert ids[first[i] : first[i + 1]].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_packing(spark, rows):
    got = packing.pack_documents(frame(spark, rows), _tokenizer()).collect()
    want = []
    for d, t, _ in rows:
        ids = encoded(t, 0)
        want += [(d, k, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())) for k, at in enumerate(range(0, len(ids), 2048))]
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert sum(n for _, n in own) <= 2048 and all(o == sum(n for _, n in own[:i]) for i, (o, _) in enumerate(own))


def test_packing_plan_is_near_the_bound():
    draw = np.random.default_rng(2)
    sizes = np.clip(draw.lognormal(6.5, 0.9, 20_000).astype(int), 1, 2048)
    histogram = np.bincount(sizes, minlength=2049)
    used, count = np.zeros(2049, dtype=int), 0
    for lengths, repeats in packing.plan(histogram):
        assert sum(lengths) <= 2048 and repeats > 0
        np.add.at(used, list(lengths), repeats)
        count += repeats
    assert (used == histogram).all() and count <= 1.01 * sizes.sum() / 2048 + 1


def test_mix(spark, rows):
    docs = frame(spark, rows)
    small = sorted(map(str, cube.mix(docs, block=15).collect()))
    assert len(small) == len(rows) and small == sorted(map(str, cube.mix(docs.repartition(5), block=15).collect()))
    got = cube.mix(docs).collect()
    sizes = {}
    for d, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        over = [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 2 * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.discard(s)
    taken = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6 and r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in order:
        largest = max(len(WORD.findall(t or '')) for _, t, x in rows if x == s)
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s] + 10, 0.5 * largest)


def test_flight_keeps_sums():
    draw = np.random.default_rng(3)
    size, p = draw.integers(1, 500, 400), draw.random(400)
    moved = cube.flight(size, p, draw.random(500))
    assert abs(moved.sum() - p.sum()) < 1e-6 and abs((size * moved).sum() - (size * p).sum()) < 1e-3
    assert ((moved > 1e-9) & (moved < 1 - 1e-9)).sum() <= 2


def test_url_filter(spark):
    urls = ["http://www.example.com/en/x?y", "https://a.EXAMPLE.com/en/", "http://example.com/en", "http://x.net/es/", "http://net/fr/a#b", "http://notnet/es/", "ftp://example.com", "nothing", "", None, "http://é.com/", "http://x.com/?a=http://y.net/es/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, host string")
    rules = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    for r in url_filter.judge(pages, rules).collect():
        rest = r["url"].split("://", 1)[1] if r["url"] and "://" in r["url"] else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, *(max(fits)[1:] if fits else (None, "allow")))
    none = url_filter.judge(pages, rules.limit(0)).collect()
    assert len(none) == len(urls) + 1 and {r["verdict"] for r in none} == {"allow"}


def test_cascade_is_exact(spark):
    listed = spark.range(0, 300).select(F.xxhash64("id").alias("key"))
    universe = spark.range(0, 9000).select(F.xxhash64("id").alias("key"))
    cascade = url_filter.build(listed, universe)
    keys = np.array([r[0] for r in universe.orderBy("key").collect()], dtype=np.int64)
    inside = {r[0] for r in listed.collect()}
    assert cascade.contains(keys).tolist() == [k in inside for k in keys.tolist()] and len(cascade.levels) > 1


def test_vectors(spark):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(6, 16))
    vectors = [(i, (base[i % 6] + draw.normal(size=16) * (0.05 if i % 3 else 1)).tolist(), i % 2) for i in range(200)]
    vectors += [(200, None, 1), (201, [0.0] * 16, 1), (202, [float("nan")] * 16, 1), (203, vectors[0][1], 0), (204, vectors[0][1], None), (205, [1.0, 2.0], 0), (206, [None] * 16, 1), (207, [float("inf")] + [1.0] * 15, 0)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit("x"))
    got = {r["vec_id"]: r for r in projection_forest.near_vectors(table, leaf=20).collect()}
    links = {v[0]: set() for v in vectors}
    for i, (a, x, l) in enumerate(vectors):
        for b, y, m in vectors[:i]:
            if l is not None and l == m and x and y and len(x) == len(y) and None not in x + y and np.isfinite(x + y).all() and any(x) and any(y):
                p, q = (np.array(np.array(z, dtype=np.float32), dtype=np.float64) for z in (x, y))
                if p @ q / np.sqrt((p @ p) * (q @ q)) >= 0.93:
                    links[a].add(b), links[b].add(a)
    found, total = sum(r["n_links"] for r in got.values()), sum(map(len, links.values()))
    assert total > 500 and found >= 0.99 * total and all(got[k]["n_links"] <= len(v) for k, v in links.items())
    assert all(got[k]["n_links"] == 0 and got[k]["component_id"] == k for k in (200, 201, 202, 204, 205, 206, 207))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


PAGE = (
    "<html><head><title>t {i}</title><style>p{{}}</style></head><body><header><a href='/'>Site</a></header><nav><ul><li><a>Home {i}</a></li></ul></nav><div class='cookie-notice'>We use cookies</div>"
    "{open}<h1>Title&nbsp;{i} &amp; more</h1><p>First <b>bo</b>ld   text {i}.<br>Second<script>var x='</p>';</script></p><p>Third &eacute;</p>{close}"
    "<aside>Related {i}</aside><section id='comments'><p>Nice {i}</p></section><form><p>Send</p></form><footer>&copy; {i}</footer></body></html>"
)


@pytest.mark.parametrize("tags", [("<article>", "</article>"), ("<div id='content'>", "</div>"), ("<main class='x'>", "</main>")])
def test_page_text(spark, tags):
    pages = [(i, "http://h.com/a", PAGE.format(i=i, open=tags[0], close=tags[1])) for i in range(8)]
    pages += [(8, None, None), (9, "http://h.com/b", ""), (10, "http://one.com/", PAGE.format(i=10, open=tags[0], close="")[:330]), (11, "http://h.com/c", "plain < text"), pages[0]]
    got = {r["page_id"]: r for r in page_template.extract(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("x"))).collect()}
    for i in range(8):
        assert got[i]["text"] == f"Title {i} & more First bold text {i}. Second Third é" and got[i]["n_chars"] == len(got[i]["text"])
    assert got[8]["text"] == got[9]["text"] == "" and got[11]["text"] == "plain < text"


def test_licences(spark):
    plain = [f"word{i} and other words about nothing number {i}." for i in range(120)]
    lines = [(0, "Licensed under the Apache License, Version 2.0."), (1, "x y.\nReleased under the MIT License.\nAll rights reserved."), (2, "This work is licensed under the GNU General Public License, version 3."), (3, None), (4, ""), (5, "The court licensed under her rule the public work version.")]
    docs = spark.createDataFrame(lines + [(10 + i, t) for i, t in enumerate(plain)], "doc_id long, text string").withColumn("family", F.lit("z"))
    got = {r["doc_id"]: r["families"] for r in licence_classifier.report(docs).collect()}
    assert [got[k] for k in range(6)] == ["apache-2.0", "mit,reserved", "gpl-3.0", "", "", ""]
    assert not any(got[10 + i] for i in range(len(plain)))


def test_licence_classifier_on_held_out_variants(spark):
    docs = spark.createDataFrame([(i, f"line {i} of other words, nothing else in it {i}.") for i in range(200)], "doc_id long, text string")
    weights, biases, limit = licence_classifier.train(spark, docs)
    held = spark.createDataFrame([(f, f"{t} {k}", k) for k, (f, t) in enumerate(licence_classifier.variants(seed=99))], "want string, line string, k int").withColumn("id", F.struct("want", "k"))
    rows = licence_classifier.score(held, weights, biases).collect()
    assert sum(r["id"]["want"] == r["family"] and r["probability"] >= limit for r in rows) >= 0.9 * held.count()


def test_empty_tables(spark):
    docs = frame(spark, [])
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    rules = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    path = common.stage_path(spark, "tokens")
    token_files.write_token_files(docs, _tokenizer(), path)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    for out in (
        substring.digest(docs, substring.repeated(docs)), partenum.jaccard_groups(docs), line_quality.report(docs), token_files.token_digest(spark, path), packing.pack_documents(docs, _tokenizer()),
        cube.mix(docs), url_filter.judge(pages, rules), page_template.extract(pages), projection_forest.near_vectors(vectors), licence_classifier.report(docs),
    ):
        assert out.count() == 0
