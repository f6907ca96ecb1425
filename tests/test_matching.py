"""Distributed matching against plain loops on small fixtures."""

import math
import random
import unicodedata
import re

import pytest
from pyspark.sql import functions as F

from poifuse import schema
from poifuse.operators import assignment, dedup, linking, merge, quality, skew, spatial

R = 6371008.8


def metres(a, b):
    la, lb = math.radians(a["lat"]), math.radians(b["lat"])
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b["lng"] - a["lng"]) / 2) ** 2
    return 2 * R * math.asin(math.sqrt(h))


def fold(name):
    plain = "".join(c for c in unicodedata.normalize("NFD", name.lower()) if not unicodedata.combining(c))
    return re.sub("[^a-z0-9]+", " ", plain.replace("ß", "ss")).strip()


def dice(a, b):
    ga, gb = ({s[i : i + 2] for i in range(len(s) - 1)} for s in (f"  {a}  ", f"  {b}  "))
    return 2 * len(ga & gb) / (len(ga) + len(gb))


def points(n, seed, names, spread=0.002, copies=0.3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < copies:
            twin = rng.choice(rows)
            rows.append({**twin, "id": i, "ord": i})
        else:
            rows.append({"id": i, "ord": i, "name": rng.choice(names), "lng": 8 + rng.random() * spread, "lat": 50 + rng.random() * spread})
    return rows


NAMES = ["Kiosk Nord", "Kiosk Süd", "Nordkiosk", "Am Markt", "Markt 3", "王记", "Büdchen", "Büdchen am Park", "X"]


def frame(spark, rows):
    return spark.createDataFrame([(r["id"], r["ord"], r["name"], r["lng"], r["lat"]) for r in rows], "id bigint, ord bigint, name string, lng double, lat double")


@pytest.mark.parametrize("hot_rows", [20_000, 4])
def test_pairs_within_equals_all_pairs(spark, hot_rows):
    a, b = points(120, 1, NAMES), points(120, 2, NAMES)
    left = frame(spark, a).select("lng", "lat", F.col("id").alias("a"))
    right = frame(spark, b).select("lng", "lat", F.col("id").alias("b"))
    got = sorted((r["a"], r["b"]) for r in spatial.pairs_within(left, right, 30, hot_rows=hot_rows).collect())
    assert got == sorted((x["id"], y["id"]) for x in a for y in b if metres(x, y) <= 30)


def test_best_match_does_not_depend_on_the_split(spark):
    f, c = frame(spark, points(150, 3, NAMES, copies=0.4)), frame(spark, points(150, 4, NAMES, copies=0.4))
    plain = sorted(map(tuple, linking.best_match(f, c).collect()))
    split = sorted(map(tuple, linking.best_match(f, c, hot_rows=2).collect()))
    assert plain == split and len(plain) > 50
    links = sorted(map(tuple, linking.first_similar(f, c).collect()))
    assert links == sorted(map(tuple, linking.first_similar(f, c, hot_rows=2).collect())) and links


def feature_rows(seeds, maps):
    def row(p, kind):
        pay = ("yes", None, None, None) if p["id"] % 3 == 0 else None
        entry = [(kind, str(p["id"]), None)]
        address = ("Weg", "1", None, None, None) if p["id"] % 4 == 0 else (None,) * 5
        return ("r", p["ord"], p["lng"], p["lat"], str(p["id"]), p["name"], None, address, None, None, pay, entry) + (None,) * 8
    return [row(p, "hopfenstop") for p in seeds] + [row(p, "osm") for p in maps]


def score(p):
    return (p["id"] % 3 == 0) + 2 * (p["id"] % 4 == 0)


def greedy(seeds, maps):
    pairs = []
    for h in seeds:
        for o in maps:
            a, b, m = fold(h["name"]), fold(o["name"]), metres(h, o)
            exact, sim = len(a) >= 4 and a == b, dice(a, b)
            if m > (60 if exact or sim >= 0.65 else 30):
                continue
            sub = len(a) >= 3 and len(b) >= 3 and (a in b or b in a)
            addr = h["id"] % 4 == 0 and o["id"] % 4 == 0
            if exact or sim >= 0.55 or sub or addr or m <= 8:
                pairs.append((0, -sim, m, str(h["id"]), str(o["id"])))
            elif sim >= 0.3:
                pairs.append((1, -sim, m, str(h["id"]), str(o["id"])))
    for i, a in enumerate(seeds):
        for b in seeds[i + 1 :]:
            if len(fold(a["name"])) >= 4 and fold(a["name"]) == fold(b["name"]) and metres(a, b) <= 60:
                kept, gone = (a, b) if score(a) >= score(b) else (b, a)
                pairs.append((0, -1.0, metres(a, b), str(gone["id"]), str(kept["id"])))
    pairs.sort(key=lambda p: (p[0], round(p[1], 12), round(p[2], 6)))
    gone, kept, out = set(), set(), set()
    for tier, _, _, g, k in pairs:
        if g not in gone and k not in kept:
            gone.add(g)
            kept.add(k)
            out.add((g, k, tier))
    return out


@pytest.mark.parametrize("seed,hot_rows", [(5, 20_000), (6, 3)])
def test_assignment_equals_sequential_greedy(spark, seed, hot_rows):
    seeds = points(40, seed, NAMES, spread=0.0012, copies=0.5)
    maps = [{**p, "id": p["id"] + 1000, "ord": p["ord"] + 1000} for p in points(30, seed + 50, NAMES, spread=0.0012, copies=0.2)]
    maps += [{**p, "id": p["id"] + 2000, "ord": p["ord"] + 2000} for p in seeds[:10]]
    df = spark.createDataFrame(feature_rows(seeds, maps), schema.FEATURE_DDL)
    got = {(r["gone_id"], r["kept_id"], r["tier"]) for r in dedup.pair_and_assign(df, hot_rows).collect()}
    assert got == greedy(seeds, maps)


def test_pile_of_equal_copies_is_settled_by_rank(spark):
    seeds = [{"id": i, "ord": i, "name": "Kiosk Nord", "lng": 8.0, "lat": 50.0} for i in range(1, 60, 12)]
    df = spark.createDataFrame(feature_rows(seeds, []), schema.FEATURE_DDL)
    got = {(r["gone_id"], r["kept_id"], r["tier"]) for r in dedup.pair_and_assign(df).collect()}
    assert got == greedy(seeds, [])


def test_first_row_wins_is_order_greedy(spark):
    edges = [("r", 1, 1, "a"), ("r", 1, 1, "b"), ("r", 2, 2, "b"), ("r", 2, 2, "c"), ("r", 3, 3, "c"), ("r", 4, 4, "d")]
    df = spark.createDataFrame(edges, "region string, id int, ord int, osm_id string")
    assert {r["id"] for r in dedup.first_row_per_id(df).collect()} == {1, 3, 4}


def test_numbered_equals_window_rank(spark):
    df = spark.range(5000).select((F.col("id") % 3 == 0).cast("string").alias("key"), F.col("id").alias("o"))
    ranks = skew.numbered(df, ["key"], ["o"]).filter("key = 'true'").collect()
    assert {r["o"]: r["rank"] for r in ranks} == {o: o // 3 + 1 for o in range(0, 5000, 3)}


@pytest.mark.parametrize("most", [1, 2, 7, 8, 200])
def test_a_row_is_compared_with_few_bounds_of_ranges(spark, most):
    """collection_round_trip, stable_positions: every row used to be compared with every bound."""
    bounds = F.array(*[F.struct(F.lit(i // 3 * 3).alias("a"), F.lit("k").alias("b")) for i in range(most)])
    place = F.struct(F.col("id").cast("int").alias("a"), F.when(F.col("id") % 2 == 0, "k").when(F.col("id") % 5 > 0, "j").alias("b"))
    rows = spark.range(-3, most + 3).select(place.alias("place"), bounds.alias("bounds"))
    halved = skew._bounds_passed(F.col("bounds"), F.col("place"), most)
    got = rows.select(halved.alias("n"), F.size(F.filter("bounds", lambda b: b <= F.col("place"))).alias("m")).collect()
    assert all(r["n"] == r["m"] for r in got) and {0, most} <= {r["n"] for r in got}
    plan = skew.numbered(spark.range(500).selectExpr("id % 3 AS key", "id"), ["key"], ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan.replace("isnotnull", "")


def test_salted_join_keeps_all_rows(spark):
    left = spark.range(1000).select((F.when(F.col("id") < 900, 0).otherwise(F.col("id"))).alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([(0, "hot"), (950, "cold")], "k bigint, w string")
    got = skew.salted_join(left, right, ["k"], hot_rows=10)
    assert got.count() == 901 and got.select("v").distinct().count() == 901
    assert skew.salted_join(left, right, ["k"], "left", hot_rows=10).count() == 1000


def test_merging_a_chain_passes_data_on(spark):
    rows = feature_rows([{"id": i, "ord": i, "name": "N" * i, "lng": 8.0, "lat": 50.0} for i in (1, 2, 3)], [])
    rows = [r[:6] + (f"d{r[4]}" if r[4] == "3" else None,) + r[7:] for r in rows]
    df = spark.createDataFrame(rows, schema.FEATURE_DDL)
    pairs = spark.createDataFrame(
        [("r", "3", "2", 1.0, 1.0, "twin", 0, 1, 2, 3), ("r", "2", "1", 2.0, 1.0, "twin", 0, 1, 1, 2)],
        "region string, gone_id string, kept_id string, meters double, sim double, reason string, tier int, kind int, first_ord bigint, second_ord bigint",
    )
    out = merge.apply_absorptions(df, pairs, "2024-01-01").collect()
    assert [(r["id"], r["description"], len(r["sources"])) for r in out] == [("1", "d3", 3)]


@pytest.mark.parametrize("seed", [15, 16])
def test_components_above_the_bound_go_in_rounds(spark, seed):
    seeds = points(30, seed, NAMES, spread=0.0012, copies=0.5)
    maps = [{**p, "id": p["id"] + 1000, "ord": p["ord"] + 1000} for p in points(25, seed + 50, NAMES, spread=0.0012, copies=0.2)]
    df = spark.createDataFrame(feature_rows(seeds, maps), schema.FEATURE_DDL)
    got = {(r["gone_id"], r["kept_id"], r["tier"]) for r in dedup.pair_and_assign(df, large_rows=4).collect()}
    assert got == greedy(seeds, maps)


def test_pile_of_copies_with_mixed_completeness(spark):
    seeds = [{"id": i, "ord": (i * 7919) % 5003, "name": "Kiosk Nord", "lng": 8.0, "lat": 50.0} for i in range(5000)]
    rows = spark.createDataFrame(feature_rows(seeds, []), schema.FEATURE_DDL)
    sites = dedup.site_rows(rows).groupBy(*dedup.SITE, "site").agg(F.count("*").alias("n"))
    assert dedup.site_pairs(sites).count() <= 10  # pairs of sites, not of rows
    got = {(r["gone_id"], r["kept_id"]) for r in dedup.pair_and_assign(rows).collect()}
    # the plain loop over all pairs of the pile, in row order
    order = sorted(seeds, key=lambda p: p["ord"])
    gone, kept, want = set(), set(), set()
    scores = [score(p) for p in order]
    for i, a in enumerate(order):
        for j in range(i + 1, len(order)):
            if i in gone and i in kept:
                break
            g, k = (j, i) if scores[i] >= scores[j] else (i, j)
            if g not in gone and k not in kept:
                gone.add(g), kept.add(k), want.add((str(order[g]["id"]), str(order[k]["id"])))
    assert got == want


def test_chain_is_one_component(spark):
    """A chain of 1,000 places, each similar to the next: few jobs, same result as the plain loop."""
    names = [f"Bude {'abcdefghij'[i % 10] * 3} {'klmnopqrst'[i // 10 % 10] * 3}" for i in range(1000)]
    seeds = [{"id": i, "ord": i, "name": names[i], "lng": 8.0 + i * 0.00035, "lat": 50.0} for i in range(0, 1000, 2)]
    maps = [{"id": i, "ord": i, "name": names[i], "lng": 8.0 + i * 0.00035 + i * 1e-7, "lat": 50.0} for i in range(1, 1000, 2)]
    df = spark.createDataFrame(feature_rows(seeds, maps), schema.FEATURE_DDL)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    got = {(r["gone_id"], r["kept_id"], r["tier"]) for r in dedup.pair_and_assign(df).collect()}
    assert got == greedy(seeds, maps) and len(got) > 300
    assert len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before)) < 60


def test_components_of_long_chains(spark):
    edges = [(i, i + 1, i % 7) for i in range(1000)] + [(5000 + i, 5001 + i, 0) for i in range(10)]
    df = spark.createDataFrame(edges, "a long, b long, area long")
    got = {r["node"]: r["root"] for r in assignment.components(df, ["area"]).collect()}
    assert got == {i: 0 for i in range(1001)} | {5000 + i: 5000 for i in range(11)}


@pytest.mark.parametrize("large_rows", [1_000_000, 6])
def test_rows_with_several_ids_against_a_loop(spark, large_rows):
    draw = random.Random(large_rows)
    rows = [("r", i, 100 - i, [f"k{i}", f"k{i + 1}"]) for i in range(60)]  # a chain against the row order
    rows += [(draw.choice("rs"), 100 + i, 1000 + draw.randrange(10**6), [f"m{draw.randrange(60)}" for _ in range(draw.randint(1, 3))]) for i in range(150)]
    edges = spark.createDataFrame([(g, i, o, k) for g, i, o, keys in rows for k in sorted(set(keys))], "region string, id int, ord int, osm_id string")
    got = {(r["region"], r["id"]) for r in dedup.first_row_per_id(edges, large_rows=large_rows).collect()}
    used, want = set(), set()
    for g, i, _, keys in sorted(rows, key=lambda r: (r[2], r[1])):
        if not used & {(g, k) for k in keys}:
            used |= {(g, k) for k in keys}
            want.add((g, i))
    assert got == want


def kept_by_loop(rows):
    used, want = set(), set()
    for g, i, _, keys in sorted(rows, key=lambda r: (r[2], r[1])):
        mine = {(g, k) for k in keys if k is not None}
        if not used & mine:
            used |= mine
            want.add((g, i))
    return want


@pytest.mark.parametrize("task_rows", [50_000, 20, 0])
def test_ties_null_keys_and_null_regions_in_rounds_and_walks(spark, monkeypatch, task_rows):
    draw = random.Random(task_rows)
    monkeypatch.setattr(dedup, "TASK_ROWS", task_rows, raising=False)
    rows = [(draw.choice(["r", "s", None]), i, draw.randrange(40), [draw.choice([None, *range(40)]) for _ in range(draw.randint(1, 3))]) for i in range(200)]
    rows += [("t", 300 + i, 100 - i, [1000 + i, 1001 + i]) for i in range(60)]  # a chain against the order
    edges = spark.createDataFrame([(g, i, o, k) for g, i, o, keys in rows for k in set(keys)], "region string, id int, ord int, osm_id int")
    out = dedup.first_row_per_id(edges)
    got = [(r["region"], r["id"]) for r in out.collect()]
    want = kept_by_loop(rows)
    assert set(got) == want
    assert len(got) == sum(len(set(keys)) for g, i, _, keys in rows if (g, i) in want)


def test_rows_in_no_particular_order_need_no_components(spark, monkeypatch):
    """rows_with_several_ids: rounds that settle most of what is open cost less than the components of all of it."""
    draw = random.Random(3)
    rows = [("r", i, draw.randrange(10**6), sorted({draw.randrange(1500) for _ in range(draw.randint(1, 4))})) for i in range(1200)]
    edges = spark.createDataFrame([(g, i, o, k) for g, i, o, keys in rows for k in keys], "region string, id int, ord int, osm_id int")
    monkeypatch.setattr(dedup, "TASK_ROWS", 100, raising=False)
    monkeypatch.setattr(dedup, "components", lambda *_: pytest.fail("components of rows that rounds settle"))
    assert {(r["region"], r["id"]) for r in dedup.first_row_per_id(edges).collect()} == kept_by_loop(rows)


def test_vocabulary_by_slug_then_by_label(spark):
    vocab = spark.createDataFrame([("bier", "Wein", 0), ("wein", "Bier", 1), ("cola", "Limo", 3), ("mate", "Limo", 2)], "slug string, de string, ord int")
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(["Bier", "Wein", "Limo", "Tee", "", None, "Limo"])], "n int, tag string")
    got = {r["n"]: r["slug"] for r in quality.match_vocabulary(labels, vocab).collect()}
    assert got == {0: "bier", 1: "wein", 2: "mate", 3: None, 4: None, 5: None, 6: "mate"}


def owner_by_loop(p, boxes):
    inside = [b for b in boxes if None not in (p[1], p[2]) and b[2] <= p[1] <= b[4] and b[3] <= p[2] <= b[5]]
    centre = lambda b: ((p[1] - (b[2] + b[4]) / 2) * math.cos(math.radians(p[2]))) ** 2 + (p[2] - (b[3] + b[5]) / 2) ** 2
    return min(inside, key=lambda b: ((b[6] or "city") != "city", centre(b), b[0]))[1] if inside else None


@pytest.mark.parametrize("broadcast", [True, False])
def test_region_of_points_among_boxes_of_any_size(spark, broadcast):
    draw = random.Random(20)
    boxes = []
    for i in range(120):
        side, ratio = 10 ** draw.uniform(-4, 1.5), draw.choice([1, 1, 0.01, 5])
        w, s = (draw.uniform(-180, 170), draw.uniform(-85, 80)) if i % 2 else (draw.uniform(8, 9), draw.uniform(50, 51))
        boxes.append((i, f"r{i}", w, s, w + side, s + side * ratio, draw.choice([None, "city", "rest"])))
    boxes += [(200, "point", 8.5, 50.5, 8.5, 50.5, "city"), (201, "turned", 9.0, 50.0, 8.0, 51.0, "city"), (202, "half", None, 50.0, 9.0, 51.0, "city")]
    boxes += [(203, "all", -180.0, -90.0, 180.0, 90.0, "rest")]
    pts = [(i, draw.uniform(-180, 180), draw.uniform(-90, 90)) for i in range(300)]
    pts += [(1000 + i, draw.uniform(7.9, 9.1), draw.uniform(49.9, 51.1)) for i in range(600)]
    pts += [(2000 + 2 * i + j, (b[2], b[4])[j], (b[3], b[5])[j]) for i, b in enumerate(boxes[:120]) for j in (0, 1)]  # corners
    pts += [(3000 + i, 8.5, 50.5) for i in range(400)] + [(4000, None, 50.0), (4001, 8.0, None), (4002, 500.0, 50.0)]
    points_df = spark.createDataFrame(pts, "id int, lng double, lat double").repartition(8)
    boxes_df = spark.createDataFrame(boxes, "ord int, slug string, w double, s double, e double, n double, role string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before if broadcast else "-1")
    try:
        got = {r["id"]: r["owner"] for r in spatial.assign_region(points_df, boxes_df).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    proper = [b for b in boxes if None not in b[2:6]]
    assert got == {p[0]: owner_by_loop(p, proper) for p in pts}
    assert spatial.assign_region(points_df, boxes_df.limit(0)).filter("owner IS NOT NULL").isEmpty()
    cells = spatial.quad_cells(boxes_df.filter("ord < 200"), F.struct("w", "s", "e", "n"))
    assert cells.groupBy("ord").count().agg(F.max("count")).first()[0] <= 4
