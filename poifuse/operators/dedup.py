"""Pairing seed rows with map rows, seed twins, one-to-one assignment, first-row-wins.

Rows are identified by (region, id). A pair names the row to merge away
("gone_id") and the row that stays ("kept_id"). Pairs are ordered by tier,
similarity, distance and then by generation: seed-to-map pairs before twins,
and within each kind by the positions of the two rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poifuse import schema
from poifuse.functions import geo, provenance, text
from poifuse.operators import spatial
from poifuse.operators.assignment import CROSS, TASK_ROWS, TWIN, assign, components, walk_in_order
from poifuse.operators.skew import HOT_ROWS, numbered, salted_join
from poifuse.session import cut, staged

NEAR_M, WIDE_M, TOUCHING_M = 30.0, 60.0, 8.0
STRONG, TIER_A, TIER_B = 0.65, 0.55, 0.3
ORDER = ["tier", "neg_sim", "meters", "kind", "first_ord", "second_ord"]
SITE = ["region", "lng", "lat", "is_map", "name", "address", "score"]
LARGE_ROWS = 1_000_000
PAIR = ["region", "gone_id", "kept_id", "meters", "sim", "reason", "tier", "kind", "first_ord", "second_ord"]


def _address() -> Column:
    """Street and number as they are compared; null unless both are there."""
    def clean(part: str) -> Column:
        return F.lower(F.trim(F.coalesce(F.col(f"address.{part}"), F.lit(""))))

    return F.when((clean("street") != "") & (clean("number") != ""), F.concat_ws("|", clean("street"), clean("number")))


def _profile(df: DataFrame, side: str) -> DataFrame:
    """Columns a pair is judged by, named after its side."""
    folded = df.select(
        "region",
        "lng",
        "lat",
        F.col("id").alias(f"{side}_id"),
        F.col("ord").alias(f"{side}_ord"),
        text.fold_name(F.col("name")).alias(f"{side}_name"),
        _address().alias(f"{side}_address"),
    )
    return folded.withColumn(f"{side}_grams", text.bigram_set(F.col(f"{side}_name")))


def pair_reason(exact: Column, sim: Column, contained: Column, same_address: Column, meters: Column) -> Column:
    """First rule that holds, in order of trust; null when none does."""
    return (
        F.when(exact, "exact-name")
        .when(sim >= TIER_A, "dice")
        .when(contained, "substring")
        .when(same_address, "address")
        .when(meters <= TOUCHING_M, "close-coord")
        .when(sim >= TIER_B, "B:dice")
    )


def _judge(near: DataFrame) -> DataFrame:
    """Gate by distance and name strength, then name the reason and the tier."""
    exact = (F.length("left_name") >= 4) & (F.col("left_name") == F.col("right_name"))
    same_address = F.coalesce(F.col("left_address") == F.col("right_address"), F.lit(False))
    contained = text.contains_either_way(F.col("left_name"), F.col("right_name"))
    judged = near.withColumn("sim", text.overlap_share(F.col("left_grams"), F.col("right_grams")))
    reach = F.when(exact | (F.col("sim") >= STRONG), WIDE_M).otherwise(NEAR_M)
    judged = judged.filter(F.col("meters") <= reach)
    judged = judged.withColumn("reason", pair_reason(exact, F.col("sim"), contained, same_address, F.col("meters")))
    tier = F.when(F.col("reason").startswith("B:"), 1).otherwise(0)
    return judged.filter(F.col("reason").isNotNull()).withColumns({"tier": tier, "kind": F.lit(CROSS)})


def seed_rows(features: DataFrame) -> DataFrame:
    s = F.col("sources")
    return features.filter(provenance.has_source(s, "hopfenstop") & ~provenance.has_source(s, "osm"))


def map_rows(features: DataFrame) -> DataFrame:
    return features.filter(provenance.has_source(F.col("sources"), "osm"))


def _judged_pairs(left: DataFrame, right: DataFrame, ids: list[str], hot_rows: int) -> DataFrame:
    """Admissible pairs of two profiles, each once by its ids.

    Ordinary cells compare their rows directly. In crowded cells rows meet on
    what an admissible pair must have: a shared bigram, a shared address, or a
    distance of at most eight metres.
    """
    def tokens(side: str) -> Column:
        # Only very short names can be similar by their padding alone.
        grams = F.col(f"{side}_grams")
        return F.when(F.size(grams) > 5, F.array_remove(grams, text.PADDING_GRAM)).otherwise(grams)

    hot = spatial.crowded_cells(left, right, WIDE_M, hot_rows)
    by_name = _judge(spatial.pairs_within(left, right, WIDE_M, tokens=tokens, keys=["region"], hot_rows=hot_rows, hot=hot))
    if not hot:
        return by_name
    crowded = left.join(spatial.in_crowded_cells(left, hot, WIDE_M), ["lng", "lat"])
    by_place = _judge(spatial.pairs_within(crowded, right, TOUCHING_M, keys=["region"], hot_rows=hot_rows))
    at_address = crowded.filter(F.col("left_address").isNotNull()).withColumn("place", F.col("left_address"))
    addressed = right.filter(F.col("right_address").isNotNull()).withColumn("place", F.col("right_address"))
    by_address = _judge(spatial.pairs_within(at_address, addressed, NEAR_M, keys=["region", "place"], hot_rows=hot_rows)).drop("place")
    extra = by_place.unionByName(by_address).dropDuplicates(ids)
    return by_name.unionByName(extra.join(by_name.select(ids), ids, "left_anti"))


def cross_pairs(seeds: DataFrame, maps: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All admissible seed-to-map pairs of a region, row by row."""
    judged = _judged_pairs(_profile(seeds, "left"), _profile(maps, "right"), ["region", "left_id", "right_id"], hot_rows)
    renamed = {"left_id": "gone_id", "right_id": "kept_id", "left_ord": "first_ord", "right_ord": "second_ord"}
    return judged.withColumnsRenamed(renamed).select(PAIR)


def completeness(f: DataFrame) -> Column:
    """How many fields of a feature are filled."""
    def filled(test: Column) -> Column:
        return F.coalesce(test, F.lit(False)).cast("int")

    keys = [filled(F.col(f"payment.{key}").isNotNull()) for key in schema.PAYMENT_KEYS]
    parts = keys + [filled(F.col(c) != "") for c in ("hours.raw", "address.street", "address.number", "description")]
    total = F.greatest(F.size(F.coalesce("tags", F.array().cast("array<string>"))), F.lit(0))
    for part in parts:
        total = total + part
    return total


def _twin_rows(seeds: DataFrame) -> DataFrame:
    rows = seeds.select(
        "region", "lng", "lat", "id", "ord", text.fold_name(F.col("name")).alias("fold"), completeness(seeds).alias("score")
    )
    return rows.filter(F.length("fold") >= 4)


def _twin_pair_columns(df: DataFrame, meters: Column) -> DataFrame:
    return df.select(
        "region",
        "gone_id",
        "kept_id",
        meters.alias("meters"),
        F.lit(1.0).alias("sim"),
        F.lit("twin").alias("reason"),
        F.lit(0).alias("tier"),
        F.lit(TWIN).alias("kind"),
        F.least("gone_ord", "kept_ord").alias("first_ord"),
        F.greatest("gone_ord", "kept_ord").alias("second_ord"),
    )


def twin_pairs(gone_rows: DataFrame, kept_rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Seed rows with the same folded name (four letters or more) within 60 m.

    The more complete row stays; on a tie the earlier one. The two inputs are
    the rows that may still be merged away and those that may still stay; pass
    the seeds twice for all pairs.
    """
    names = {"id": "{}_id", "ord": "{}_ord", "score": "{}_score"}
    gone = _twin_rows(gone_rows).withColumnsRenamed({k: v.format("gone") for k, v in names.items()})
    kept = _twin_rows(kept_rows).withColumnsRenamed({k: v.format("kept") for k, v in names.items()})
    stays = ((F.col("kept_ord") < F.col("gone_ord")) & (F.col("kept_score") >= F.col("gone_score"))) | (
        (F.col("kept_ord") > F.col("gone_ord")) & (F.col("kept_score") > F.col("gone_score"))
    )
    near = spatial.pairs_within(gone, kept, WIDE_M, condition=lambda _: stays, keys=["region", "fold"], hot_rows=hot_rows)
    return _twin_pair_columns(near, F.col("meters"))


def twin_copy_pairs(seeds: DataFrame, gone_already: DataFrame) -> DataFrame:
    """Twin pairs among copies: same name, same place, equally complete.

    In row order the greedy walk lets every copy keep the next copy that is not
    gone yet. With u the open copies in order, row i therefore keeps u[i], or
    u[i + 1] when the very first copy is open (nothing stands before it). Ranks
    give these pairs without looking at all pairs of a pile.
    """
    keys = ["region", "fold", "lng", "lat"]
    rows = _twin_rows(seeds)
    piles = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
    piles = piles.filter((F.col("n") > 1) & (F.col("low") == F.col("high"))).select(*keys)
    ranked = numbered(salted_join(rows, piles, keys), keys, ["ord"], "nth")
    open_rows = ranked.join(gone_already.select("region", F.col("gone_id").alias("id")), ["region", "id"], "left_anti")
    open_ranked = numbered(open_rows, keys, ["ord"], "open_nth")
    head = open_ranked.groupBy(*keys).agg(F.bool_or(F.col("nth") == 1).alias("first_open"))
    gone = salted_join(open_ranked, head, keys).select(
        *keys,
        F.col("id").alias("gone_id"),
        F.col("ord").alias("gone_ord"),
        (F.col("open_nth") - F.col("first_open").cast("int")).alias("nth"),
    )
    kept = ranked.select(*keys, "nth", F.col("id").alias("kept_id"), F.col("ord").alias("kept_ord"))
    return _twin_pair_columns(gone.join(kept, [*keys, "nth"]), F.lit(0.0))


def copy_pairs(seeds: DataFrame, maps: DataFrame) -> DataFrame:
    """Pairs that lead the greedy order: same place and same bigrams.

    They tie on everything but row order, so the k-th seed copy takes the k-th
    map copy. Ranks come from a distributed count, and a pile of copies of any
    size is settled by one equality join instead of all its pairs.
    """
    def ranked(df: DataFrame, side: str) -> DataFrame:
        return _profile(df, side).withColumn("grams", F.array_sort(f"{side}_grams")).drop(f"{side}_grams", f"{side}_address")

    keys = ["region", "lng", "lat", "grams"]
    left, right = ranked(seeds, "left"), ranked(maps, "right")
    shared = left.select(*keys).distinct().join(right.select(*keys).distinct(), keys)
    left = numbered(salted_join(left, shared, keys), keys, ["left_ord"], "nth")
    right = numbered(salted_join(right, shared, keys), keys, ["right_ord"], "nth")
    exact = (F.length("left_name") >= 4) & (F.col("left_name") == F.col("right_name"))
    return left.join(right, [*keys, "nth"]).select(
        "region",
        F.col("left_id").alias("gone_id"),
        F.col("right_id").alias("kept_id"),
        F.lit(0.0).alias("meters"),
        F.lit(1.0).alias("sim"),
        F.when(exact, "exact-name").otherwise("dice").alias("reason"),
        F.lit(0).alias("tier"),
        F.lit(CROSS).alias("kind"),
        F.col("left_ord").alias("first_ord"),
        F.col("right_ord").alias("second_ord"),
    )


def assign_one_to_one(pairs: DataFrame) -> DataFrame:
    """Greedy assignment: best pair first, each gone row and each kept row used once.

    Computed in rounds. A pair that is the best of both its rows is what the
    sequential walk would take; taking all of those at once and repeating
    gives the same result. Each round takes at least the best remaining pair,
    minima combine before the shuffle, and the shrinking pair table is written
    to the checkpoint folder.
    """
    open_pairs = cut(pairs.withColumn("neg_sim", -F.col("sim")))
    columns = open_pairs.columns
    taken: list[DataFrame] = []
    rank = F.struct(*ORDER, "gone_id", "kept_id")
    while not open_pairs.isEmpty():
        gone = open_pairs.groupBy("region", "gone_id").agg(F.min(rank).alias("best"))
        kept = open_pairs.groupBy("region", "kept_id").agg(F.min(rank).alias("best"))
        mutual = gone.select("region", "best").join(kept.select("region", "best"), ["region", "best"])
        won = mutual.select("region", F.col("best.gone_id").alias("gone_id"), F.col("best.kept_id").alias("kept_id"))
        by_gone = won.withColumnRenamed("kept_id", "kept_by_gone")
        by_kept = won.withColumnRenamed("gone_id", "gone_by_kept")
        marked = cut(open_pairs.join(by_gone, ["region", "gone_id"], "left").join(by_kept, ["region", "kept_id"], "left"))
        taken.append(marked.filter(F.col("kept_by_gone") == F.col("kept_id")))
        open_pairs = marked.filter(F.col("kept_by_gone").isNull() & F.col("gone_by_kept").isNull()).select(columns)
    result = pairs.limit(0)
    for part in taken:
        result = result.unionByName(part.select(result.columns))
    return result


def without_claimed(df: DataFrame, claimed: DataFrame, column: str) -> DataFrame:
    ids = claimed.select("region", F.col(column).alias("id"))
    return df.join(ids, ["region", "id"], "left_anti")


def site_rows(features: DataFrame) -> DataFrame:
    """Seed and map rows with what a pair is judged by; rows that agree in all of it share a site."""
    s = F.col("sources")
    is_map = provenance.has_source(s, "osm")
    chosen = features.filter(is_map | provenance.has_source(s, "hopfenstop")).withColumn("is_map", F.coalesce(is_map, F.lit(False)))
    profile = chosen.select(
        "region",
        "lng",
        "lat",
        "id",
        F.col("ord").cast("bigint").alias("ord"),
        "is_map",
        text.fold_name(F.col("name")).alias("name"),
        _address().alias("address"),
        F.when(F.col("is_map"), 0).otherwise(completeness(chosen)).alias("score"),
    )
    return profile.withColumn("site", F.md5(F.to_json(F.struct(*SITE))))


def site_pairs(sites: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Admissible pairs of sites "a" and "b": a seed site and a map site, or two seed sites (or one with several rows) as twins."""
    def side(is_map: bool, name: str) -> DataFrame:
        own = sites.filter(F.col("is_map") == is_map)
        parts = [F.col(c).alias(f"{name}_{c}") for c in ("site", "name", "address")]
        return own.select("region", "lng", "lat", *parts, text.bigram_set(F.col("name")).alias(f"{name}_grams"))

    cross = _judged_pairs(side(False, "left"), side(True, "right"), ["left_site", "right_site"], hot_rows)
    seeds = sites.filter(~F.col("is_map") & (F.length("name") >= 4)).select("region", "name", "lng", "lat", "site", "n")
    once = (F.col("left_site") < F.col("right_site")) | ((F.col("left_site") == F.col("right_site")) & (F.col("copies") > 1))
    twins = spatial.pairs_within(
        seeds.withColumnsRenamed({"site": "left_site", "n": "copies"}), seeds.withColumnRenamed("site", "right_site").drop("n"), WIDE_M,
        condition=lambda _: once, keys=["region", "name"], hot_rows=hot_rows,
    )
    twins = twins.withColumns({"sim": F.lit(1.0), "reason": F.lit("twin"), "tier": F.lit(0), "kind": F.lit(TWIN)})
    shared = ["region", F.col("left_site").alias("a"), F.col("right_site").alias("b"), "meters", "sim", "reason", "tier", "kind"]
    area = [F.floor(F.col(c) * 20).alias(f"area_{c}") for c in ("lng", "lat")]
    return cross.select(*shared, *area).unionByName(twins.select(*shared, *area))


def pair_and_assign(features: DataFrame, hot_rows: int = HOT_ROWS, large_rows: int = LARGE_ROWS) -> DataFrame:
    """Seed-to-map pairs and seed twins of all regions, assigned one to one.

    Rows meet as sites, so a pile of copies is one row of the radius join, and
    each connected component of sites is walked in one pass. A component with
    more than large_rows rows (a pile that no task should hold) is assigned in
    rounds over all tasks instead, its piles of copies first, by rank.
    """
    rows = cut(site_rows(features))
    sites = rows.groupBy(*SITE, "site").agg(F.count(F.lit(1)).alias("n"))
    pairs = cut(site_pairs(sites, hot_rows))
    node = lambda c: F.xxhash64(c)  # two sites of one hash only share a component
    area = ["region", "area_lng", "area_lat"]
    roots = components(pairs.select(node("a").alias("a"), node("b").alias("b"), *area), area)
    paired = pairs.select(F.col("a").alias("site")).union(pairs.select("b")).distinct()
    comps = cut(paired.withColumn("node", node("site")).join(roots, "node").select("site", "root"))
    sizes = sites.join(comps, "site").groupBy("root").agg(F.sum("n").alias("n"))
    total, largest = sizes.agg(F.sum("n"), F.max("n")).first()
    pairs = pairs.drop("area_lng", "area_lat")
    if (largest or 0) <= large_rows:
        return assign(pairs, rows, comps, total or 0)
    large = cut(sizes.filter(F.col("n") > large_rows).select("root"))
    ids = rows.join(comps.join(large, "root", "left_semi"), "site", "left_semi").select("region", "id").distinct()
    in_rounds = assign_in_rounds(features.join(ids, ["region", "id"], "left_semi"), hot_rows)
    return assign(pairs, rows, comps.join(large, "root", "left_anti"), total).unionByName(in_rounds.select(PAIR))


def assign_in_rounds(features: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The same assignment without a task that holds a component: copies by rank, the rest in rounds of mutual best pairs.

    Pairs among copies lead the greedy order, so what is left can be paired without them."""
    seeds, maps = seed_rows(features), map_rows(features)
    copies = cut(copy_pairs(seeds, maps))
    twin_copies = cut(twin_copy_pairs(seeds, copies))
    settled = copies.select(PAIR).unionByName(twin_copies.select(PAIR))
    open_seeds = without_claimed(seeds, settled, "gone_id")
    pairs = cross_pairs(open_seeds, without_claimed(maps, settled, "kept_id"), hot_rows)
    twins = twin_pairs(open_seeds, without_claimed(seeds, settled, "kept_id"), hot_rows)
    return settled.unionByName(assign_one_to_one(pairs.select(PAIR).unionByName(twins.select(PAIR))))


def _round(open_rows: DataFrame, ident: str, order: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Edges of the rows that are first for all their keys, and of the rows that share no key with them.

    Keys stand before the region in joins and windows, because Spark sorts by them and regions are few."""
    def same(left: DataFrame, right: DataFrame, column: str) -> Column:
        return (left[column] == right[f"{column}_"]) & left["region"].eqNullSafe(right["region_"])

    region = F.col("region").alias("region_")
    first = open_rows.groupBy(F.col(key).alias(f"{key}_"), region).agg(F.min(F.struct(order, ident))[ident].alias("holder"))
    held = open_rows.join(first, same(open_rows, first, key), "left").select(*open_rows.columns, "holder")
    wins = F.every(F.coalesce(F.col(ident) == F.col("holder"), F.lit(True))).over(Window.partitionBy(ident, "region"))
    judged = staged(held.withColumn("wins", wins))
    winners = judged.filter("wins").select(F.col(ident).alias("holder_"), region)
    rest = judged.filter(~F.col("wins"))
    behind = rest.filter(F.col(ident) != F.col("holder"))
    lost = behind.join(winners, same(behind, winners, "holder"), "left_semi").select(F.col(ident).alias(f"{ident}_"), region)
    left = rest.join(lost, same(rest, lost, ident), "left_anti")
    return judged.filter("wins").select(open_rows.columns), staged(left.select(open_rows.columns))


def first_row_per_id(rows: DataFrame, ident: str = "id", order: str = "ord", key: str = "osm_id", large_rows: int = LARGE_ROWS) -> DataFrame:
    """Edges (row, key) of the rows that survive "drop a row if any of its keys was already emitted".

    Rows of one place in the order go by ident; a null key is no key. A round settles the
    rows that are first for all their keys and those that share a key with them, which is
    all rows where each has one key. Rounds go on while each leaves half of the edges at
    most, so that all of them together cost about twice the first, until one task can walk
    the rest. Where rounds settle less (chains against the order), the rest is
    split into connected components of rows and keys, and each is walked in row order in
    one pass. Components with more than large_rows edges go through further rounds instead.
    """
    kept, open_rows = _round(staged(rows), ident, order, key)
    before, n = 0, open_rows.count()
    while n > min(TASK_ROWS, large_rows) and (not before or 2 * n <= before):
        won, open_rows = _round(open_rows, ident, order, key)
        kept = kept.unionByName(won)
        before, n = n, open_rows.count()
    if not n:
        return kept
    if n <= min(TASK_ROWS, large_rows):
        return kept.unionByName(walk_in_order(open_rows.withColumn("root", F.lit(0)), rows.columns, ident, order, key, n))
    node = F.xxhash64("region", F.lit("key"), F.col(key).cast("string")).alias("b")
    edges = open_rows.select(F.xxhash64("region", F.lit("row"), F.col(ident).cast("string")).alias("a"), node)
    roots = components(edges, ["b"])
    placed = cut(open_rows.join(roots.select(F.col("node").alias("b"), "root"), F.xxhash64("region", F.lit("key"), F.col(key).cast("string")) == F.col("b")).drop("b"))
    sizes = placed.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    total, largest = sizes.agg(F.sum("n"), F.max("n")).first()
    small = placed
    if largest > large_rows:
        large = cut(sizes.filter(F.col("n") > large_rows).select("root"))
        small = placed.join(large, "root", "left_anti")
        rest = staged(placed.join(large, "root", "left_semi").select(rows.columns))
        while not rest.isEmpty():
            won, rest = _round(rest, ident, order, key)
            kept = kept.unionByName(won)
    return kept.unionByName(walk_in_order(small, rows.columns, ident, order, key, total))


def distinct_candidates(elements: DataFrame) -> DataFrame:
    """One row per element of overlapping tiles, the first by `ord`."""
    rest = [c for c in elements.columns if c not in ("type", "id")]
    return elements.groupBy("type", "id").agg(F.min_by(F.struct(*rest), F.col("ord")).alias("row")).select("type", "id", "row.*")


def batches(worklist: DataFrame, keys: list[str], order: list[str], size: int = 15) -> DataFrame:
    """Fixed-size batch number over an ordered worklist."""
    ranked = numbered(worklist, keys, order, "nth")
    return ranked.withColumn("batch", F.floor((F.col("nth") - 1) / size)).drop("nth")


def day_run_table(days: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of consecutive days with an equal slot, for schedules stored one row per day."""
    window = Window.partitionBy(*keys, "slot").orderBy("day")
    islands = days.withColumn("island", F.col("day") - F.row_number().over(window))
    return islands.groupBy(*keys, "slot", "island").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day")).drop("island")
