"""Radius joins on grid cells, nearest neighbours, and region ownership.

The radius join never compares everything with everything. Points meet only in
a shared grid cell. A cell so full that its pairs would pile up in one task is
split twice: by a second key that every wanted pair is known to share (name
bigrams), and by salts that spread both sides over a matrix of tasks.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poifuse.functions import geo, rules
from poifuse.operators.skew import HOT_ROWS, salts
from poifuse.session import cut

CELL = ["cell_row", "cell_col"]
NO_TOKEN = -1


def _gridded(df: DataFrame, step: float) -> DataFrame:
    row, col = geo.cell_of(F.col("lng"), F.col("lat"), step)
    return df.select(*df.columns, row, col)


def _spread(df: DataFrame, step: float) -> DataFrame:
    cells = geo.cells_around(F.col("lng"), F.col("lat"), step)
    return df.withColumn("cell", F.explode(cells)).select(
        *df.columns, F.col("cell.cell_row").alias("cell_row"), F.col("cell.cell_col").alias("cell_col")
    )


def crowded_cells(left: DataFrame, right: DataFrame, radius_m: float, hot_rows: int = HOT_ROWS) -> DataFrame | bool:
    """Measure before planning: every cell with too many pairs, as a table; False if there is none.

    One light pass over the coordinates. Without crowded cells the join that
    follows is a plain equality join on the cell.
    """
    step = geo.grid_step(radius_m)
    count = F.count(F.lit(1))
    left_counts = _spread(left.select("lng", "lat"), step).groupBy(*CELL).agg(count.alias("left_n"))
    right_counts = _gridded(right.select("lng", "lat"), step).groupBy(*CELL).agg(count.alias("right_n"))
    pairs = F.col("left_n").cast("double") * F.col("right_n")
    hot = left_counts.join(right_counts, CELL).filter(pairs > float(hot_rows) * hot_rows)
    hot = cut(hot)
    return False if hot.isEmpty() else hot


def _blocks(df: DataFrame, hot: DataFrame, side: str, tokens: Column | None, hot_rows: int) -> DataFrame:
    left_salts = F.ceil(F.col("left_n") / hot_rows).cast("int")
    right_salts = F.ceil(F.col("right_n") / hot_rows).cast("int")
    blocked = df.join(hot, CELL, "left")
    if tokens is not None:
        none = F.array(F.lit(NO_TOKEN).cast("bigint"))
        blocked = blocked.withColumn("token", F.explode(F.when(F.col("left_n").isNull(), none).otherwise(tokens)))
    own, other = (left_salts, right_salts) if side == "left" else (right_salts, left_salts)
    return salts(blocked, own, other, side).drop("left_n", "right_n")


def pairs_within(
    left: DataFrame,
    right: DataFrame,
    radius_m: float,
    *,
    tokens: Callable[[str], Column] | None = None,
    condition: Callable[[Column], Column] | None = None,
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | bool | None = None,
    keys: list[str] | None = None,
) -> DataFrame:
    """Pairs of points at most radius_m apart, with their distance as "meters".

    Both sides have lng and lat; all other column names must differ between
    them, except the equality keys. The result holds every column, the right
    coordinates as right_lng and right_lat. In crowded cells only pairs that
    share a token (array column built by `tokens(side)`) are found; callers
    pass tokens only if pairs without a shared one cannot qualify. A pair is
    returned once.
    """
    keys = keys or []
    hot = crowded_cells(left, right, radius_m, hot_rows) if hot is None else hot
    step = geo.grid_step(radius_m)
    a, b = _spread(left, step), _gridded(right, step)
    on = [*keys, *CELL]
    if hot:
        a = _blocks(a, hot, "left", tokens("left") if tokens else None, hot_rows)
        b = _blocks(b, hot, "right", tokens("right") if tokens else None, hot_rows)
        on += ["left_salt", "right_salt"] + (["token"] if tokens else [])
    b = b.withColumnsRenamed({"lng": "right_lng", "lat": "right_lat"})
    meters = geo.haversine_m(F.col("lat"), F.col("lng"), F.col("right_lat"), F.col("right_lng"))
    near = a.join(b, on).withColumn("meters", meters).filter(F.col("meters") <= radius_m)
    if hot and tokens:
        first_shared = F.array_min(F.array_intersect(tokens("left"), tokens("right")))
        near = near.filter((F.col("token") == NO_TOKEN) | (F.col("token") == first_shared)).drop("token")
    if condition is not None:
        near = near.filter(condition(F.col("meters")))
    return near.drop(*CELL, "left_salt", "right_salt")


def in_crowded_cells(points: DataFrame, hot: DataFrame, radius_m: float) -> DataFrame:
    """Distinct positions whose surroundings touch a crowded cell."""
    spread = _spread(points.select("lng", "lat").distinct(), geo.grid_step(radius_m))
    return spread.join(hot.select(*CELL), CELL, "left_semi").select("lng", "lat").distinct()


def nearest_within(
    left: DataFrame, right: DataFrame, radius_m: float, order: str, keys: list[str] | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """For every distinct left position the nearest right row; ties by `order`.

    Rows at one position are first reduced to the one that can win, so copies
    never multiply. A tenth of the radius is searched first: where that finds a
    row it is the nearest, and only the other positions search the full disc.
    """
    keys = keys or []
    place = [*keys, "lng", "lat"]
    rest = [c for c in right.columns if c not in place]
    sites = right.groupBy(*place).agg(F.min_by(F.struct(*rest), F.col(order)).alias("row")).select(*place, "row.*")
    best = F.min_by(F.struct("meters", *rest), F.struct("meters", order))

    def search(spots: DataFrame, radius: float) -> DataFrame:
        found = pairs_within(spots, sites, radius, keys=keys, hot_rows=hot_rows)
        return found.groupBy(*place).agg(best.alias("best")).select(*place, "best.*")

    spots = left.select(*place).distinct()
    close = search(spots, radius_m / 10)
    far = search(spots.join(close, place, "left_anti"), radius_m)
    return close.unionByName(far)


# Region ownership. Every box stands in the cells of one level of a quadtree, the level
# whose cells are up to four times its size, so it touches four cells at most, whatever
# its size. A point looks once into each level that has boxes: an equality join, no
# aggregation. A few regions give small tables that Spark broadcasts by its own size
# estimate; many regions become ordinary shuffled joins, where adaptive execution splits
# the points of a crowded cell over tasks (points are the outer or streamed side).

WORLD, FINEST = 360.0, 30
QUAD = ["quad_x", "quad_y"]


def quad_cells(regions: DataFrame, box: Column) -> DataFrame:
    """A row per box and cell that it touches, with quad_level, quad_x and quad_y.

    Boxes without a side, or with sides in the wrong order, hold no point and are left out.
    """
    extent = F.greatest(box["e"] - box["w"], box["n"] - box["s"], F.lit(WORLD / 2**FINEST))
    level = F.greatest(F.lit(0), F.floor(F.log2(F.lit(WORLD) / extent) / 2) * 2).cast("int")
    size = F.lit(WORLD) / F.pow(F.lit(2.0), F.col("quad_level"))

    def span(low: str, high: str) -> Column:
        return F.sequence(F.floor(box[low] / size), F.floor(box[high] / size))

    proper = (box["w"] <= box["e"]) & (box["s"] <= box["n"]) & (extent < F.lit(float("inf")))
    leveled = regions.filter(proper).withColumn("quad_level", level)
    return leveled.withColumn("quad_x", F.explode(span("w", "e"))).withColumn("quad_y", F.explode(span("s", "n")))


def _levels(cells: DataFrame) -> list[int]:
    """Levels in use: at most 16 numbers, two or three for regions of like size."""
    return sorted(r["quad_level"] for r in cells.select("quad_level").distinct().collect())


def _at_level(points: DataFrame, level: int) -> DataFrame:
    size = F.lit(WORLD / 2**level)
    return points.withColumn("quad_x", F.floor(F.col("lng") / size)).withColumn("quad_y", F.floor(F.col("lat") / size))


def _owner(boxes: Column, lng: Column, lat: Column) -> Column:
    """City boxes before catch-all boxes, then least distance to the centre, then list order."""
    inside = F.filter(boxes, lambda b: geo.in_box(lng, lat, b["w"], b["s"], b["e"], b["n"]))
    ranked = F.transform(
        inside,
        lambda b: F.struct(
            (b["role"] != "city").alias("is_rest"),
            geo.anchor_distance2(lng, lat, b["w"], b["s"], b["e"], b["n"]).alias("d2"),
            b["ord"].alias("ord"),
            b["slug"].alias("slug"),
        ),
    )
    return F.array_min(ranked)["slug"]


def assign_region(points: DataFrame, regions: DataFrame, name: str = "owner") -> DataFrame:
    """Add the owning region of every point; null where no box contains it."""
    box = F.struct("ord", "slug", "w", "s", "e", "n", F.coalesce("role", F.lit("city")).alias("role"))
    cells = quad_cells(regions.select(box.alias("region_box")), F.col("region_box"))
    tiles = cells.groupBy("quad_level", *QUAD).agg(F.sort_array(F.collect_list("region_box")).alias("boxes"))
    none = F.array().cast(tiles.schema["boxes"].dataType)
    placed, lists = points, []
    for level in _levels(cells):
        lists.append(f"quad_boxes_{level}")
        own = tiles.filter(F.col("quad_level") == level).select(*QUAD, F.col("boxes").alias(lists[-1]))
        placed = _at_level(placed, level).join(own, QUAD, "left").drop(*QUAD)
    boxes = F.concat(*[F.coalesce(c, none) for c in lists]) if lists else none
    return placed.withColumn(name, _owner(boxes, F.col("lng"), F.col("lat"))).drop(*lists)


def members_of_areas(points: DataFrame, regions: DataFrame) -> DataFrame:
    """Points that each region's query selects.

    points: lng, lat, codes (area codes it lies in). regions: one struct column
    "region". Catch-all regions meet points on the area code, city regions on
    quadtree cells of their box; both are equality joins.
    """
    rest = regions.filter(F.col("region.role") == "rest").withColumn("code", F.col("region.iso3166_2"))
    coded = points.withColumn("code", F.explode(F.array_distinct("codes"))).join(rest, "code").drop("code")
    city = regions.filter(F.coalesce(F.col("region.role"), F.lit("city")) != "rest")

    cells = quad_cells(city, F.col("region"))
    found = coded
    for level in _levels(cells):
        own = cells.filter(F.col("quad_level") == level).drop("quad_level")
        found = found.unionByName(_at_level(points, level).join(own, QUAD).drop(*QUAD))
    inside = rules.in_region_area(F.col("lng"), F.col("lat"), F.col("codes"), F.col("region"))
    return found.filter(inside)


def nearest_anchor(points: DataFrame, anchors: list[dict], radius_km: float = 60.0) -> DataFrame:
    """Nearest anchor by great-circle distance, with the reason why a point is dropped.

    Anchors are a parameter list of any length and become one literal array, so the
    job is a single pass without join or shuffle; ties go to the first of the list.
    """
    if not anchors:
        raise ValueError("no anchors")
    rows = json.dumps([{"lat": float(a["lat"]), "lng": float(a["lng"]), "slug": a["slug"]} for a in anchors])
    table = F.from_json(F.lit(rows), "array<struct<lat: double, lng: double, slug: string>>")
    usable = geo.valid_point(F.col("lng"), F.col("lat"))
    ranked = F.transform(
        table,
        lambda a, i: F.struct(
            geo.haversine_km(a["lat"], a["lng"], F.col("lat"), F.col("lng")).alias("km"), i.alias("i"), a["slug"].alias("slug")
        ),
    )
    best = F.when(usable, F.array_min(ranked))
    # made by a generator, so that columns and filters use the nearest anchor without working it out again
    found = points.select(*points.columns, F.inline_outer(F.array(F.struct(best.alias("best")))))
    return found.select(
        *points.columns,
        F.when(F.col("best.km") <= radius_km, F.col("best.slug")).alias("anchor"),
        F.col("best.km").alias("km"),
        F.when(~usable, "invalid coords").when(F.col("best.km") > radius_km, "no anchor within radius").alias("dropped"),
    )


def occupied_tiles(points: DataFrame, step: float = 0.5, pad: float = 0.01) -> DataFrame:
    """Padded boxes of the tiles that hold at least one point."""
    corners = points.select(geo.tile_of(F.col("lng"), step).alias("x"), geo.tile_of(F.col("lat"), step).alias("y")).distinct()
    return corners.select(
        (F.col("x") - pad).alias("w"),
        (F.col("y") - pad).alias("s"),
        (F.col("x") + step + pad).alias("e"),
        (F.col("y") + step + pad).alias("n"),
    )


def padded_box(points: DataFrame, keys: list[str], pad: float = 0.005) -> DataFrame:
    return points.groupBy(*keys).agg(
        (F.min("lng") - pad).alias("w"),
        (F.min("lat") - pad).alias("s"),
        (F.max("lng") + pad).alias("e"),
        (F.max("lat") + pad).alias("n"),
    )


def bounding_circle(points: DataFrame, keys: list[str], buffer_m: float = 500.0, least_m: float = 1000.0) -> DataFrame:
    """Centroid and covering radius per group: one pass for the mean, one for the farthest point."""
    centres = points.groupBy(*keys).agg(F.avg("lat").alias("centre_lat"), F.avg("lng").alias("centre_lng"))
    far = geo.haversine_m(F.col("centre_lat"), F.col("centre_lng"), F.col("lat"), F.col("lng"))
    return (
        points.join(centres, keys)
        .groupBy(*keys, "centre_lat", "centre_lng")
        .agg(F.max(far).alias("max_m"))
        .withColumn("radius_m", F.greatest(F.lit(least_m), F.floor(F.col("max_m") + buffer_m + F.lit(0.5)).cast("double")))
        .drop("max_m")
    )
