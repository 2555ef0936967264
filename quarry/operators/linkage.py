"""Single-linkage clusters cut at a distance, without listing the near pairs.

Points on the globe become points of the unit sphere, where great-circle distance grows
with the straight chord.  A grid whose cells have a diameter just under the cut contracts
all points of a cell to one vertex, so a dense spot costs one row however many points it
holds.  Two cells are linked if their closest points are near enough, and that is found
from boxes alone: the boxes around the points of two cells bound all their distances from
both sides.  Pairs that the bounds leave open are cut into their sub-cells of half the
width, level by level, until a link is found or every pair is ruled out; boxes of a single
place are measured exactly.  As soon as one pair of sub-cells links two cells, the rest of
their pairs is dropped.

Each level is one aggregation of the points in cells still open, and joins of one row per
sub-cell.  Clusters are the connected components of the cells.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.geo import EARTH_RADIUS_M, haversine
from quarry.operators.neighbors import connected_components
from quarry.session import cut_lineage

AXES = ("x", "y", "z")
LINKED, OPEN = 1, 0


def _cell(level: int, side: float) -> Column:
    return F.struct(*[F.floor(F.col(a) * (2.0 ** level / side)).cast("long").alias(a) for a in AXES])


def _boxes(places: DataFrame, level: int, side: float) -> DataFrame:
    """One row per cell of a level: the cell of level 0 it lies in, its parent and the box of its places."""
    parent = F.struct(*[F.shiftright(F.col(f"cell.{a}"), 1).alias(a) for a in AXES])
    box = F.struct(*[f(a).alias(f"{n}{a}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max))], F.min(F.struct("lat", "lon")).alias("at"))
    return places.withColumn("cell", _cell(level, side)).groupBy("home", "cell").agg(box.alias("box")) \
        .select("home", "cell", parent.alias("parent"), "box")


def _verdict(a: Column, b: Column, radius_m: float, chord: float, slack: float) -> Column:
    """LINKED, OPEN or null (farther apart) for two boxes."""
    def total(parts):
        return parts[0] + parts[1] + parts[2]
    gap = [F.greatest(a[f"lo{x}"] - b[f"hi{x}"], b[f"lo{x}"] - a[f"hi{x}"], F.lit(0.0)) for x in AXES]
    span = [F.greatest(a[f"hi{x}"] - b[f"lo{x}"], b[f"hi{x}"] - a[f"lo{x}"]) for x in AXES]
    near, far = F.sqrt(total([g * g for g in gap])), F.sqrt(total([s * s for s in span]))
    place = F.lit(True)
    for x in AXES:
        place = place & (a[f"lo{x}"] == a[f"hi{x}"]) & (b[f"lo{x}"] == b[f"hi{x}"])
    exact = haversine(a["at"]["lat"], a["at"]["lon"], b["at"]["lat"], b["at"]["lon"]) <= radius_m
    return F.when(place, F.when(exact, F.lit(LINKED))).when(far <= chord * (1 - slack), LINKED).when(near <= chord * (1 + slack), OPEN)


def cell_links(places: DataFrame, radius_m: float, chord: float, side: float, slack: float, seen: list[int] | None = None) -> DataFrame:
    """(a, b): linked cells of level 0.  ``seen`` collects how many pairs of boxes each level judged."""
    first = cut_lineage(_boxes(places, 0, side))
    reach = range(-2, 3)
    half = [(i, j, k) for i in reach for j in reach for k in reach if (i, j, k) > (0, 0, 0)]
    steps = F.explode(F.array(*[F.struct(*[F.lit(v).cast("long").alias(a) for a, v in zip(AXES, s)]) for s in half]))
    ahead = first.select(F.col("cell").alias("ha"), F.col("box").alias("ba"), steps.alias("s")) \
        .select("ha", "ba", F.struct(*[(F.col(f"ha.{a}") + F.col(f"s.{a}")).alias(a) for a in AXES]).alias("hb"))
    pairs = ahead.join(first.select(F.col("cell").alias("hb"), F.col("box").alias("bb")), "hb") \
        .select("ha", "hb", F.col("ha").alias("a"), F.col("hb").alias("b"), "ba", "bb")
    links, level = [], 0
    while True:
        judged = cut_lineage(pairs.withColumn("v", _verdict(F.col("ba"), F.col("bb"), radius_m, chord, slack)).select("ha", "hb", "a", "b", "v"))
        if seen is not None:
            seen.append(judged.count())
        links.append(judged.where(F.col("v") == LINKED).select("ha", "hb").distinct())
        todo = judged.where(F.col("v") == OPEN).join(links[-1], ["ha", "hb"], "left_anti").select("ha", "hb", "a", "b")
        todo = cut_lineage(todo)
        if todo.isEmpty():
            break
        live = todo.select(F.col("a").alias("up")).union(todo.select(F.col("b").alias("up"))).distinct()
        level += 1
        within = places.withColumn("up", _cell(level - 1, side)).join(live, "up", "left_semi")
        kids = cut_lineage(_boxes(within, level, side)).select("parent", "cell", "box")
        pairs = todo.join(kids.select(F.col("parent").alias("a"), F.col("cell").alias("na"), F.col("box").alias("ba")), "a") \
            .join(kids.select(F.col("parent").alias("b"), F.col("cell").alias("nb"), F.col("box").alias("bb")), "b") \
            .select("ha", "hb", F.col("na").alias("a"), F.col("nb").alias("b"), "ba", "bb")
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out.select(F.col("ha").alias("a"), F.col("hb").alias("b"))


def single_linkage_cut(points: DataFrame, id_col: str, lat: str, lon: str, radius_m: float, seen: list[int] | None = None) -> DataFrame:
    """(``id_col``, component): clusters of points chained by steps of at most ``radius_m``
    metres, named by their smallest id.  A point without finite coordinates stays alone;
    ids are unique.  ``radius_m`` is at least a millimetre."""
    if not radius_m >= 1e-3:
        raise ValueError("radius_m must be at least 0.001")
    chord = 2 * math.sin(min(radius_m / (2 * EARTH_RADIUS_M), math.pi / 2))
    slack = 1e-9 + 1e-14 / chord  # room for the rounding of coordinates
    side = chord / math.sqrt(3) * (1 - 2 * slack)
    la, lo = F.col(lat).cast("double"), F.col(lon).cast("double")
    on_globe = F.coalesce((F.abs(la) <= 90) & (F.abs(lo) < float("inf")), F.lit(False))
    p, q = F.radians("lat"), F.radians("lon")
    known = points.where(on_globe).select(F.col(id_col).alias("id"), la.alias("lat"), lo.alias("lon"))
    placed = known.withColumns({"x": F.cos(p) * F.cos(q), "y": F.cos(p) * F.sin(q), "z": F.sin(p)}).withColumn("home", _cell(0, side))
    placed = cut_lineage(placed)
    places = placed.select("lat", "lon", *AXES, "home").distinct()
    links = cell_links(places, radius_m, chord, side, slack, seen)
    cells = cut_lineage(placed.groupBy("home").agg(F.min("id").alias("v")))
    ends = links.join(cells.select(F.col("home").alias("a"), F.col("v").alias("src")), "a") \
        .join(cells.select(F.col("home").alias("b"), F.col("v").alias("dst")), "b").select("src", "dst")
    named = cells.join(connected_components(ends, cells.select("v")), "v").select("home", "component")
    alone = points.where(~on_globe).select(F.col(id_col), F.col(id_col).alias("component"))
    return placed.select("id", "home").join(named, "home").select(F.col("id").alias(id_col), "component").unionByName(alone)
