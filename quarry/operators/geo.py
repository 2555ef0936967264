"""Table-level geospatial operators.

Radius joins are exact and never compare every point with every site:
points are keyed by (latitude band, longitude cell) where the band height
is the search radius in degrees and each band's longitude cell width is
widened by 1/cos(latitude) at the band's pole-ward edge, so a circle of the
radius spans at most 3 bands x 3 cells.  Sites are exploded to the cells
their circle may touch (with wrap-around at +-180), equi-joined, and the
haversine distance is the exact residual filter.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.geo import EARTH_RADIUS_M, haversine

#: Places of sites that a cell of the first radius may hold.
CELL_SITES = 64


def bounding_box(df: DataFrame, lat: str, lon: str, lat_min: float, lat_max: float,
                 lon_min: float, lon_max: float) -> DataFrame:
    return df.where(F.col(lat).between(lat_min, lat_max) & F.col(lon).between(lon_min, lon_max))


def step_distance(df: DataFrame, by: Sequence[str], order: Sequence[str], lat: str, lon: str,
                  name: str = "step_m", skew_safe: bool = True) -> DataFrame:
    """Distance from the previous point of the same track.  ``skew_safe``
    takes the previous point by a (track, position) join so one huge track
    is not a single task."""
    if skew_safe:
        from quarry.operators.windows import shifted
        s = shifted(df.withColumn("_ll", F.struct(F.col(lat).alias("a"), F.col(lon).alias("o"))), list(by), list(order),
                    "_ll", 1, "_prev")
        return s.withColumn(name, haversine(F.col("_prev.a"), F.col("_prev.o"), F.col(lat), F.col(lon))) \
            .drop("_ll", "_prev", "_pos")
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, haversine(F.lag(lat).over(w), F.lag(lon).over(w), F.col(lat), F.col(lon)))


def track_distance(df: DataFrame, by: Sequence[str], order: Sequence[str], lat: str, lon: str,
                   name: str = "cum_m", skew_safe: bool = True) -> DataFrame:
    """Cumulative distance along each track (skew-safe running sum)."""
    s = step_distance(df, by, order, lat, lon, "_step", skew_safe)
    if skew_safe:
        from quarry.operators.windows import running_sums
        return running_sums(s, list(by), list(order), {name: F.coalesce("_step", F.lit(0.0))}).drop("_step")
    w = Window.partitionBy(*by).orderBy(*order)
    return s.withColumn(name, F.sum(F.coalesce("_step", F.lit(0.0))).over(w.rowsBetween(Window.unboundedPreceding, 0))) \
        .drop("_step")


def _band(lat: Column, dlat: float) -> Column:
    return F.floor((lat + 90.0) / dlat).cast("long")


def _cells_in_band(band: Column, dlat: float) -> tuple[Column, Column]:
    """(cell width in degrees of longitude, number of cells) for a band."""
    edge = F.least(F.greatest(F.abs(band * dlat - 90.0), F.abs((band + 1) * dlat - 90.0)), F.lit(89.999))
    w = F.least(F.lit(360.0), F.lit(dlat) / F.cos(F.radians(edge)))
    n = F.greatest(F.floor(360.0 / w), F.lit(1)).cast("long")
    return F.lit(360.0) / n, n


def radius_join(points: DataFrame, plat: str, plon: str, sites: DataFrame, slat: str, slon: str,
                radius_m: float, name: str = "dist_m") -> DataFrame:
    """All (point, site) pairs within ``radius_m`` metres (exact)."""
    dlat = min(180.0, math.degrees(radius_m / EARTH_RADIUS_M) * 1.0001)
    pb = _band(F.col(plat), dlat)
    pw, pn = _cells_in_band(pb, dlat)
    p = points.withColumn("_band", pb).withColumn(
        "_cell", F.pmod(F.floor((F.col(plon) + 180.0) / pw).cast("long"), pn))
    sb = _band(F.col(slat), dlat)
    s = sites.withColumn("_band", F.explode(F.sequence(F.greatest(sb - 1, F.lit(0)), sb + 1)))
    w, n = _cells_in_band(F.col("_band"), dlat)
    c = F.floor((F.col(slon) + 180.0) / w).cast("long")
    s = s.withColumn("_cell", F.explode(F.array_distinct(F.transform(
        F.sequence(c - 1, c + 1), lambda x: F.pmod(x, n)))))
    j = p.join(s, on=["_band", "_cell"]).drop("_band", "_cell")
    d = haversine(F.col(plat), F.col(plon), F.col(slat), F.col(slon))
    return j.withColumn(name, d).where(F.col(name) <= radius_m)


def nearest_site(points: DataFrame, pid: str, plat: str, plon: str, sites: DataFrame, sid: str, slat: str,
                 slon: str, start_radius_m: float | None = None, growth: float = 4.0) -> DataFrame:
    """Nearest site per point (ties: smallest site id), exact.

    Ring search over places: of the sites at one place only that with the
    smallest id can be nearest, and points at one place have one answer.  A
    radius join at r; places with a site inside r are settled (the nearest
    site is within r); the rest retry at growth x r until r covers the globe.
    No point is compared with all sites unless the sites are that far away.
    The first radius defaults to the typical spacing R * sqrt(4 pi / n) of n
    sites, lowered until no cell of that size holds over ``CELL_SITES``."""
    from quarry.session import cut_lineage
    out = None
    at = cut_lineage(sites.select(sid, F.col(slat).alias("_slat"), F.col(slon).alias("_slon")).groupBy("_slat", "_slon")
                     .agg(F.min(F.struct(sid))[sid].alias(sid)))
    todo = points.select(F.col(plat).alias("_plat"), F.col(plon).alias("_plon")).na.drop().distinct()
    if start_radius_m is None:
        start_radius_m = EARTH_RADIUS_M * math.sqrt(4 * math.pi / max(at.count(), 1))
        while start_radius_m > 1 and (_fullest_cell(at, start_radius_m) or 0) > CELL_SITES:
            start_radius_m /= growth
    r = start_radius_m
    max_r = math.pi * EARTH_RADIUS_M * 1.01
    while True:
        pairs = radius_join(todo, "_plat", "_plon", at, "_slat", "_slon", r)
        best = cut_lineage(pairs.groupBy("_plat", "_plon").agg(F.min(F.struct(F.col("dist_m"), F.col(sid))).alias("_b")))
        out = best if out is None else out.unionByName(best)
        if r >= max_r:
            break
        todo = cut_lineage(todo.join(best.select("_plat", "_plon"), on=["_plat", "_plon"], how="left_anti"))
        if todo.limit(1).count() == 0:
            break
        r = min(r * growth, max_r)
    mine = points.select(pid, F.col(plat).alias("_plat"), F.col(plon).alias("_plon")).join(out, ["_plat", "_plon"])
    return mine.groupBy(pid).agg(F.min("_b").alias("_b")).select(pid, F.col("_b")[sid].alias(sid), F.col("_b")["dist_m"].alias("dist_m"))


def _fullest_cell(at: DataFrame, radius_m: float) -> int | None:
    """Places in the fullest cell of ``radius_m``."""
    dlat = min(180.0, math.degrees(radius_m / EARTH_RADIUS_M) * 1.0001)
    w, n = _cells_in_band(F.col("_band"), dlat)
    return at.na.drop(subset=["_slat", "_slon"]).withColumn("_band", _band(F.col("_slat"), dlat)) \
        .groupBy("_band", F.pmod(F.floor((F.col("_slon") + 180.0) / w).cast("long"), n).alias("_cell")) \
        .count().agg(F.max("count")).first()[0]
