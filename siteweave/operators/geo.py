"""Joins and aggregates on points and polygons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteweave.functions.coords import EARTH_M, haversine_m
from siteweave.shared import written

#: Metres of a degree of latitude, rounded down so that a cell is never smaller than its radius.
DEGREE_M = 110_000.0


#: Points beyond which a cell is split when nearest points are searched, and how often a cell is split into 4 by 4.
CROWDED, SPLITS = 64, 7


def _band(lat: Column, high: float) -> Column:
    return F.floor(lat / high)


def _around(y: Column, high: float) -> Column:
    """Cells of a band of latitude: none narrower than the band is high, there or in the bands beside it."""
    edge = F.least(F.greatest(F.abs((y - 1) * high), F.abs((y + 2) * high)), F.lit(90.0))
    n = F.floor(F.lit(360.0) * F.cos(F.radians(edge)) / high)
    return F.when(n < 16, F.lit(1).cast("long")).otherwise(n)  # close to a pole, where arcs bend, one cell


def _turn(lon: Column, n: Column) -> Column:
    """The longitude as cells, with a fraction, from the 180th meridian."""
    return F.pmod(lon + 180.0, F.lit(360.0)) / 360.0 * n


def _spot(lon: Column, n: Column) -> Column:
    return F.least(F.floor(_turn(lon, n)), n - 1)


def near_join(left: DataFrame, right: DataFrame, radius_m: float, lat: str = "lat", lon: str = "lon", rlat: str = "rlat", rlon: str = "rlon", distance: str = "dist_m") -> DataFrame:
    """Pairs of rows within a radius: an equi join on grid cells no smaller than the radius, the right side in its nine
    neighbours, then the true distance. Points with nulls meet nothing.

    Cells lie in bands of latitude; each band is cut into as many cells as its narrowest parallel allows, around the globe, so
    the join is right at every latitude and across the 180th meridian.
    """
    high = radius_m / DEGREE_M
    here = left.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumn("cell_y", _band(F.col(lat), high))
    here = here.withColumn("cell_x", _spot(F.col(lon), _around(F.col("cell_y"), high)))
    rows = right.where(F.col(rlat).isNotNull() & F.col(rlon).isNotNull()).withColumn("_band", _band(F.col(rlat), high))
    rows = rows.withColumn("cell_y", F.explode(F.array(*(F.col("_band") + k for k in (-1, 0, 1))))).withColumn("_n", _around(F.col("cell_y"), high)).withColumn("_x", _spot(F.col(rlon), F.col("_n")))
    there = rows.withColumn("cell_x", F.explode(F.array_distinct(F.array(*(F.pmod(F.col("_x") + k, F.col("_n")) for k in (-1, 0, 1)))))).drop("_band", "_n", "_x")
    met = here.join(there, ["cell_y", "cell_x"]).withColumn(distance, haversine_m(F.col(lat), F.col(lon), F.col(rlat), F.col(rlon)))
    return met.where(F.col(distance) <= radius_m).drop("cell_y", "cell_x")


def nearest(left: DataFrame, right: DataFrame, key: str, radius_m: float, order: str, k: int = 1, lat: str = "lat", lon: str = "lon", rlat: str = "rlat", rlon: str = "rlon", distance: str = "dist_m") -> DataFrame:
    """The k nearest rows of the right side within a radius for each key of the left, numbered by near_rank; ties by `order`.

    Where cells of the radius hold more than CROWDED points, they are split as far as points crowd, and each place of the left
    side goes down through them: the k-th distance is at most that of the cells' far corners that hold k points together, or of
    the finest cell around the place that holds k alone, and cells whose near side is farther are left, most of them before they
    are moved. Only points of the cells that remain are compared, so a crowded cell costs each place about k points and not all
    of them; of points in one spot the first k count. Points with nulls meet nothing.
    """
    high = radius_m / DEGREE_M
    there = right.where(F.col(rlat).isNotNull() & F.col(rlon).isNotNull()).withColumn("_by", _band(F.col(rlat), high)).withColumn("_n", _around(F.col("_by"), high)).withColumn("_bx", _spot(F.col(rlon), F.col("_n")))
    full = written(there.groupBy("_by", "_bx").count().where(F.col("count") > CROWDED).select("_by", "_bx", F.lit(True).alias("_hot")), "crowded")
    if full.isEmpty():
        met = near_join(left, right, radius_m, lat, lon, rlat, rlon, distance)
    else:
        met = _met_in_crowds(left.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()), there.join(full, ["_by", "_bx"], "left"), radius_m, order, k, lat, lon, rlat, rlon, distance)
    rank = F.row_number().over(Window.partitionBy(key).orderBy(distance, order))
    return met.withColumn("near_rank", rank).where(F.col("near_rank") <= k)


def _met_in_crowds(left: DataFrame, there: DataFrame, radius_m: float, order: str, k: int, lat: str, lon: str, rlat: str, rlon: str, distance: str) -> DataFrame:
    """Pairs within the radius that hold the k nearest rows for each place of the left side."""
    high, fine = radius_m / DEGREE_M, 4**SPLITS
    part = lambda x: F.least(F.greatest(F.floor(x * fine), F.lit(0)), F.lit(fine - 1)).cast("long")
    first = F.row_number().over(Window.partitionBy(rlat, rlon).orderBy(order))
    there = there.withColumn("_first", first).where(F.col("_first") <= k)
    there = there.withColumns({"_iy": part(F.col(rlat) / high - F.col("_by")), "_ix": part(_turn(F.col(rlon), F.col("_n")) - F.col("_bx"))}).drop("_first", "_n")
    levels = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SPLITS))).otherwise(F.array(F.lit(0)))
    at = lambda i: F.floor(F.col(i) / F.pow(F.lit(4), SPLITS - F.col("_m"))).cast("long")
    dealt = there.withColumn("_m", F.explode(levels)).withColumns({"_cy": at("_iy"), "_cx": at("_ix")}).drop("_iy", "_ix", "_hot")
    cell = ["_by", "_bx", "_m", "_cy", "_cx"]
    box = (F.min(rlat).alias("_s"), F.max(rlat).alias("_t"), F.min(rlon).alias("_u"), F.max(rlon).alias("_v"))
    cells = written(dealt.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"), *box).withColumn("_more", (F.col("_n") > CROWDED) & (F.col("_m") < SPLITS)), "cells")

    # Bounds of the distance to a box: gaps of latitude and longitude, with the smallest and largest cosine in it.
    turn = lambda x: F.pmod(x, F.lit(360.0))
    inside = F.col("_plon").between(F.col("_u"), F.col("_v"))
    gap = F.when(inside, 0.0).otherwise(F.least(turn(F.col("_u") - F.col("_plon")), turn(F.col("_plon") - F.col("_v"))))
    far = F.least(gap + F.col("_v") - F.col("_u"), F.lit(180.0))
    rise = F.greatest(F.col("_s") - F.col("_plat"), F.col("_plat") - F.col("_t"), F.lit(0.0))
    reach = F.greatest(F.abs(F.col("_s") - F.col("_plat")), F.abs(F.col("_t") - F.col("_plat")))
    cos = lambda x: F.cos(F.radians(x))
    widest = F.when((F.col("_s") <= 0) & (F.col("_t") >= 0), 1.0).otherwise(F.greatest(cos(F.col("_s")), cos(F.col("_t"))))
    half = lambda x: F.pow(F.sin(F.radians(x) / 2), 2)
    metres = lambda dy, dx, c: 2 * EARTH_M * F.asin(F.sqrt(F.least(half(dy) + cos(F.col("_plat")) * c * half(dx), F.lit(1.0))))
    lowest, highest = metres(rise, gap, F.least(cos(F.col("_s")), cos(F.col("_t")))), metres(reach, far, widest)
    # A first bound from the cells that the place itself lies in and that hold k points; the finest of them leaves few cells.
    spots = left.select(F.col(lat).alias("_plat"), F.col(lon).alias("_plon"))
    home = spots.distinct().withColumn("_by", _band(F.col("_plat"), high)).withColumn("_a", _around(F.col("_by"), high)).withColumn("_bx", _spot(F.col("_plon"), F.col("_a")))
    home = home.withColumns({"_iy": part(F.col("_plat") / high - F.col("_by")), "_ix": part(_turn(F.col("_plon"), F.col("_a")) - F.col("_bx")), "_m": F.explode(F.sequence(F.lit(0), F.lit(SPLITS)))})
    home = home.withColumns({"_cy": at("_iy"), "_cx": at("_ix")}).join(cells.where(F.col("_n") >= k), cell).select("_plat", "_plon", highest.alias("_best"))
    spots = written(spots.withColumn("_best", F.lit(float(radius_m))).unionByName(home).groupBy("_plat", "_plon").agg(F.min("_best").alias("_best")), "spots")
    within = lambda d: d.where(lowest <= F.col("_best") * (1 + 1e-9) + 1e-6)

    bands = F.explode(F.array(*(_band(F.col("_plat"), high) + d for d in (-1, 0, 1))))
    beside = F.transform(F.array(*(F.lit(d) for d in (-1, 0, 1))), lambda d: F.pmod(_spot(F.col("_plon"), F.col("_a")) + d, F.col("_a")))
    around = spots.withColumn("_by", bands).withColumn("_a", _around(F.col("_by"), high))
    found = within(around.withColumn("_bx", F.explode(F.array_distinct(beside))).drop("_a").join(cells.where("_m = 0"), ["_by", "_bx"]))

    place = Window.partitionBy("_plat", "_plon")
    held = F.sum("_n").over(place.orderBy("_hi"))

    for _ in range(SPLITS + 1):
        sized = found.withColumn("_hi", highest).withColumn("_held", held)
        bound = F.least(F.min(F.when(F.col("_held") >= k, F.col("_hi"))).over(place), F.col("_best"))
        kept = written(within(sized.withColumn("_best", bound)).drop("_hi", "_held"), "near")
        split = kept.where("_more")
        if split.isEmpty():
            break
        below = cells.withColumns({"_py": F.floor(F.col("_cy") / 4), "_px": F.floor(F.col("_cx") / 4)})
        down = split.select("_plat", "_plon", "_best", "_by", "_bx", (F.col("_m") + 1).alias("_m"), F.col("_cy").alias("_py"), F.col("_cx").alias("_px")).join(below, ["_by", "_bx", "_m", "_py", "_px"])
        found = kept.where("not _more").unionByName(within(down.select(*kept.columns)))

    d = haversine_m(F.col("_plat"), F.col("_plon"), F.col(rlat), F.col(rlon))
    close = kept.select("_plat", "_plon", *cell).join(dealt, cell).withColumn(distance, d).where(F.col(distance) <= radius_m).drop(*cell)
    top = close.withColumn("_n", F.row_number().over(place.orderBy(distance, order))).where(F.col("_n") <= k).drop("_n")
    return left.join(top, (F.col(lat) == F.col("_plat")) & (F.col(lon) == F.col("_plon"))).drop("_plat", "_plon")


def _edges(ring: Column) -> Column:
    """Edges of a ring of (x, y) structs as structs of two ends; the ring closes itself."""
    n = F.size(ring)
    after = lambda k: F.get(ring, (k + 1) % n)
    return F.transform(ring, lambda p, k: F.struct(p["x"].alias("ax"), p["y"].alias("ay"), after(k)["x"].alias("bx"), after(k)["y"].alias("by")))


def _crossings(ring: Column, x: Column, y: Column) -> Column:
    over = lambda e: ((e["ay"] > y) != (e["by"] > y)) & (x < (e["bx"] - e["ax"]) * (y - e["ay"]) / F.when(e["by"] == e["ay"], 1.0).otherwise(e["by"] - e["ay"]) + e["ax"])
    return F.aggregate(_edges(ring), F.lit(0), lambda s, e: s + over(e).cast("int"))


def in_ring(ring: Column, x: Column, y: Column) -> Column:
    """Ray casting with half-open edges."""
    return _crossings(ring, x, y) % 2 == 1


def covered(rings: Column, x: Column, y: Column) -> Column:
    """Inside the first ring and outside the others, or on an edge of any."""
    on = lambda e: ((e["bx"] - e["ax"]) * (y - e["ay"]) == (e["by"] - e["ay"]) * (x - e["ax"])) & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])) & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))
    edge = F.exists(rings, lambda r: F.exists(_edges(r), on))
    holes = F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
    return edge | (in_ring(F.get(rings, F.lit(0)), x, y) & ~F.exists(holes, lambda r: in_ring(r, x, y)))


#: How often cells on the border of a polygon are split into 4 by 4.
BORDER_SPLITS = 2


def _touches(e: Column, x: Column, y: Column, size: Column) -> Column:
    """Whether an edge meets a cell, or comes as close to it as rounding may hide."""
    pad = size * 1e-6
    x0, x1, y0, y1 = x * size - pad, (x + 1) * size + pad, y * size - pad, (y + 1) * size + pad
    side = lambda a, b: F.signum((e["bx"] - e["ax"]) * (b - e["ay"]) - (e["by"] - e["ay"]) * (a - e["ax"]))
    corners = side(x0, y0) + side(x0, y1) + side(x1, y0) + side(x1, y1)
    boxes = (F.least(e["ax"], e["bx"]) <= x1) & (F.greatest(e["ax"], e["bx"]) >= x0) & (F.least(e["ay"], e["by"]) <= y1) & (F.greatest(e["ay"], e["by"]) >= y0)
    return boxes & (F.abs(corners) < 4)


def polygon_cells(polygons: DataFrame, test) -> DataFrame:
    """The cells (_level, _x, _y, sides of 2 ** _level degrees) that cover each polygon (rings, ...): three by three of about half
    its extent, those on its border split again into 4 by 4, BORDER_SPLITS times. _inner tells the cells that no edge meets and that
    `test` takes whole; they carry no rings. The number of cells grows with the length of the border, not with the area."""
    xs, ys = F.flatten(F.transform("rings", lambda r: r["x"])), F.flatten(F.transform("rings", lambda r: r["y"]))
    span = F.greatest(F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys), F.lit(1e-6))
    level = (2 * F.ceil(F.log2(span / 2) / 2)).cast("int")
    size = F.pow(F.lit(2.0), F.col("_level"))
    over = lambda v: F.sequence(F.floor(F.array_min(v) / size).cast("long"), F.floor(F.array_max(v) / size).cast("long"))
    out = polygons.withColumn("_level", level).withColumn("_x", F.explode(over(xs))).withColumn("_y", F.explode(over(ys))).withColumn("_e", F.flatten(F.transform("rings", _edges)))
    for k in range(BORDER_SPLITS + 1):
        out = out.withColumn("_e", F.filter("_e", lambda e: _touches(e, F.col("_x"), F.col("_y"), size)))
        out = out.withColumn("_inner", F.when(F.size("_e") == 0, test(F.col("rings"), (F.col("_x") + 0.5) * size, (F.col("_y") + 0.5) * size)).otherwise(False))
        out = out.where(F.col("_inner") | (F.size("_e") > 0))
        if k < BORDER_SPLITS:
            one = lambda lv, x, y: F.struct(lv.cast("int").alias("l"), x.cast("long").alias("x"), y.cast("long").alias("y"))
            parts = F.array(*(one(F.col("_level") - 2, F.col("_x") * 4 + i, F.col("_y") * 4 + j) for i in range(4) for j in range(4)))
            out = out.withColumn("_c", F.explode(F.when(F.col("_inner"), F.array(one(F.col("_level"), F.col("_x"), F.col("_y")))).otherwise(parts)))
            out = out.withColumns({"_level": F.col("_c.l"), "_x": F.col("_c.x"), "_y": F.col("_c.y")}).drop("_c")
    return out.withColumn("rings", F.when(~F.col("_inner"), F.col("rings"))).drop("_e")


def containing(points: DataFrame, polygons: DataFrame, key: str, test, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """The first polygon (by pos) that holds each point: polygons (pos, rings, ...) are dealt to the cells of polygon_cells(), points
    to the cell of each size in use; `test(rings, x, y)` decides in border cells only. Points outside all polygons are left out.
    `test` must not change its answer away from the rings' edges."""
    cover = written(polygon_cells(polygons, test), "cover")
    levels = sorted(r[0] for r in cover.select("_level").distinct().collect())  # sizes of cells: a few dozen at most
    if not levels:
        levels = [0]
    size = F.pow(F.lit(2.0), F.col("_level"))
    placed = points.withColumn("_level", F.explode(F.array(*(F.lit(n) for n in levels)))).withColumns({"_x": F.floor(F.col(lon) / size), "_y": F.floor(F.col(lat) / size)})
    met = placed.join(cover, ["_level", "_x", "_y"]).where(F.col("_inner") | test(F.col("rings"), F.col(lon), F.col(lat)))
    first = F.row_number().over(Window.partitionBy(key).orderBy("pos"))
    return met.withColumn("_n", first).where("_n = 1").drop("_n", "_level", "_x", "_y", "_inner", "rings")


def robust_centroid(points: DataFrame, key: str, stray_m: float = 75.0) -> DataFrame:
    """For each key: the mean of the points within stray_m of their median (the median itself if none is), how many they are,
    and the largest distance from it in metres."""
    middle = points.groupBy(key).agg(F.percentile("lat", 0.5).alias("mlat"), F.percentile("lon", 0.5).alias("mlon"))
    close = points.join(middle, key).where(haversine_m(F.col("lat"), F.col("lon"), F.col("mlat"), F.col("mlon")) <= stray_m)
    mean = close.groupBy(key).agg(F.avg("lat").alias("clat"), F.avg("lon").alias("clon"), F.count(F.lit(1)).alias("n"))
    spread = close.join(mean, key).groupBy(key).agg(F.max(haversine_m(F.col("lat"), F.col("lon"), F.col("clat"), F.col("clon"))).alias("spread"))
    out = middle.join(mean, key, "left").join(spread, key, "left")
    return out.select(key, F.round(F.coalesce("clat", "mlat"), 6).alias("lat"), F.round(F.coalesce("clon", "mlon"), 6).alias("lon"), F.coalesce("n", F.lit(1).cast("long")).alias("n"), F.round(F.coalesce("spread", F.lit(0.0)), 1).alias("spread_m"))
