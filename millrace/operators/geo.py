"""Points on the globe: distances, grid cells, radius joins and density."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut, drop_cut

# fixed values
EARTH_KM = 6371
ELLIPSOID_RADIUS = 6378137.0
ELLIPSOID_ECCENTRICITY = 0.00669342162296594323
CHINA_BOX = {"lng": (72.004, 137.8347), "lat": (0.8293, 55.8271)}
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
# fixed values: compass bearing of N, NE, E, SE, S, SW, W, NW
HEADINGS = [0, 45, 90, 135, 180, 225, 270, 315]

METRES_PER_DEGREE = EARTH_KM * 1000 * math.pi / 180


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in metres."""
    dlat, dlng = F.radians(lat2 - lat1) / 2, F.radians(lng2 - lng1) / 2
    a = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlng) * F.sin(dlng)
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * 2 * EARTH_KM * 1000


def destination(lat: Column, lng: Column, bearing: Column, metres: Column) -> tuple[Column, Column]:
    """Point reached from (lat, lng) along a bearing."""
    arc, way = metres / (EARTH_KM * 1000), F.radians(bearing)
    p = F.radians(lat)
    lat2 = F.asin(F.sin(p) * F.cos(arc) + F.cos(p) * F.sin(arc) * F.cos(way))
    lng2 = F.radians(lng) + F.atan2(F.sin(way) * F.sin(arc) * F.cos(p), F.cos(arc) - F.sin(p) * F.sin(lat2))
    return F.degrees(lat2), F.degrees(lng2)


def _unit(lat: Column, lng: Column) -> list[Column]:
    p, q = F.radians(lat), F.radians(lng)
    return [F.cos(p) * F.cos(q), F.cos(p) * F.sin(q), F.sin(p)]


def _cube(lat: Column, lng: Column, edge: float) -> list[Column]:
    """Cell of a point on the unit sphere in a grid of cubes; it knows no pole and no date line."""
    return [F.floor(c / edge) for c in _unit(lat, lng)]


# Candidate pairs that one task of a radius join compares, about.
TASK_PAIRS = 2_000_000
# Places of one finest cell that a search compares one by one, and most halvings of a cell.
LEAF_PLACES, MOST_LEVELS = 32, 30
STEPS = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]


def _edge(metres: float) -> float:
    """Chord of a radius on the unit sphere, the edge of the cubes that points look around in."""
    return max(2 * math.sin(min(metres / (EARTH_KM * 2000), math.pi / 2)) * (1 + 1e-9), 1e-12)


def _around(points: DataFrame, columns: list[str], edge: float) -> DataFrame:
    """(columns.., _plat, _plng, _x, _y, _z): each point once per cube around its own."""
    x, y, z = _cube(F.col("lat"), F.col("lng"), edge)
    steps = F.array(*[F.struct(*[F.lit(d).alias(n) for n, d in zip("ijk", step)]) for step in STEPS])
    near = points.select(*columns, F.col("lat").alias("_plat"), F.col("lng").alias("_plng"), x.alias("_x0"), y.alias("_y0"), z.alias("_z0"), F.explode(steps).alias("_s"))
    return near.select(*columns, "_plat", "_plng", (F.col("_x0") + F.col("_s.i")).alias("_x"), (F.col("_y0") + F.col("_s.j")).alias("_y"), (F.col("_z0") + F.col("_s.k")).alias("_z"))


def pairs_within(points: DataFrame, places: DataFrame, metres: float) -> DataFrame:
    """(point_id, place columns.., distance) for all places within the radius.

    Both sides meet in cubes whose edge is the chord of the radius; a point looks into the
    27 cubes around its own, of which the sphere's surface crosses about nine. The pairs of a
    cube are counted before they are made: points of a crowded cube are dealt to parts, and
    as many tasks share all parts as the pairs need, however few files the points come from.
    """
    edge = _edge(metres)
    near = _around(points, ["point_id"], edge)
    x, y, z = _cube(F.col("lat"), F.col("lng"), edge)
    placed = places.withColumns({"_x": x, "_y": y, "_z": z})
    cell = ["_x", "_y", "_z"]
    crowds = near.groupBy(*cell).agg(F.count("*").alias("_points")).join(placed.groupBy(*cell).agg(F.count("*").alias("_places")), cell)
    crowds = cut(crowds.select(*cell, "_places", (F.col("_points") * F.col("_places")).alias("_pairs")))
    total = crowds.agg(F.sum("_pairs")).first()[0] or 0
    parts = F.ceil(F.col("_pairs") / TASK_PAIRS).cast("int")
    dealt = near.join(crowds.select(*cell, parts.alias("_parts")), cell).withColumn("_part", F.pmod(F.xxhash64("point_id", "_plat", "_plng"), F.col("_parts")))
    dealt = dealt.repartition(min(1 + total // TASK_PAIRS * 2, 100_000), *cell, "_part").drop("_part", "_parts")
    joined = dealt.join(placed, cell)
    distance = haversine(F.col("_plat"), F.col("_plng"), F.col("lat"), F.col("lng"))
    return joined.withColumn("distance", distance).where(F.col("distance") <= metres).drop("_x", "_y", "_z", "_plat", "_plng")


def radius_join(points: DataFrame, places: DataFrame, metres: float) -> DataFrame:
    """All (point, place, distance); points without a place keep one row with NULLs."""
    pairs = cut(pairs_within(points, places, metres).select("point_id", "place_id", "distance"))
    alone = points.select("point_id").join(pairs, "point_id", "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True)


def nearest_within(points: DataFrame, roads: DataFrame, metres: float) -> DataFrame:
    """(lat, lng, near: struct of distance, place_id and heading) of the points that have a road within the radius.

    Cubes are halved until few roads share one. A point starts with the cubes of the radius
    join and goes down: one road of each cube tells how far the nearest can be at most, and
    cubes that cannot reach into that distance are left. The roads of the last cubes are
    measured one by one, so crowds farther away are never met.
    """
    edge, spot, cell = _edge(metres), ["_plat", "_plng"], ["_x", "_y", "_z"]
    known = roads.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).groupBy("lat", "lng").agg(F.min(F.struct("place_id", "heading")).alias("first"))
    cubes = [c / edge for c in _unit(F.col("lat"), F.col("lng"))]
    at = lambda level: [F.floor(c * float(1 << level)).alias(n) for c, n in zip(cubes, cell)]
    known, levels = cut(known), 0
    while levels < MOST_LEVELS and (known.groupBy(*at(levels)).count().agg(F.max("count")).first()[0] or 0) > LEAF_PLACES:
        levels += 2

    def within(found: DataFrame, level: int) -> DataFrame:
        """Of the cubes with one road each, those that may hold the nearest; half a millimetre for rounding."""
        span = 2000 * EARTH_KM * math.asin(min(1.0, math.sqrt(3) * edge / (1 << level) / 2)) * (1 + 1e-9) + 5e-4
        far = found.withColumn("_d", haversine(F.col("_plat"), F.col("_plng"), F.col("rep.lat"), F.col("rep.lng")))
        bound = F.least(F.min("_d").over(Window.partitionBy(*spot)), F.lit(float(metres)))
        return far.withColumn("_bound", bound).where(F.col("_d") - span <= F.col("_bound")).select(*spot, *cell)

    nodes = lambda level: known.groupBy(*at(level)).agg(F.min(F.struct("lat", "lng")).alias("rep"))
    asked = points.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).select("lat", "lng").distinct()
    front = cut(within(_around(asked, [], edge).join(nodes(0), cell), 0))
    for level in range(1, levels + 1):
        up = [F.shiftright(c, 1).alias(f"{c}0") for c in cell]
        children = nodes(level).select("rep", *cell, *up)
        held = front
        front = cut(within(held.withColumnsRenamed({c: f"{c}0" for c in cell}).join(children, [f"{c}0" for c in cell]), level))
        drop_cut(held)
    last = front.join(known.select(*at(levels), "lat", "lng", "first"), cell)
    distance = haversine(F.col("_plat"), F.col("_plng"), F.col("lat"), F.col("lng"))
    near = F.struct("distance", F.col("first.place_id").alias("place_id"), F.col("first.heading").alias("heading"))
    return last.withColumn("distance", distance).where(F.col("distance") <= metres).groupBy(F.col("_plat").alias("lat"), F.col("_plng").alias("lng")).agg(F.min(near).alias("near"))


def snap_to_nearest(points: DataFrame, roads: DataFrame, metres: float) -> DataFrame:
    """Move each point by its distance to the nearest road, against the road's heading."""
    found = nearest_within(points, roads, metres)
    nearest = points.select("point_id", "lat", "lng").join(found, ["lat", "lng"]).groupBy("point_id").agg(F.min("near").alias("near"))
    bearing = F.element_at(F.array(*[F.lit((b + 180) % 360) for b in HEADINGS]), F.col("near.heading") + 1)
    lat, lng = destination(F.col("lat"), F.col("lng"), bearing, F.col("near.distance"))
    return points.join(nearest, "point_id", "left").select(
        "point_id", F.col("near.place_id").alias("road_id"),
        F.when(F.col("near").isNull(), F.col("lat")).otherwise(lat).alias("lat"),
        F.when(F.col("near").isNull(), F.col("lng")).otherwise(lng).alias("lng"))


def _shift(x: Column, y: Column) -> tuple[Column, Column]:
    """Published GCJ-02 offset polynomial; the coefficients are fixed values."""
    wave = lambda v, scale, period: F.sin(v * math.pi / period) * scale
    common = wave(x, 20.0, 1 / 6.0) + wave(x, 20.0, 0.5)
    root = F.sqrt(F.abs(x))
    lat_waves = common + wave(y, 20.0, 1.0) + wave(y, 40.0, 3.0) + wave(y, 160.0, 12.0) + wave(y, 320.0, 30.0)
    lng_waves = common + wave(x, 20.0, 1.0) + wave(x, 40.0, 3.0) + wave(x, 150.0, 12.0) + wave(x, 300.0, 30.0)
    lat = lat_waves * (2 / 3) + x * 2.0 + y * 3.0 + y * y * 0.2 + x * y * 0.1 + root * 0.2 - 100.0
    lng = lng_waves * (2 / 3) + x + y * 2.0 + x * x * 0.1 + x * y * 0.1 + root * 0.1 + 300.0
    return lat, lng


def to_wgs84(lat: Column, lng: Column) -> tuple[Column, Column]:
    """GCJ-02 to WGS-84; points outside the China box are unchanged."""
    east, north = _shift(lng - 105.0, lat - 35.0)[::-1]
    phi = F.radians(lat)
    bulge = 1 - F.sin(phi) * F.sin(phi) * ELLIPSOID_ECCENTRICITY
    dlat = F.degrees(north / (ELLIPSOID_RADIUS * (1 - ELLIPSOID_ECCENTRICITY) / (bulge * F.sqrt(bulge))))
    dlng = F.degrees(east / (ELLIPSOID_RADIUS / F.sqrt(bulge) * F.cos(phi)))
    inside = lng.between(*CHINA_BOX["lng"]) & lat.between(*CHINA_BOX["lat"])
    return F.when(inside, lat - dlat).otherwise(lat), F.when(inside, lng - dlng).otherwise(lng)


def geohash(lat: Column, lng: Column, precision: int) -> Column:
    """Geohash text: longitude and latitude bits interleaved, five bits per character."""
    bits = 5 * precision
    lng_bits, lat_bits = (bits + 1) // 2, bits // 2
    x = F.floor((lng + 180) / 360 * (1 << lng_bits))
    y = F.floor((lat + 90) / 180 * (1 << lat_bits))
    letters = []
    for c in range(precision):
        index = F.lit(0).cast("bigint")
        for b in range(5 * c, 5 * c + 5):
            source, width = (x, lng_bits) if b % 2 == 0 else (y, lat_bits)
            index = index * 2 + F.shiftright(source, width - 1 - b // 2).bitwiseAND(F.lit(1).cast("bigint"))
        letters.append(F.substring(F.lit(GEOHASH_ALPHABET), index.cast("int") + 1, F.lit(1)))
    return F.concat(*letters)


def cell_density(points: DataFrame, precision: int) -> DataFrame:
    lat, lng = to_wgs84(F.col("lat"), F.col("lng"))
    placed = points.select(lat.alias("wlat"), lng.alias("wlng"))
    return placed.groupBy(geohash(F.col("wlat"), F.col("wlng"), precision).alias("cell")).agg(F.count("*").alias("n"))


def grid_cell(value: Column, start: float, step: float) -> Column:
    return F.floor((value - start) / step)


def grid_lookup(points: DataFrame, cells: DataFrame, x0: float, y0: float, step: float) -> DataFrame:
    """Covariates of the grid cell each point falls in; NULL where the grid has no cell."""
    located = points.withColumn("ix", grid_cell(F.col("lng"), x0, step)).withColumn("iy", grid_cell(F.col("lat"), y0, step))
    return located.join(cells, ["ix", "iy"], "left")
