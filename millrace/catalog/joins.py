"""Equi-joins, look-backs and spatial joins."""

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.functions.scalars import rounded
from millrace.operators import geo, joins, neighbours


@query("join_left_nullsafe", """
select o.service_order_id, o.flag, e.n from service_order o left join
  (select flag, count(*) as n, min(service_order_id) as low from service_order where flag is null or flag % 2 = 1 group by flag) e on o.flag is not distinct from e.flag""", "service_order")
def _(t):
    known = t.service_order.where("flag is null or flag % 2 = 1").groupBy("flag").agg(F.count("*").alias("n"))
    return joins.left_nullsafe(t.service_order.select("service_order_id", "flag"), known, {"flag": "flag"})


@query("join_left_composite", """
select o.service_order_id, o.driver_id, o.total_amount, d.distance, d.rate from service_order o left join
  (select service_order_id, driver_id, arg_max(distance, (round, batch, tie, distance)) as distance, max(driver_add_rate) as rate from dispatch_detail group by 1, 2) d
  on o.service_order_id is not distinct from d.service_order_id and o.driver_id is not distinct from d.driver_id""", "service_order dispatch_detail")
def _(t):
    latest = t.dispatch_detail.groupBy("service_order_id", "driver_id").agg(
        F.max(F.struct("round", "batch", "tie", "distance"))["distance"].alias("distance"), F.max("driver_add_rate").alias("rate"))
    orders = t.service_order.select("service_order_id", "driver_id", "total_amount")
    return joins.left_nullsafe(orders, latest, {"service_order_id": "service_order_id", "driver_id": "driver_id"})


@query("semi_join_in", """
select service_order_id, user_id, dt from service_order where service_order_id in (select service_order_id from dispatch_detail where accept_status = 1)""", "service_order dispatch_detail")
def _(t):
    accepted = t.dispatch_detail.where("accept_status = 1")
    return joins.keep_matching(t.service_order.select("service_order_id", "user_id", "dt"), accepted, "service_order_id")


@query("rejoin_detail", """
, first_round as (select service_order_id, min(round) as round from dispatch_detail group by 1)
select f.service_order_id, f.round, min(driver_add_rate) as min_driver_add_rate, max(driver_add_rate) as max_driver_add_rate,
  min(customer_add_rate) as min_customer_add_rate, max(customer_add_rate) as max_customer_add_rate
from first_round f join dispatch_detail d on f.service_order_id = d.service_order_id and f.round = d.round group by 1, 2""", "dispatch_detail")
def _(t):
    return joins.at_edge(t.dispatch_detail, "service_order_id", "round", ["driver_add_rate", "customer_add_rate"])


@query("grid_lookup_join", """
, cells as (select cast(floor((lng - 116.0) / 0.05) as bigint) as ix, cast(floor((lat - 39.0) / 0.05) as bigint) as iy, avg(altitude) as altitude, count(*) as n from places group by 1, 2)
select point_id, p.ix, p.iy, round(c.altitude, 4) as altitude, c.n from
  (select point_id, cast(floor((lng - 116.0) / 0.05) as bigint) as ix, cast(floor((lat - 39.0) / 0.05) as bigint) as iy from points) p left join cells c on p.ix = c.ix and p.iy = c.iy""", "points places")
def _(t):
    cells = t.places.groupBy(geo.grid_cell(F.col("lng"), 116.0, 0.05).alias("ix"), geo.grid_cell(F.col("lat"), 39.0, 0.05).alias("iy")).agg(
        F.avg("altitude").alias("altitude"), F.count("*").alias("n"))
    found = geo.grid_lookup(t.points.select("point_id", "lat", "lng"), cells, 116.0, 39.0, 0.05)
    return found.select("point_id", "ix", "iy", F.round("altitude", 4).alias("altitude"), "n")


@query("nearest_codebook", """
, centres as (select heading, avg(lat) as clat, avg(lng) as clng from places group by heading)
select point_id, arg_min(heading, ((lat - clat) * (lat - clat) + (lng - clng) * (lng - clng), heading)) as heading,
  round(sqrt(min((lat - clat) * (lat - clat) + (lng - clng) * (lng - clng))), 6) as distance from points, centres group by point_id""", "points places")
def _(t):
    centres = t.places.groupBy("heading").agg(F.array(F.avg("lat"), F.avg("lng")).alias("centre"))
    points = t.points.select("point_id", F.array("lat", "lng").alias("v"))
    found = neighbours.assign_nearest(points, "point_id", "v", centres, "heading", "centre")
    return found.withColumn("distance", rounded(F.col("distance"), 6))


HAVERSINE = """2 * 6371 * 1000 * asin(sqrt(pow(sin(radians(r.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(r.lat)) * pow(sin(radians(r.lng - p.lng) / 2), 2)))"""


@query("radius_join", f"""
, near as (select point_id, place_id, {HAVERSINE} as distance from points p, places r)
select p.point_id, n.place_id, round(n.distance, 3) as distance from points p left join (select * from near where distance <= 3000) n on n.point_id = p.point_id""", "points places")
def _(t):
    found = geo.radius_join(t.points.select("point_id", "lat", "lng"), t.places.select("place_id", "lat", "lng"), 3000.0)
    return found.withColumn("distance", rounded(F.col("distance"), 3))


@query("snap_nearest_road", f"""
, near as (select point_id, place_id, heading, {HAVERSINE} as distance from points p, places r),
  best as (select point_id, arg_min(place_id, (distance, place_id)) as place_id, arg_min(heading, (distance, place_id)) as heading, min(distance) as d from near where distance <= 4000 group by 1),
  way as (select p.*, b.place_id, d / 6371000.0 as a, radians((heading * 45 + 180) % 360) as th from points p left join best b using (point_id)),
  moved as (select *, asin(sin(radians(lat)) * cos(a) + cos(radians(lat)) * sin(a) * cos(th)) as lat2 from way)
select point_id, place_id as road_id, round(case when place_id is null then lat else degrees(lat2) end, 7) as lat,
  round(case when place_id is null then lng else degrees(radians(lng) + atan2(sin(th) * sin(a) * cos(radians(lat)), cos(a) - sin(radians(lat)) * sin(lat2))) end, 7) as lng from moved""", "points places")
def _(t):
    roads = t.places.select("place_id", "lat", "lng", "heading")
    found = geo.snap_to_nearest(t.points.select("point_id", "lat", "lng"), roads, 4000.0)
    return found.withColumn("lat", rounded(F.col("lat"), 7)).withColumn("lng", rounded(F.col("lng"), 7))


def _poly():
    x, y = "(lng - 105.0)", "(lat - 35.0)"
    s = lambda v, k: f"sin({v} * pi() * {k})"
    common = f"20.0 * {s(x, 6.0)} + 20.0 * {s(x, 2.0)}"
    north = (f"(({common} + 20.0 * {s(y, 1.0)} + 40.0 * {s(y, '1.0e0 / 3')} + 160.0 * {s(y, '1.0e0 / 12')} + 320.0 * {s(y, '1.0e0 / 30')}) * 2.0e0 / 3"
             f" - 100.0 + 2.0 * {x} + 3.0 * {y} + 0.2 * {y} * {y} + 0.1 * {x} * {y} + 0.2 * sqrt(abs({x})))")
    east = (f"(({common} + 20.0 * {s(x, 1.0)} + 40.0 * {s(x, '1.0e0 / 3')} + 150.0 * {s(x, '1.0e0 / 12')} + 300.0 * {s(x, '1.0e0 / 30')}) * 2.0e0 / 3"
            f" + 300.0 + {x} + 2.0 * {y} + 0.1 * {x} * {x} + 0.1 * {x} * {y} + 0.1 * sqrt(abs({x})))")
    return north, east


_NORTH, _EAST = _poly()
_BITS = " || ".join(
    "substr('0123456789bcdefghjkmnpqrstuvwxyz', cast(1 + " + " + ".join(
        f"{1 << (4 - i)} * (({'gx' if (5 * c + i) % 2 == 0 else 'gy'} >> {(12 if (5 * c + i) % 2 == 0 else 11) - (5 * c + i) // 2}) & 1)" for i in range(5)) + " as int), 1)"
    for c in range(5))


@query("geo_cell_density", f"""
, m as (select lat, lng, 1 - 0.00669342162296594323::double * pow(sin(radians(lat)), 2) as magic, {_NORTH} as north, {_EAST} as east from points),
  w as (select lat - north * 180.0 / (6378137.0 * (1 - 0.00669342162296594323::double) / (magic * sqrt(magic)) * pi()) as wlat,
    lng - east * 180.0 / (6378137.0 / sqrt(magic) * cos(radians(lat)) * pi()) as wlng from m),
  g as (select cast(floor((wlng + 180) / 360 * 8192) as bigint) as gx, cast(floor((wlat + 90) / 180 * 4096) as bigint) as gy from w)
select {_BITS} as cell, count(*) as n from g group by 1""", "points")
def _(t):
    return geo.cell_density(t.points.select("lat", "lng"), 5)
