"""Registered queries: key -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables through the fixture trips (so its work
grows with them) and fixes the dashboard parameters: both systems, months
1995-01 .. 2024-01, N = 10 stations / 5 routes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..filters import RideFilter
from ..functions import geo, labels
from ..operators import facts, incremental, kpis, marts, quality, spatial, stations, summary, zones
from ..operators import staging as staging_ops
from ..schemas import FCT_COLUMNS
from ..session import apply_ride_settings, work_dir, written
from ..sources.json_documents import write_document
from ..sources import census, fixtures, geojson, manifest, seeds, trips_csv
from ..sources import zones as zone_src
from ..streaming import jobs as streams
from . import warehouse

FILTER = RideFilter(fixtures.SYSTEMS, dt.date(1995, 1, 1), dt.date(2024, 1, 1))

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimal columns as double, so results hash the same as the SQL twin."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def round6(df: DataFrame, cols) -> DataFrame:
    """Round double aggregates whose last bits depend on summation order."""
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols}) if cols else df


def register(name: str, rounded: tuple[str, ...] = ()):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = lambda spark, sf_dir: round6(comparable(fn(apply_ride_settings(spark), sf_dir)), rounded)
        return fn

    return deco


def _wh(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    return warehouse.fixture_warehouse(spark, sf_dir)


def _rides_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged rides as a table, for queries that read them more than once: they are joined once."""
    return written(_wh(spark, sf_dir).unioned, "rides")


def _wh_written(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    """The warehouse over written rides and a written fact: each is made once, however often it is read."""
    unioned = _rides_written(spark, sf_dir)
    return warehouse.over_fact(unioned, written(facts.fct_rides(unioned), "fct"))


# ---- fact chain -------------------------------------------------------------------------


@register("rides_unioned")
def q_rides_unioned(spark, sf):
    return _wh(spark, sf).unioned


@register("dedup_latest")
def q_dedup_latest(spark, sf):
    from ..operators.facts import dedup_latest

    return dedup_latest(_wh(spark, sf).unioned)


@register("fct_rides")
def q_fct_rides(spark, sf):
    return _wh(spark, sf).fct


@register("agg_rides_daily")
def q_agg_rides_daily(spark, sf):
    return _wh(spark, sf).daily


# ---- daily-mart KPIs --------------------------------------------------------------------


@register("overview_kpis", rounded=("total_hours",))
def q_overview_kpis(spark, sf):
    return kpis.overview_kpis(_wh(spark, sf).daily, FILTER)


@register("overview_kpis_sql", rounded=("total_hours",))
def q_overview_kpis_sql(spark, sf):
    return kpis.overview_kpis_sql(_wh(spark, sf).daily, FILTER)


@register("unique_station_count")
def q_unique_station_count(spark, sf):
    return kpis.unique_station_count(_wh(spark, sf).dim, FILTER)


@register("member_casual_breakdown")
def q_member_casual_breakdown(spark, sf):
    return kpis.member_casual_breakdown(_wh(spark, sf).daily, FILTER)


@register("rideable_type_breakdown")
def q_rideable_type_breakdown(spark, sf):
    return kpis.rideable_type_breakdown(_wh(spark, sf).daily, FILTER)


@register("daily_rides_over_time")
def q_daily_rides_over_time(spark, sf):
    return kpis.daily_rides_over_time(_wh(spark, sf).daily, FILTER)


@register("daily_member_casual")
def q_daily_member_casual(spark, sf):
    return kpis.daily_member_casual(_wh(spark, sf).daily, FILTER)


@register("daily_rideable_type")
def q_daily_rideable_type(spark, sf):
    return kpis.daily_rideable_type(_wh(spark, sf).daily, FILTER)


@register("duration_stats", rounded=("avg_minutes",))
def q_duration_stats(spark, sf):
    return kpis.duration_stats(_wh(spark, sf).daily, FILTER)


@register("shortest_between_stations")
def q_shortest_between_stations(spark, sf):
    return kpis.shortest_between_stations(_wh(spark, sf).fct, FILTER)


@register("busiest_quietest_day")
def q_busiest_quietest_day(spark, sf):
    return kpis.busiest_quietest_day(_wh(spark, sf).daily, FILTER)


@register("available_months")
def q_available_months(spark, sf):
    return kpis.available_months(_wh(spark, sf).daily)


@register("city_summary", rounded=("total_hours", "avg_minutes"))
def q_city_summary(spark, sf):
    wh = _wh(spark, sf)
    return kpis.city_summary(wh.daily, wh.dim, wh.fct, FILTER)


@register("city_metrics", rounded=("total_hours", "avg_minutes"))
def q_city_metrics(spark, sf):
    wh = _wh(spark, sf)
    return kpis.city_metrics(kpis.city_summary(wh.daily, wh.dim, wh.fct, FILTER))


@register("comparison_ratio", rounded=("value", "ratio"))
def q_comparison_ratio(spark, sf):
    wh = _wh(spark, sf)
    summary = kpis.city_summary(wh.daily, wh.dim, wh.fct, FILTER)
    return kpis.comparison_ratio(summary, ["total_rides", "total_hours", "avg_minutes", "active_stations"])


@register("segment_share")
def q_segment_share(spark, sf):
    return kpis.segment_share(kpis.member_casual_breakdown(_wh(spark, sf).daily, FILTER), "member_casual")


# ---- fact KPIs --------------------------------------------------------------------------


@register("top_start_stations")
def q_top_start_stations(spark, sf):
    return kpis.top_stations(_wh(spark, sf).fct, FILTER, "start", 10)


@register("top_end_stations")
def q_top_end_stations(spark, sf):
    return kpis.top_stations(_wh(spark, sf).fct, FILTER, "end", 10)


@register("top_routes")
def q_top_routes(spark, sf):
    return kpis.top_routes(_wh(spark, sf).fct, FILTER, 5)


@register("top_start_stations_geo")
def q_top_start_stations_geo(spark, sf):
    wh = _wh(spark, sf)
    return kpis.top_stations_geo(wh.fct, wh.dim, FILTER, "start", 10)


@register("top_end_stations_geo")
def q_top_end_stations_geo(spark, sf):
    wh = _wh(spark, sf)
    return kpis.top_stations_geo(wh.fct, wh.dim, FILTER, "end", 10)


@register("top_routes_geo")
def q_top_routes_geo(spark, sf):
    wh = _wh(spark, sf)
    return kpis.top_routes_geo(wh.fct, wh.dim, FILTER, 5)


@register("scaled_marker_size")
def q_scaled_marker_size(spark, sf):
    top = kpis.top_stations(_wh(spark, sf).fct, FILTER, "start", 10)
    return kpis.scaled_marker_size(top, "rides", 6.0, 24.0, by=("system",))


@register("rides_by_hour")
def q_rides_by_hour(spark, sf):
    return kpis.rides_by_hour(_wh(spark, sf).fct, FILTER)


@register("rides_by_dow")
def q_rides_by_dow(spark, sf):
    return kpis.rides_by_dow(_wh(spark, sf).fct, FILTER)


@register("active_stations")
def q_active_stations(spark, sf):
    return kpis.active_stations(_wh(spark, sf).fct, FILTER)


# ---- stations ---------------------------------------------------------------------------


@register("station_observations")
def q_station_observations(spark, sf):
    return stations.station_observations(_wh(spark, sf).unioned)


@register("dim_stations")
def q_dim_stations(spark, sf):
    return _wh(spark, sf).dim


@register("all_stations_geo")
def q_all_stations_geo(spark, sf):
    return stations.all_stations_geo(_wh(spark, sf).dim, FILTER.systems)


@register("station_centroids")
def q_station_centroids(spark, sf):
    return kpis.station_centroids(_wh(spark, sf).dim)


# ---- zones ------------------------------------------------------------------------------

ZONE_SYSTEM = "beta"


def zone_inputs(spark, sf, boundary: str, wh: warehouse.Warehouse | None = None):
    wh = wh or _wh(spark, sf)
    meta = zone_src.zone_meta(zone_src.grid_cell_meta(spark, sf), boundary)
    pop = zone_src.zone_population(spark, sf, boundary)
    mapping = zone_src.station_zone_map(wh.dim, spark, sf, boundary, ZONE_SYSTEM)
    return wh, meta, pop, mapping


def zone_mart(spark, sf, boundary: str, wh: warehouse.Warehouse | None = None) -> DataFrame:
    wh, meta, pop, mapping = zone_inputs(spark, sf, boundary, wh)
    spec = zone_src.BOUNDARIES[boundary]
    display = (spec["display_col"],) if spec["display_col"] else ()
    return marts.zone_rollup(wh.fct, mapping, meta, pop, ZONE_SYSTEM, spec["id_col"], display)


for _b in zone_src.BOUNDARIES:
    register(f"agg_zone_{_b}")(lambda spark, sf, _b=_b: zone_mart(spark, sf, _b))


@register("zone_arrivals")
def q_zone_arrivals(spark, sf):
    wh, meta, pop, mapping = zone_inputs(spark, sf, "neighborhood")
    b = marts.Boundary("neighborhood", "neighborhood_name", mapping, meta, pop)
    arrivals = marts.zone_arrivals(marts.zone_counts(wh.fct, [b], ZONE_SYSTEM), b.name)
    return arrivals.withColumnRenamed("zone", "neighborhood_name")


@register("zone_station_count")
def q_zone_station_count(spark, sf):
    _, _, _, mapping = zone_inputs(spark, sf, "neighborhood")
    return mapping.where(F.col("neighborhood_name").isNotNull()).groupBy("neighborhood_name").agg(F.count(F.lit(1)).alias("station_count"))


def _zone_metrics(spark, sf, boundary="neighborhood"):
    mart = zone_mart(spark, sf, boundary)
    return zones.zone_metrics(mart, zone_src.BOUNDARIES[boundary]["id_col"], FILTER.month_start, FILTER.month_end)


@register("zone_metrics")
def q_zone_metrics(spark, sf):
    return _zone_metrics(spark, sf)


@register("zone_metrics_cluster")
def q_zone_metrics_cluster(spark, sf):
    return _zone_metrics(spark, sf, "cluster")


@register("zone_table")
def q_zone_table(spark, sf):
    return zones.zone_table(_zone_metrics(spark, sf), "rides_per_km2")


@register("zone_metric_quantiles", rounded=("p05", "p95"))
def q_zone_metric_quantiles(spark, sf):
    return zones.zone_metric_quantiles(_zone_metrics(spark, sf))


@register("zone_display_names")
def q_zone_display_names(spark, sf):
    wh, meta, _, _ = zone_inputs(spark, sf, "cluster")
    return zones.zone_display_names(_zone_metrics(spark, sf, "cluster"), meta, "cluster_id", "cluster_display_name")


@register("stations_per_zone_top10")
def q_stations_per_zone_top10(spark, sf):
    _, _, _, mapping = zone_inputs(spark, sf, "tract")
    mapping = mapping.where(F.col("tract_geoid").isNotNull())
    return zones.stations_per_zone_top(mapping, "tract_geoid", 10)


@register("top_population_zones")
def q_top_population_zones(spark, sf):
    return zones.top_population_zones(zone_src.zone_population(spark, sf, "block_group"), "bg_geoid", 10)


# ---- geo --------------------------------------------------------------------------------


def _stations_xy(spark, sf):
    """The system's stations, written: their readers don't make the dimension from the rides again."""
    dim = _wh(spark, sf).dim
    return written(dim.where((F.col("system") == ZONE_SYSTEM) & F.col("lat").isNotNull() & F.col("lng").isNotNull()).select(
        "station_id", F.col("lat").cast("double").alias("lat"), F.col("lng").cast("double").alias("lng")
    ), "stations")


def _cells(spark, sf):
    return zone_src.grid_cells(spark, sf).select(F.col("name").alias("zone"), "geometry")


def _city_boundary(spark, sf):
    """The grid extent as one polygon, derived from the cell layer."""
    cells = zone_src.grid_cells(spark, sf)
    bb = cells.agg(
        F.min(geo.bbox(F.col("geometry"))["xmin"]).alias("x0"), F.min(geo.bbox(F.col("geometry"))["ymin"]).alias("y0"),
        F.max(geo.bbox(F.col("geometry"))["xmax"]).alias("x1"), F.max(geo.bbox(F.col("geometry"))["ymax"]).alias("y1"),
    )
    ring = F.array(
        geo.point(F.col("x0"), F.col("y0")), geo.point(F.col("x1"), F.col("y0")), geo.point(F.col("x1"), F.col("y1")),
        geo.point(F.col("x0"), F.col("y1")), geo.point(F.col("x0"), F.col("y0")),
    )
    return bb.select(F.array(F.array(ring)).alias("geometry"))


@register("utm_project")
def q_utm_project(spark, sf):
    p = geo.utm(F.col("lng"), F.col("lat"))
    return _stations_xy(spark, sf).select(
        "station_id", F.round(p["x"], 3).alias("easting"), F.round(p["y"], 3).alias("northing")
    )


@register("zone_area")
def q_zone_area(spark, sf):
    return _cells(spark, sf).select("zone", geo.area_km2(F.col("geometry")).alias("area_km2"))


@register("zone_centroid")
def q_zone_centroid(spark, sf):
    c = geo.centroid(F.col("geometry"))
    return _cells(spark, sf).select(
        "zone", F.round(c["y"], 6).alias("centroid_lat"), F.round(c["x"], 6).alias("centroid_lng")
    )


@register("points_in_boundary")
def q_points_in_boundary(spark, sf):
    return spatial.points_in_polygons(_stations_xy(spark, sf), _city_boundary(spark, sf)).select("station_id")


@register("point_in_polygon")
def q_point_in_polygon(spark, sf):
    return spatial.points_in_polygons(_stations_xy(spark, sf), _cells(spark, sf), how="left").select(
        "station_id", "zone"
    )


@register("spatial_gaps")
def q_spatial_gaps(spark, sf):
    st = _stations_xy(spark, sf)
    pip = spatial.points_in_polygons(st, _cells(spark, sf), how="left")
    return st.join(pip.where(F.col("zone").isNull()), "station_id", "left_semi").select(
        "station_id"
    )


@register("nearest_zone")
def q_nearest_zone(spark, sf):
    st = _stations_xy(spark, sf)
    pip = spatial.points_in_polygons(st, _cells(spark, sf), how="left")
    gaps = st.join(pip.where(F.col("zone").isNull()), "station_id", "left_semi")
    return spatial.nearest(
        spatial.project_points(gaps), spatial.projected_centroids(_cells(spark, sf), "zone"),
        "station_id", "zone", "ux", "uy", "ux", "uy",
    ).select("station_id", "zone")


@register("station_zone_assignment")
def q_station_zone_assignment(spark, sf):
    return spatial.assign_stations(_stations_xy(spark, sf), _cells(spark, sf), "zone", _city_boundary(spark, sf))


def _tiles(spark, sf):
    return zone_src.census_tiles(spark, sf)


@register("station_zone_dedup")
def q_station_zone_dedup(spark, sf):
    layers = _cells(spark, sf).unionByName(_tiles(spark, sf).select(F.col("tile_id").alias("zone"), "geometry"))
    hits = spatial.points_in_polygons(_stations_xy(spark, sf), layers).select("station_id", "zone")
    from ..operators.dedup import dedup_rows

    return dedup_rows(hits, ["station_id"])


@register("polygon_overlay")
def q_polygon_overlay(spark, sf):
    ov = spatial.polygon_overlay(_cells(spark, sf), _tiles(spark, sf), "zone", "tile_id", project_utm=None)
    return ov.select(
        "zone", "tile_id", F.round(F.col("area"), 10).alias("area"), F.round(F.col("weight"), 6).alias("weight")
    )


def _holed_layer(spark, sf) -> DataFrame:
    """A polygon of two parts for every supplier: a square with a square hole, and a small square far east of it."""
    k = F.col("s_suppkey")
    x, y = (k % 100).cast("double") * F.lit(0.04), F.floor(k / 100).cast("double") * F.lit(0.04)

    def square(dx, dy, side):
        return zone_src.rect(x + F.lit(dx), y + F.lit(dy), side, side)

    holed = F.array(square(0.0, 0.0, 0.04), square(0.01, 0.01, 0.02))
    return zone_src.table(spark, sf, "supplier").select(k.alias("s_suppkey"), F.array(
        holed, F.array(square(100.0, 0.0, 0.01))).alias("geometry"))


@register("point_in_holed_polygon")
def q_point_in_holed_polygon(spark, sf):
    """Points from customers in polygons from suppliers, with holes and second parts; both grow with the tables."""
    c = F.col("c_custkey")
    off = [F.lit(0.0015) + (j % 10).cast("double") * F.lit(0.004) for j in (c, F.floor(c / 10))]
    points = zone_src.table(spark, sf, "customer").select(
        c.alias("c_custkey"),
        ((c * 37 % 100).cast("double") * F.lit(0.04) + off[0] + F.when(c % 17 == 0, 100.0).otherwise(0.0)).alias("lng"),
        ((c * 13 % 100).cast("double") * F.lit(0.04) + off[1]).alias("lat"))
    hit = spatial.points_in_polygons(points, _holed_layer(spark, sf), cell=0.04)
    return hit.select("c_custkey", "s_suppkey")


@register("points_in_long_outline")
def q_points_in_long_outline(spark, sf):
    """Customers within a boundary of 10 000 vertices, a zigzag below and another above."""
    ids = F.sequence(F.lit(0), F.lit(4999))
    below = F.transform(ids, lambda i: geo.point(i.cast("double"), (i % 2).cast("double")))
    above = F.transform(ids, lambda j: geo.point((4999 - j).cast("double"), (1000 + j % 3).cast("double")))
    ring = F.concat(below, above, F.array(geo.point(F.lit(0.0), F.lit(0.0))))
    outline = spark.range(1).select(F.array(F.array(ring)).alias("geometry"))
    c = F.col("c_custkey")
    points = zone_src.table(spark, sf, "customer").select(
        c.alias("c_custkey"), ((c * 37 % 4999).cast("double") + 0.25).alias("lng"),
        F.when(c % 2 == 0, (c * 101 % 1003).cast("double") + 0.3).when(c % 4 == 1, (c % 7).cast("double") / 8.0).otherwise(
            1000.0 + (c % 23).cast("double") / 8.0).alias("lat"))
    return spatial.points_in_polygons(points, outline, cell=25.0).select("c_custkey")


@register("nearest_many")
def q_nearest_many(spark, sf):
    """Nearest supplier of every customer, both scattered over a square by their keys."""
    def scattered(name, key):
        k = F.col(key)
        return zone_src.table(spark, sf, name).select(
            k.alias(key), (k * 7919 % 100003).cast("double").alias("x"), (k * k % 99991).cast("double").alias("y"))

    near = spatial.nearest(scattered("customer", "c_custkey"), scattered("supplier", "s_suppkey"), "c_custkey", "s_suppkey")
    return near.select("c_custkey", "s_suppkey", "distance")


@register("nearest_uneven")
def q_nearest_uneven(spark, sf):
    """As above, but one supplier is far off, a third of them are at one place and a third in a crowd of 100 x 100."""
    k = F.col("s_suppkey")
    x, y = (k * 7919 % 100003).cast("double"), (k * k % 99991).cast("double")

    def placed(c, far, spread):
        return F.when(k == 1, far).when(k % 3 == 0, 40000.0).when(k % 3 == 1, F.floor(c / 1000.0) + spread).otherwise(c)

    suppliers = zone_src.table(spark, sf, "supplier").select(k.alias("s_suppkey"), placed(x, -1e9, 60000.0).alias("x"),
                                                            placed(y, -1e9, 20000.0).alias("y"))
    c = F.col("c_custkey")
    customers = zone_src.table(spark, sf, "customer").select(
        c.alias("c_custkey"), (c * 7919 % 100003).cast("double").alias("x"), (c * c % 99991).cast("double").alias("y"))
    return spatial.nearest(customers, suppliers, "c_custkey", "s_suppkey").select("c_custkey", "s_suppkey", "distance")


@register("polygon_overlay_utm")
def q_polygon_overlay_utm(spark, sf):
    """The source's overlay: both layers projected to UTM 18N, areas in m² (of each cell's corners joined by straight lines)."""
    ov = spatial.polygon_overlay(_cells(spark, sf), _tiles(spark, sf), "zone", "tile_id")
    return ov.select("zone", "tile_id", F.round(F.col("area"), 0).alias("area_m2"), F.round(F.col("weight"), 6).alias("weight"))


@register("overlay_many")
def q_overlay_many(spark, sf):
    """Shared areas of rectangles from customers and suppliers, both growing with the tables; half the rings are open,
    customers' have a square hole."""
    def at(k):
        return (k * 37 % 997).cast("double"), (k * 101 % 991).cast("double")

    def ring(k, x0, y0, w, h):
        whole = F.array(*(geo.point(px, py) for px, py in ((x0, y0), (x0 + w, y0), (x0 + w, y0 + h), (x0, y0 + h), (x0, y0))))
        return F.when(k % 2 == 0, whole).otherwise(F.slice(whole, 1, 4))

    c, s = F.col("c_custkey"), F.col("s_suppkey")
    (cx, cy), (sx, sy) = at(c), at(s)
    customers = zone_src.table(spark, sf, "customer").select(c.alias("c_custkey"), F.array(F.array(
        ring(c, cx, cy, 8.0, 6.0), ring(c + 1, cx + 2.0, cy + 2.0, 2.0, 2.0))).alias("geometry"))
    suppliers = zone_src.table(spark, sf, "supplier").select(s.alias("s_suppkey"), F.array(F.array(
        ring(s, sx, sy, 20.0 + (s % 5).cast("double"), 15.0))).alias("geometry"))
    ov = spatial.polygon_overlay(customers, suppliers, "c_custkey", "s_suppkey", project_utm=None, cell=25.0)
    return ov.select(F.col("c_custkey").cast("long"), F.col("s_suppkey").cast("long"), F.round("area", 6).alias("area"),
                     F.round("weight", 9).alias("weight"))


@register("area_weighted_population")
def q_area_weighted_population(spark, sf):
    ov = spatial.polygon_overlay(_cells(spark, sf), _tiles(spark, sf), "zone", "tile_id", project_utm=None)
    src = _tiles(spark, sf).select("tile_id", "population", "households", "median_household_income")
    return spatial.area_weighted_population(ov, src, "zone", "tile_id")


# ---- data quality -----------------------------------------------------------------------

DQ_AS_OF = dt.datetime(2024, 3, 15)


def dq_suites():
    marts_of = {f"agg_zone_{b}": spec["id_col"] for b, spec in zone_src.BOUNDARIES.items()}
    return quality.declared_suites(list(fixtures.SYSTEMS), marts_of)


def dq_results(spark, sf):
    wh = _wh_written(spark, sf)
    frames = {"fct_rides": wh.fct, "dim_stations": wh.dim, "agg_rides_daily": wh.daily, "rides_unioned": wh.unioned}
    frames |= {f"stg_{s}": wh.unioned.where(F.col("system") == s) for s in fixtures.SYSTEMS}
    frames |= {f"agg_zone_{b}": zone_mart(spark, sf, b, wh) for b in zone_src.BOUNDARIES}
    return quality.run_suites(frames, dq_suites())


@register("dq_not_null")
def q_dq_not_null(spark, sf):
    return dq_results(spark, sf).where(F.col("kind") == "not_null").select("model", "test", "failures")


@register("dq_accepted_values")
def q_dq_accepted_values(spark, sf):
    return dq_results(spark, sf).where(F.col("kind") == "accepted_values").select("model", "test", "failures")


@register("dq_unique")
def q_dq_unique(spark, sf):
    return quality.unique_violations(_wh(spark, sf).unioned, ["ride_id"])


@register("dq_unique_combination")
def q_dq_unique_combination(spark, sf):
    return dq_results(spark, sf).where(F.col("kind") == "unique_combination").select("model", "test", "failures")


@register("dq_repeated_observations")
def q_dq_repeated_observations(spark, sf):
    """Combinations that do repeat, so that the violations themselves are seen."""
    obs = stations.station_observations(_wh(spark, sf).unioned)
    return quality.unique_violations(obs, ["system", "station_id", "station_name"])


@register("dq_long_rides")
def q_dq_long_rides(spark, sf):
    return quality.long_rides(_wh(spark, sf).fct)


@register("dq_freshness")
def q_dq_freshness(spark, sf):
    return quality.freshness(_wh(spark, sf).unioned, "system", "_ingested_at", DQ_AS_OF)


@register("dq_report")
def q_dq_report(spark, sf):
    return quality.report(dq_results(spark, sf))


# ---- incremental ------------------------------------------------------------------------

FIRST_LOAD_CUTOFF = dt.datetime(1998, 6, 30)


@register("ride_features")
def q_ride_features(spark, sf):
    return facts.ride_features(facts.dedup_latest(_wh(spark, sf).unioned))


@register("ingest_watermark")
def q_ingest_watermark(spark, sf):
    return incremental.watermark(_wh(spark, sf).fct)


def _two_batch_fact(spark, sf, strict=False) -> str:
    unioned = _rides_written(spark, sf)
    root = work_dir(spark, "fct")
    first = unioned.where(F.col("_ingested_at") <= F.lit(FIRST_LOAD_CUTOFF).cast("timestamp_ntz"))
    incremental.write_fact(facts.fct_rides(first), root)
    incremental.run_incremental(spark, unioned, root, strict=strict)
    return root


@register("incremental_upsert")
def q_incremental_upsert(spark, sf):
    return incremental.read_fact(spark, _two_batch_fact(spark, sf)).select(*FCT_COLUMNS)


@register("full_refresh_over_old")
def q_full_refresh_over_old(spark, sf):
    """A full refresh with fewer months and one system, over a table that holds all."""
    path, fct = work_dir(spark, "fct"), _wh(spark, sf).fct
    incremental.write_fact(fct, path)
    some = (F.col("system") == "alpha") & (F.col("started_month") >= F.lit(dt.date(1997, 1, 1)))
    incremental.write_fact(fct.where(some), path)
    return incremental.read_fact(spark, path).select(*FCT_COLUMNS)


def _moved_month_fact(spark, sf, before=lambda path: None, on_touch=None) -> str:
    """The fact after a batch that republishes every ride of its first month 40 days later."""
    path, unioned = work_dir(spark, "fct"), _rides_written(spark, sf)
    incremental.write_fact(facts.fct_rides(unioned), path)
    before(path)
    fct = incremental.read_fact(spark, path)  # the written one: rides aren't joined and deduplicated again
    first = fct.agg(F.min("started_month")).first()[0]
    ids = written(fct.where(F.col("started_month") == F.lit(first)).select("ride_id"), "first-month")
    later = {c: F.col(c) + F.expr("interval 40 days") for c in ("started_at", "ended_at")}
    at = F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz")
    moved = unioned.join(ids, "ride_id", "left_semi").withColumns({**later, "_ingested_at": at})
    incremental.apply_batch(spark, moved, path, on_touch=on_touch)
    return path


@register("incremental_moved_month")
def q_incremental_moved_month(spark, sf):
    return incremental.read_fact(spark, _moved_month_fact(spark, sf)).select(*FCT_COLUMNS)


def _summary(spark, sf):
    # the update reads its rides for codes, counts and bitmaps: they are joined and deduplicated once, not for each
    rides = written(_wh(spark, sf).fct.select(*summary.READ), "summary-rides")
    return summary.update(spark, rides, work_dir(spark, "summary"))


@register("lattice_top_stations")
def q_lattice_top_stations(spark, sf):
    kept = _summary(spark, sf)
    both = [kpis.top_stations(kept, FILTER, side).withColumn("side", F.lit(side)) for side in ("start", "end")]
    return both[0].unionByName(both[1])


@register("lattice_top_routes")
def q_lattice_top_routes(spark, sf):
    return kpis.top_routes(_summary(spark, sf), FILTER)


@register("lattice_rides_by_hour")
def q_lattice_rides_by_hour(spark, sf):
    return kpis.rides_by_hour(_summary(spark, sf), FILTER)


@register("lattice_rides_by_dow")
def q_lattice_rides_by_dow(spark, sf):
    return kpis.rides_by_dow(_summary(spark, sf), FILTER)


@register("bitmap_active_stations")
def q_bitmap_active_stations(spark, sf):
    return kpis.active_stations(_summary(spark, sf), FILTER)


@register("summary_after_moves")
def q_summary_after_moves(spark, sf):
    """Hours and active stations of all months after a batch has emptied the first one, from tables that followed it."""
    root, months = work_dir(spark, "summary"), []

    def before(fact):
        summary.update(spark, incremental.read_fact(spark, fact), root)

    path = _moved_month_fact(spark, sf, before=before, on_touch=months.extend)
    kept = summary.update(spark, incremental.read_fact(spark, path), root, months)
    f = RideFilter(fixtures.SYSTEMS, dt.date(1900, 1, 1), dt.date(2100, 1, 1))
    return kpis.rides_by_hour(kept, f).join(kpis.active_stations(kept, f), "system")


@register("table_rebuild")
def q_table_rebuild(spark, sf):
    """The daily mart rebuilt over a table of other rows."""
    from ..plans.refresh import _replace_months

    daily, path = written(_wh(spark, sf).daily, "daily"), f"{work_dir(spark, 'rebuild')}/daily"
    other = daily.where(F.col("system") == "alpha").withColumn("started_date", F.date_sub("started_date", 4000))
    for rows in (other, daily):
        _replace_months(spark, rows.withColumn("_month", F.trunc("started_date", "month")), path, "_month", None)
    return spark.read.parquet(path).select(*daily.columns)


@register("reversed_months")
def q_reversed_months(spark, sf):
    """A filter whose months are given the wrong way round."""
    return kpis.overview_kpis(_wh(spark, sf).daily, RideFilter(FILTER.systems, FILTER.month_end, FILTER.month_start))


@register("mart_order")
def q_mart_order(spark, sf):
    """the neighborhood mart as written: no row within a file comes after a less busy zone of its month."""
    from pyspark.sql import Window

    from ..plans.refresh import write_zone_mart

    path = f"{work_dir(spark, 'order')}/mart"
    wh = warehouse.from_unioned(_rides_written(spark, sf))  # the fact and the dimension read the rides
    write_zone_mart(spark, zone_mart(spark, sf, "neighborhood", wh), path)
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = F.lag("total_rides").over(Window.partitionBy("file").orderBy("at"))
    return rows.select("started_month", "neighborhood_name", "total_rides", (F.coalesce(before, "total_rides") >= F.col("total_rides")).alias("in_order"))


@register("dq_unique_fact")
def q_dq_unique_fact(spark, sf):
    """Copies beyond the first of any ride in the written fact, after that batch."""
    fct = incremental.read_fact(spark, _moved_month_fact(spark, sf))
    return fct.groupBy("ride_id").agg((F.count("*") - 1).alias("more")).agg(F.sum("more").alias("failures"))


@register("schema_sync")
def q_schema_sync(spark, sf):
    """Target projected onto a batch that adds ``is_long_ride`` and drops ``_source_file``."""
    fct = _wh(spark, sf).fct
    batch = fct.withColumn("is_long_ride", F.col("duration_seconds") > quality.LONG_RIDE_SECONDS).drop("_source_file")
    return incremental.schema_sync(fct, batch.schema)


# ---- ingest, seeds, GeoJSON, census ---------------------------------------------------------

PATTERNS = trips_csv.FIXTURE_SYSTEM_PATTERNS


def landing_runs(spark, sf) -> dict[str, DataFrame]:
    """Two landings and three ingest runs over the fixture trips written as CSV.

    run 1: alpha_1 + beta; then alpha_2 and an unrelated notes.csv arrive;
    run 2 loads alpha_2 only; run 3 (replay) loads nothing.
    """
    unioned = _rides_written(spark, sf)
    landing, raw_root = work_dir(spark, "landing"), work_dir(spark, "raw")
    first = F.col("_source_file") != "alpha-tripdata_2.csv"
    trips_csv.write_raw_csvs(unioned.where(first), landing)
    s1 = trips_csv.ingest(spark, landing, raw_root, PATTERNS)
    trips_csv.write_raw_csvs(unioned.where(~first), landing)
    fixtures.table(spark, sf, "nation").write.option("header", True).csv(f"{landing}/notes.csv")
    files = trips_csv.landing_files(spark, landing, PATTERNS)
    pending = trips_csv.unprocessed_files(files, manifest.loaded(spark, raw_root)).select("system", "file").distinct()
    pending = pending.checkpoint()
    s2 = trips_csv.ingest(spark, landing, raw_root, PATTERNS)
    s3 = trips_csv.ingest(spark, landing, raw_root, PATTERNS)
    return {
        "files": files.select("file", "system").distinct(),
        "pending": pending,
        "run1": s1,
        "run2": s2,
        "run3": s3,
        "raw": trips_csv.read_raw(spark, raw_root),
    }


@register("ingest_trips")
def q_ingest_trips(spark, sf):
    from ..schemas import RAW_TRIP_COLUMNS

    return landing_runs(spark, sf)["raw"].select(*RAW_TRIP_COLUMNS, "_source_file", "system")


@register("route_source_files")
def q_route_source_files(spark, sf):
    return landing_runs(spark, sf)["files"]


@register("unprocessed_files")
def q_unprocessed_files(spark, sf):
    return landing_runs(spark, sf)["pending"]


@register("ingest_summary")
def q_ingest_summary(spark, sf):
    runs = landing_runs(spark, sf)
    out = None
    for k in ("run1", "run2", "run3"):
        part = trips_csv.ingest_summary(runs[k]).withColumn("run", F.lit(k))
        out = part if out is None else out.unionByName(part)
    return out.select("run", "status", "n")


@register("stg_trips")
def q_stg_trips(spark, sf):
    raw = landing_runs(spark, sf)["raw"]
    per_system = [
        staging_ops.stage_trips(raw.where(F.col("system") == s), s, coord_type="double") for s in fixtures.SYSTEMS
    ]
    return staging_ops.union_rides(*per_system).drop("_ingested_at")


@register("seed_scan")
def q_seed_scan(spark, sf):
    """Cluster meta written as a seed CSV (display names carry commas) and read back typed."""
    meta = zone_src.zone_meta(zone_src.grid_cell_meta(spark, sf), "cluster").withColumn(
        "cluster_display_name", F.concat(F.col("cluster_display_name"), F.lit(", Cluster "), F.col("cluster_id"))
    )
    path = work_dir(spark, "seed")
    seeds.write_seed(meta, path, ["cluster_id"])
    schema = "cluster_id string, cluster_display_name string, area_km2 decimal(18,4), centroid_lat double, centroid_lng double"
    return seeds.read_seed(spark, path, schema)


def _features(spark, sf) -> DataFrame:
    cells = zone_src.grid_cells(spark, sf).select(F.col("name").alias("neighborhood_name"), "region_name", "geometry")
    path = work_dir(spark, "geojson")
    geojson.write_features(cells, path, ["neighborhood_name", "region_name"])
    props = "neighborhood_name string, region_name string"
    from pyspark.sql.types import _parse_datatype_string

    return geojson.read_features(spark, path, _parse_datatype_string(props), collection=False)


@register("geojson_features")
def q_geojson_features(spark, sf):
    f = _features(spark, sf)
    return f.select(
        "neighborhood_name", "region_name", "geometry_type",
        F.size("geometry").alias("n_parts"), F.size(F.col("geometry")[0][0]).alias("n_vertices"),
    )


@register("zone_outline")
def q_zone_outline(spark, sf):
    o = geo.outline(F.col("geometry"))

    def fmt(a):
        return F.concat_ws(",", F.transform(a, lambda v: F.format_string("%.6f", v)))

    return _features(spark, sf).select("neighborhood_name", fmt(o["lats"]).alias("lats"), fmt(o["lons"]).alias("lons"))


def census_file(spark, sf) -> str:
    """The census tiles as an API-style response: one JSON string array per line."""
    tiles = zone_src.census_tiles(spark, sf)
    t = F.substring(F.col("tile_id"), 2, 2).cast("int")
    row = F.array(
        F.concat(F.lit("Census Tract "), t.cast("string")),
        F.when(t == 7, F.lit("N/A")).otherwise(F.col("population").cast("string")),
        F.col("households").cast("string"),
        F.coalesce(F.col("median_household_income").cast("bigint").cast("string"), F.lit(str(census.SUPPRESSED))),
        F.lit("11"), F.lit("001"), F.lpad((F.lit(100) + t * 137).cast("string"), 6, "0"),
    )
    header = spark.range(1).select(
        F.array(*[F.lit(h) for h in ("NAME", census.POPULATION, census.HOUSEHOLDS, census.MEDIAN_INCOME,
                                     "state", "county", "tract")]).alias("r")
    )
    body = header.unionByName(tiles.select(row.alias("r")))
    path = work_dir(spark, "census")
    body.select(F.concat(F.to_json(F.col("r")), F.lit(",")).alias("value")).write.text(path)
    return path


@register("feature_collection")
def q_feature_collection(spark, sf):
    """Polygons of two parts with a hole, one for every supplier, written as a FeatureCollection and read back."""
    from pyspark.sql.types import _parse_datatype_string

    s = zone_src.table(spark, sf, "supplier").select("s_suppkey", F.concat("s_name", F.lit(' "]}{[\\\n')).alias("label"))
    path = f"{work_dir(spark, 'collection')}/layer.geojson"
    geojson.write_feature_collection(s.join(_holed_layer(spark, sf), "s_suppkey"), path, ["s_suppkey", "label"])
    f = geojson.read_features(spark, path, _parse_datatype_string("s_suppkey long, label string"))
    return f.select("s_suppkey", "label", "geometry_type", F.size("geometry").alias("n_parts"), F.size(F.col("geometry")[0]).alias("n_rings"),
                    F.round(F.col("geometry")[0][1][2]["x"], 6).alias("hole_x"), F.round(F.col("geometry")[1][0][2]["y"], 6).alias("part_y"))


def census_document(spark, sf, line: str) -> str:
    """A response as the API sends it, with block groups: a row for every customer, in one document."""
    c = F.col("c_custkey")
    row = F.array(
        F.concat(F.lit('Block Group "'), (c % 9).cast("string"), F.lit('", ['), F.col("c_name"), F.lit("]")),
        F.when(c % 7 == 0, F.lit(None)).otherwise((c * 13 % 4001).cast("string")), (c * 7 % 1999).cast("string"),
        F.when(c % 5 == 0, F.lit(str(census.SUPPRESSED))).otherwise((c * 31 % 250007).cast("string")),
        F.lit("11"), F.lit("001"), F.lpad((c % 999983).cast("string"), 6, "0"), (c % 9).cast("string"))
    head = '[["NAME","%s","%s","%s","state","county","tract","block group"],' % (census.POPULATION, census.HOUSEHOLDS, census.MEDIAN_INCOME)
    path = f"{work_dir(spark, 'census')}/response.json"
    write_document(zone_src.table(spark, sf, "customer").select(F.to_json(row).alias("value")), path, head + line, "]", line)
    return path


@register("census_one_line")
def q_census_one_line(spark, sf):
    return census.clean(census.read_census(spark, census_document(spark, sf, " ")))


@register("census_block_groups")
def q_census_block_groups(spark, sf):
    return census.labels(census.read_census(spark, census_document(spark, sf, "\n  ")))


@register("census_rows")
def q_census_rows(spark, sf):
    return census.read_census(spark, census_file(spark, sf))


@register("census_clean")
def q_census_clean(spark, sf):
    return census.clean(census.read_census(spark, census_file(spark, sf)))


@register("census_labels")
def q_census_labels(spark, sf):
    return census.labels(census.read_census(spark, census_file(spark, sf)))


# ---- streaming --------------------------------------------------------------------------


def _landing(spark, sf, with_ingested=False, replay=False, compression="none") -> str:
    unioned = _wh(spark, sf).unioned  # read once; the replayed file's system is made again, without the other's join
    landing = work_dir(spark, "stream-landing")
    trips_csv.write_raw_csvs(unioned, landing, with_ingested, compression=compression)
    if replay:
        trips_csv.write_raw_csvs(
            unioned.where(F.col("_source_file") == "alpha-tripdata_1.csv"), landing, with_ingested, "-replay", compression
        )
    return landing


@register("stream_ingest")
def q_stream_ingest(spark, sf):
    from ..schemas import RAW_TRIP_COLUMNS

    landing = _landing(spark, sf)
    raw, ckpt = work_dir(spark, "stream-raw"), work_dir(spark, "stream-ckpt")
    streams.stream_ingest(spark, f"{landing}/*.csv/*.csv", raw, ckpt, PATTERNS)
    streams.stream_ingest(spark, f"{landing}/*.csv/*.csv", raw, ckpt, PATTERNS)  # re-run: nothing new
    return spark.read.parquet(raw).select(*RAW_TRIP_COLUMNS, "_source_file", "system")


@register("stream_upsert")
def q_stream_upsert(spark, sf):
    unioned = _wh(spark, sf).unioned  # not written: the late part reads the events alone
    landing = work_dir(spark, "stream-landing")
    fact, ckpt = work_dir(spark, "stream-fct"), work_dir(spark, "stream-ckpt")
    glob = f"{landing}/*.csv/*.csv.gz"
    late = F.col("_source_file") == "alpha-tripdata_2.csv"
    trips_csv.write_raw_csvs(unioned.where(~late), landing, with_ingested=True, compression="gzip")
    streams.stream_upsert(spark, glob, fact, ckpt, PATTERNS, fixtures.SYSTEMS, "double", ingested_in_file=True)
    trips_csv.write_raw_csvs(unioned.where(late), landing, with_ingested=True, compression="gzip")
    streams.stream_upsert(spark, glob, fact, ckpt, PATTERNS, fixtures.SYSTEMS, "double", ingested_in_file=True)
    return incremental.read_fact(spark, fact).select(*FCT_COLUMNS)


@register("stream_dedup")
def q_stream_dedup(spark, sf):
    landing = _landing(spark, sf, replay=True, compression="gzip")
    out, ckpt = work_dir(spark, "stream-dedup"), work_dir(spark, "stream-ckpt")
    streams.stream_dedup(spark, f"{landing}/*.csv/*.csv.gz", out, ckpt, PATTERNS)
    return spark.read.parquet(out).drop("_month")


@register("stream_daily_rollup")
def q_stream_daily_rollup(spark, sf):
    fact, out, ckpt = work_dir(spark, "stream-src"), work_dir(spark, "stream-daily"), work_dir(spark, "stream-ckpt")
    _wh(spark, sf).fct.write.parquet(fact)
    streams.stream_daily_rollup(spark, fact, out, ckpt)
    return streams.read_daily(spark, out)


@register("daily_rollup_retraction")
def q_daily_rollup_retraction(spark, sf):
    """The daily mart of a stream that has seen the fact before and after a batch empties its first month."""
    out, ckpt = work_dir(spark, "stream-daily"), work_dir(spark, "stream-ckpt")
    path = _moved_month_fact(spark, sf, before=lambda fact: streams.stream_daily_rollup(spark, fact, out, ckpt))
    streams.stream_daily_rollup(spark, path, out, ckpt)
    return streams.read_daily(spark, out)


# ---- tabulation-area layer and labels ------------------------------------------------------


@register("zone_layer_filter")
def q_zone_layer_filter(spark, sf):
    layer = zone_src.tabulation_areas(spark, sf)
    return zones.layer_filter(layer, "ntaname", "ntatype", "0").select("nta2020", "ntaname", "boroname", "ntatype")


@register("zone_search")
def q_zone_search(spark, sf):
    layer = zone_src.tabulation_areas(spark, sf)
    return zones.name_search(layer, "ntaname", "RiNG").select("nta2020", "ntaname", "boroname")


@register("borough_counts")
def q_borough_counts(spark, sf):
    return zones.category_counts(zone_src.tabulation_areas(spark, sf), "boroname")


@register("zone_listing")
def q_zone_listing(spark, sf):
    layer = zones.layer_filter(zone_src.tabulation_areas(spark, sf), "ntaname")
    return zones.listing(layer.select("boroname", "ntaname", "nta2020"), ["boroname", "ntaname", "nta2020"])


@register("system_labels")
def q_system_labels(spark, sf):
    return kpis.overview_kpis(_wh(spark, sf).daily, FILTER).select(
        "system", labels.system_label(F.col("system")).alias("label")
    )


@register("formatted_kpis")
def q_formatted_kpis(spark, sf):
    wh = _wh(spark, sf)
    m = kpis.city_metrics(kpis.city_summary(wh.daily, wh.dim, wh.fct, FILTER))
    return m.select(
        "system",
        labels.compact(F.col("total_rides")).alias("total_rides_label"),
        labels.hours(F.col("total_hours")).alias("total_hours_label"),
        labels.minutes(F.col("avg_minutes")).alias("avg_minutes_label"),
        labels.percent(F.col("member_share")).alias("member_share_label"),
        labels.compact(F.col("busiest_day_rides")).alias("busiest_day_label"),
    )
