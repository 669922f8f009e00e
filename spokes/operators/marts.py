"""Aggregate marts: daily rollup (D1) and the zone x month rollup."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DAILY_COLUMNS
from ..session import written


def daily_metrics() -> list:
    """The seven metrics of the daily mart (shared by the batch and streaming rollups)."""
    return [
        F.count(F.lit(1)).alias("total_rides"),
        (F.sum("duration_seconds") / F.lit(3600.0)).alias("total_hours_on_bike"),
        (F.sum("duration_minutes").cast("double") / F.count(F.lit(1))).alias("avg_ride_minutes"),
        F.min("duration_minutes").alias("shortest_ride_minutes"),
        F.max("duration_minutes").alias("longest_ride_minutes"),
        F.count_if(F.col("is_night_owl")).alias("night_owl_rides"),
        F.count_if(F.col("is_round_trip")).alias("round_trip_rides"),
    ]


def agg_rides_daily(fct: DataFrame) -> DataFrame:
    """One row per (started_date, system, member_casual, rideable_type)  (D1).

    A single partial+final hash aggregate; the group count is bounded by
    days x systems x 4, so the final stage is small at any scale.
    """
    out = fct.groupBy("started_date", "system", "member_casual", "rideable_type").agg(*daily_metrics())
    return out.select(*DAILY_COLUMNS)


ZONE_MART_COLUMNS = [
    "started_month",
    "total_rides",
    "member_rides",
    "casual_rides",
    "weekday_rides",
    "weekend_rides",
    "electric_rides",
    "round_trip_rides",
    "night_owl_rides",
    "total_duration_seconds",
    "arrival_rides",
    "station_count",
    "area_km2",
    "centroid_lat",
    "centroid_lng",
    "population",
    "households",
    "median_household_income",
]


@dataclass
class Boundary:
    """Seeds of one boundary definition for the zone marts."""

    name: str
    zone_col: str
    station_zone: DataFrame  # station_id, zone_col
    zone_meta: DataFrame  # zone_col, [meta_cols], area_km2, centroid_lat, centroid_lng
    zone_pop: DataFrame  # zone_col, population, households, median_household_income
    meta_cols: tuple[str, ...] = ()


def zone_counts(fct: DataFrame, boundaries: list[Boundary], system: str) -> DataFrame:
    """(boundary, zone, started_month) counts of every boundary in ONE fact scan.

    Each ride is exploded into its departure and arrival side and counted by
    (station, start month) first; only these few rows meet the long station ->
    (boundary, zone) map and are summed by zone.  Arrivals use the ride's START
    month.  A cell is kept if it has departures or arrivals; the marts drop
    those without departures.
    """
    rides = fct.where(F.col("system") == system).select(
        "start_station_id", "end_station_id", "member_casual", "rideable_type", "duration_seconds",
        "started_dow", "is_round_trip", "is_night_owl", "started_month",
    )
    sides = rides.select(
        "*",
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("dep"), F.col("start_station_id").alias("sid")),
                F.struct(F.lit(False).alias("dep"), F.col("end_station_id").alias("sid")),
            )
        ).alias("side"),
    ).where(F.col("side.sid").isNotNull())
    long_map = None
    for b in boundaries:
        m = b.station_zone.select(
            F.col("station_id").alias("sid"), F.lit(b.name).alias("boundary"), F.col(b.zone_col).cast("string").alias("zone")
        ).where(F.col("zone").isNotNull())
        long_map = m if long_map is None else long_map.unionByName(m)
    dep = F.col("side.dep")

    def c(cond):
        return F.count_if(dep & cond)

    by_station = sides.groupBy(F.col("side.sid").alias("sid"), "started_month").agg(
        F.count_if(dep).alias("total_rides"),
        c(F.col("member_casual") == "member").alias("member_rides"),
        c(F.col("member_casual") == "casual").alias("casual_rides"),
        c(F.col("started_dow").between(1, 5)).alias("weekday_rides"),
        c(F.col("started_dow").isin(6, 7)).alias("weekend_rides"),
        c(F.col("rideable_type") == "electric_bike").alias("electric_rides"),
        c(F.col("is_round_trip")).alias("round_trip_rides"),
        c(F.col("is_night_owl")).alias("night_owl_rides"),
        F.sum(F.when(dep, F.col("duration_seconds"))).alias("total_duration_seconds"),
        F.count_if(~dep).alias("arrival_rides"),
    )
    counts = by_station.columns[2:]
    return by_station.join(long_map, "sid").groupBy("boundary", "zone", "started_month").agg(
        *[F.sum(c).alias(c) for c in counts]
    )


def zone_arrivals(counts: DataFrame, boundary: str) -> DataFrame:
    """D3: arrivals of every zone and start month that has any, with or without departures or meta."""
    own = counts.where((F.col("boundary") == boundary) & (F.col("arrival_rides") > 0))
    return own.select("zone", "started_month", "arrival_rides")


def zone_mart(counts: DataFrame, b: Boundary) -> DataFrame:
    """One boundary's mart from the shared counts: + meta (inner), population,
    station count (left)."""
    agg = counts.where((F.col("boundary") == b.name) & (F.col("total_rides") > 0)).drop("boundary").withColumn(
        b.zone_col, F.col("zone").cast(b.zone_meta.schema[b.zone_col].dataType)
    ).drop("zone")
    station_count = b.station_zone.groupBy(b.zone_col).agg(F.count(F.lit(1)).alias("station_count"))
    meta = b.zone_meta.select(b.zone_col, *b.meta_cols, "area_km2", "centroid_lat", "centroid_lng")
    pop = b.zone_pop.select(b.zone_col, "population", "households", "median_household_income")
    out = (
        agg.join(meta, b.zone_col, "inner")
        .join(pop, b.zone_col, "left")
        .join(station_count, b.zone_col, "left")
    )
    return out.select(b.zone_col, *b.meta_cols, *ZONE_MART_COLUMNS)


def zone_rollups(fct: DataFrame, boundaries: list[Boundary], system: str) -> dict[str, DataFrame]:
    """All boundary marts from one fact scan; the shared counts (zones x months x
    boundaries rows) are checkpointed once and split per boundary."""
    counts = written(zone_counts(fct, boundaries, system), "zone-counts")
    return {b.name: zone_mart(counts, b) for b in boundaries}


def zone_rollup(
    fct: DataFrame,
    station_zone: DataFrame,
    zone_meta: DataFrame,
    zone_pop: DataFrame,
    system: str,
    zone_col: str = "zone_id",
    meta_cols: tuple[str, ...] = (),
) -> DataFrame:
    """Zone x start-month mart of one boundary for one system."""
    b = Boundary(zone_col, zone_col, station_zone, zone_meta, zone_pop, tuple(meta_cols))
    return zone_mart(zone_counts(fct, [b], system), b)
