"""Station dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DIM_STATION_COLUMNS
from .dedup import latest_by_key
from ..session import written


def station_observations(rides: DataFrame) -> DataFrame:
    """Start and end sightings of every station, one scan.

    ``explode(array(start, end))`` reads each ride once instead of scanning
    the union twice for a UNION ALL.
    """
    obs = rides.select(
        "system",
        F.explode(
            F.array(
                F.struct(
                    F.col("start_station_id").alias("station_id"),
                    F.col("start_station_name").alias("station_name"),
                    F.col("start_lat").alias("lat"),
                    F.col("start_lng").alias("lng"),
                    F.col("started_at").alias("observed_at"),
                ),
                F.struct(
                    F.col("end_station_id").alias("station_id"),
                    F.col("end_station_name").alias("station_name"),
                    F.col("end_lat").alias("lat"),
                    F.col("end_lng").alias("lng"),
                    F.col("ended_at").alias("observed_at"),
                ),
            )
        ).alias("o"),
    )
    return obs.select("system", "o.*").where(F.col("station_id").isNotNull())


STATION_ORDER = [("observed_at", "desc"), "station_name", "lat", "lng"]


def latest_observation_times(obs: DataFrame) -> DataFrame:
    """MAX(observed_at) per (system, station_id): a hash aggregate with
    map-side partial aggregation, one output row per station."""
    return obs.groupBy("system", "station_id").agg(F.max("observed_at").alias("_latest"))


def dim_stations(rides: DataFrame) -> DataFrame:
    """Latest observation per (system, station_id)  (E2).

    Two column-pruned passes instead of sorting every observation (the first
    runs when this function is called, to materialise the per-station maxima):

    1. a hash aggregate of MAX(observed_at) per station (partial aggregation,
       so a station seen in a third of all rides still ships one row per map
       task), written as a table, so that the planner knows its bytes;
    2. observations at that time (normally one per station) are kept by a join
       (map-side while that table is under the broadcast threshold), and ties are resolved by the full order
       (name, lat, lng) with ``latest_by_key`` on that small remainder.

    NULL observation times rank last (a defect in the source, never a
    winner); a station seen only with NULL times keeps those rows as its
    candidates (null-safe match).
    """
    obs = station_observations(rides)
    latest_time = written(latest_observation_times(obs), "station-latest")
    cand = obs.join(latest_time, ["system", "station_id"]).where(
        F.col("observed_at").eqNullSafe(F.col("_latest"))
    ).drop("_latest")
    latest = latest_by_key(cand, ["system", "station_id"], STATION_ORDER)
    return latest.select(
        "system", "station_id", "station_name", "lat", "lng", F.col("observed_at").alias("most_recent_observation_at")
    ).select(*DIM_STATION_COLUMNS)


def merge_dim(dim: DataFrame, fresh_rides: DataFrame) -> DataFrame:
    """The dimension after some more rides: the latest of the old rows and the new rides' observations."""
    old = dim.withColumnRenamed("most_recent_observation_at", "observed_at")
    new = dim_stations(fresh_rides).withColumnRenamed("most_recent_observation_at", "observed_at")
    latest = latest_by_key(old.unionByName(new), ["system", "station_id"], STATION_ORDER)
    return latest.withColumnRenamed("observed_at", "most_recent_observation_at").select(*DIM_STATION_COLUMNS)


def all_stations_geo(dim: DataFrame, systems) -> DataFrame:
    """Every station with coordinates, ordered."""
    return (
        dim.where(F.col("system").isin(list(systems)) & F.col("lat").isNotNull() & F.col("lng").isNotNull())
        .select("system", "station_id", "station_name", "lat", "lng")
        .orderBy("system", "station_id")
    )
