"""Ride fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rides as R
from ..schemas import FCT_COLUMNS
from .dedup import latest_by_key

# Survivor order for republished rides: the most recently loaded copy wins;
# the remaining terms make the choice total (FIXTURES.md §2).
DEDUP_ORDER = [
    ("_ingested_at", "desc"),
    "system",
    ("started_at", "desc"),
    ("ended_at", "desc"),
    "start_station_id",
    "end_station_id",
    "rideable_type",
    "member_casual",
]


def dedup_latest(rides: DataFrame, keys: Sequence[str] = ("ride_id",), order=DEDUP_ORDER) -> DataFrame:
    """One row per ride: the most recently ingested copy.

    ``keys=("ride_id",)`` matches the reference (ids collide across systems);
    ``("system", "ride_id")`` is the safer choice for new deployments.
    """
    return latest_by_key(rides, list(keys), order)


def ride_features(rides: DataFrame) -> DataFrame:
    """Derived time slices, durations and flags, in fact-column order."""
    start = F.col("started_at")
    hour = F.hour(start).cast("int")
    micros = R.duration_micros()
    derived = rides.withColumns(
        {
            "started_date": F.to_date(start),
            "started_hour": hour,
            "started_dow": R.iso_dow(start),
            "started_dow_name": R.dow_name(start),
            "started_month": R.month_start(start),
            "duration_seconds": R.duration_seconds(micros),
            "duration_minutes": R.duration_minutes(micros),
            "is_night_owl": R.is_night_owl(hour),
            "is_round_trip": R.is_round_trip(F.col("start_station_id"), F.col("end_station_id")),
            "is_between_stations": R.is_between_stations(F.col("start_station_id"), F.col("end_station_id")),
        }
    )
    return derived.select(*FCT_COLUMNS)


def physically_possible(fct: DataFrame) -> DataFrame:
    """Drop rides that end before they start (B3), applied after dedup."""
    return fct.where(F.col("ended_at") >= F.col("started_at"))


def fct_rides(unioned: DataFrame, keys: Sequence[str] = ("ride_id",)) -> DataFrame:
    """Full-refresh build of the fact: dedup -> features -> B3."""
    return physically_possible(ride_features(dedup_latest(unioned, keys)))
