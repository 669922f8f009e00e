"""Explicit schemas (no inference anywhere)."""

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Raw landing columns of a trip CSV, all text (A1).
RAW_TRIP_COLUMNS = [
    "ride_id",
    "rideable_type",
    "started_at",
    "ended_at",
    "start_station_name",
    "start_station_id",
    "end_station_name",
    "end_station_id",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
    "member_casual",
]
RAW_TRIP_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_TRIP_COLUMNS])

# Staged / unioned ride columns in reference order (B1, G1).
STG_COLUMNS = RAW_TRIP_COLUMNS + ["_ingested_at", "_source_file", "system"]

# Fact columns in reference order.
FCT_COLUMNS = [
    "ride_id",
    "system",
    "rideable_type",
    "member_casual",
    "start_station_id",
    "start_station_name",
    "end_station_id",
    "end_station_name",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
    "started_at",
    "ended_at",
    "started_date",
    "started_hour",
    "started_dow",
    "started_dow_name",
    "started_month",
    "duration_seconds",
    "duration_minutes",
    "is_night_owl",
    "is_round_trip",
    "is_between_stations",
    "_ingested_at",
    "_source_file",
]

DIM_STATION_COLUMNS = ["system", "station_id", "station_name", "lat", "lng", "most_recent_observation_at"]

DAILY_COLUMNS = [
    "started_date",
    "system",
    "member_casual",
    "rideable_type",
    "total_rides",
    "total_hours_on_bike",
    "avg_ride_minutes",
    "shortest_ride_minutes",
    "longest_ride_minutes",
    "night_owl_rides",
    "round_trip_rides",
]

COORD_TYPE = DecimalType(18, 15)
MINUTES_TYPE = DecimalType(12, 2)
AREA_TYPE = DecimalType(18, 4)

# Seeds (A7): zone meta, population, station -> zone.
ZONE_META_SCHEMA = StructType(
    [
        StructField("zone_id", StringType(), False),
        StructField("zone_name", StringType(), True),
        StructField("area_km2", DoubleType(), True),
        StructField("centroid_lat", DoubleType(), True),
        StructField("centroid_lng", DoubleType(), True),
    ]
)
ZONE_POP_SCHEMA = StructType(
    [
        StructField("zone_id", StringType(), False),
        StructField("population", LongType(), True),
        StructField("households", LongType(), True),
        StructField("median_household_income", DoubleType(), True),
    ]
)
STATION_ZONE_SCHEMA = StructType(
    [StructField("station_id", StringType(), False), StructField("zone_id", StringType(), False)]
)

