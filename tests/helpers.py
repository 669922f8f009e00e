"""Tiny frame builders for unit tests."""

import datetime as dt

from spokes.schemas import STG_COLUMNS

T = dt.datetime


def ride(ride_id, start, end, s_id="1", e_id="2", system="alpha", ingested=T(2024, 2, 1), member="member",
         bike="classic_bike", source="f.csv", s_name=None, e_name=None, lat=38.9, lng=-77.0):
    return {
        "ride_id": ride_id, "rideable_type": bike, "started_at": start, "ended_at": end,
        "start_station_name": s_name if s_name is not None else (None if s_id is None else f"S{s_id}"),
        "start_station_id": s_id,
        "end_station_name": e_name if e_name is not None else (None if e_id is None else f"S{e_id}"),
        "end_station_id": e_id,
        "start_lat": None if s_id is None else lat, "start_lng": None if s_id is None else lng,
        "end_lat": None if e_id is None else lat, "end_lng": None if e_id is None else lng,
        "member_casual": member, "_ingested_at": ingested, "_source_file": source, "system": system,
    }


STG_DDL = (
    "ride_id string, rideable_type string, started_at timestamp_ntz, ended_at timestamp_ntz, "
    "start_station_name string, start_station_id string, end_station_name string, end_station_id string, "
    "start_lat double, start_lng double, end_lat double, end_lng double, member_casual string, "
    "_ingested_at timestamp_ntz, _source_file string, system string"
)


def rides_df(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in STG_COLUMNS) for r in rows], STG_DDL)
