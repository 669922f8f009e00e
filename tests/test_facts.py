import datetime as dt

from helpers import T, ride, rides_df
from pyspark.sql import functions as F

from spokes.operators import facts


def _one(spark, rows, keys=("ride_id",)):
    return {r["ride_id"]: r for r in facts.fct_rides(rides_df(spark, rows), keys).collect()}


def test_duration_rounds_half_away_from_zero(spark):
    start = T(2024, 1, 1, 10, 0, 0)
    rows = [
        ride("a", start, start + dt.timedelta(seconds=2, microseconds=500000)),
        ride("b", start, start + dt.timedelta(seconds=2, microseconds=499999)),
        ride("c", start, start + dt.timedelta(seconds=0.3 * 60)),  # 0.005 min -> 0.01
    ]
    out = _one(spark, rows)
    assert out["a"]["duration_seconds"] == 3
    assert out["b"]["duration_seconds"] == 2
    assert str(out["a"]["duration_minutes"]) == "0.04"
    assert str(out["c"]["duration_minutes"]) == "0.30"


def test_time_slices_sunday_late_and_hour_boundaries(spark):
    sun = T(2024, 1, 7, 23, 59, 30)  # a Sunday
    rows = [ride("s", sun, sun + dt.timedelta(minutes=5)), ride("h4", T(2024, 1, 8, 4, 59), T(2024, 1, 8, 5, 10)),
            ride("h5", T(2024, 1, 8, 5, 0), T(2024, 1, 8, 5, 10))]
    out = _one(spark, rows)
    assert out["s"]["started_dow"] == 7 and out["s"]["started_dow_name"] == "Sunday   "
    assert out["s"]["started_hour"] == 23 and out["s"]["started_month"] == dt.date(2024, 1, 1)
    assert out["h4"]["is_night_owl"] is True and out["h5"]["is_night_owl"] is False
    assert out["h4"]["started_dow"] == 1


def test_station_flags_with_nulls(spark):
    t = T(2024, 1, 1, 12)
    rows = [ride("same", t, t, "1", "1"), ride("diff", t, t, "1", "2"), ride("s_null", t, t, None, "2"),
            ride("e_null", t, t, "1", None), ride("both", t, t, None, None)]
    out = _one(spark, rows)
    assert out["same"]["is_round_trip"] is True and out["same"]["is_between_stations"] is False
    assert out["diff"]["is_round_trip"] is False and out["diff"]["is_between_stations"] is True
    assert out["s_null"]["is_round_trip"] is None and out["s_null"]["is_between_stations"] is True
    assert out["e_null"]["is_between_stations"] is True
    assert out["both"]["is_round_trip"] is None and out["both"]["is_between_stations"] is False
    # zero-duration inter-station ride is kept (ended == started)
    assert out["diff"]["duration_seconds"] == 0


def test_latest_copy_wins_and_filter_after_dedup(spark):
    t = T(2024, 1, 31, 23, 50)
    rows = [
        ride("r1", t, t + dt.timedelta(minutes=20), ingested=T(2024, 2, 1)),
        ride("r1", t, t + dt.timedelta(minutes=30), ingested=T(2024, 3, 1)),  # newer copy wins
        ride("r2", t, t + dt.timedelta(minutes=5), ingested=T(2024, 2, 1)),
        ride("r2", t, t - dt.timedelta(minutes=5), ingested=T(2024, 3, 1)),  # newest copy invalid
    ]
    out = _one(spark, rows)
    assert out["r1"]["duration_seconds"] == 1800
    assert out["r1"]["ended_at"].month == 2  # ride ending next month keeps its start month
    assert "r2" not in out  # full refresh drops the ride (B3 after dedup)


def test_equal_ingest_time_ties_are_deterministic(spark):
    t = T(2024, 1, 5, 8)
    a = ride("r", t, t + dt.timedelta(minutes=9), s_id="5")
    b = ride("r", t, t + dt.timedelta(minutes=9), s_id="3")
    for rows in ([a, b], [b, a]):
        assert _one(spark, rows)["r"]["start_station_id"] == "3"


def test_same_ride_id_in_two_systems(spark):
    t = T(2024, 1, 5, 8)
    rows = [ride("x", t, t + dt.timedelta(minutes=3), system="alpha"),
            ride("x", t, t + dt.timedelta(minutes=3), system="beta")]
    assert facts.fct_rides(rides_df(spark, rows)).count() == 1
    assert facts.fct_rides(rides_df(spark, rows), ("system", "ride_id")).count() == 2


def test_fixture_invariants(spark):
    from conftest import SF_SMALL
    from spokes.plans import warehouse

    wh = warehouse.fixture_warehouse(spark, SF_SMALL)
    n_fct = wh.fct.count()
    daily = wh.daily.agg(F.sum("total_rides"), F.sum("night_owl_rides")).first()
    assert daily[0] == n_fct
    assert wh.fct.select("ride_id").distinct().count() == n_fct
    assert wh.fct.where(F.col("ended_at") < F.col("started_at")).count() == 0
    assert daily[1] == wh.fct.where("is_night_owl").count()


def test_lenient_staging_and_cast_failures(spark):
    from spokes.operators import staging
    from spokes.schemas import RAW_TRIP_COLUMNS

    row = dict.fromkeys(RAW_TRIP_COLUMNS, None)
    good = {**row, "ride_id": "a", "started_at": "2024-01-01 10:00:00", "ended_at": "2024-01-01 10:05:00",
            "start_lat": "38.9", "start_lng": "-77.0"}
    bad = {**row, "ride_id": "b", "started_at": "not a time", "ended_at": "2024-01-01 10:05:00", "start_lat": "x"}
    none = {**row, "ride_id": None}
    raw = spark.createDataFrame([tuple(r[c] for c in RAW_TRIP_COLUMNS) + ("f.csv",) for r in (good, bad, none)],
                                ", ".join(f"{c} string" for c in RAW_TRIP_COLUMNS) + ", _source_file string")
    staged = staging.stage_trips(raw, "alpha", "double", strict=False).collect()
    assert [r["ride_id"] for r in staged] == ["a", "b"] and staged[1]["started_at"] is None
    fails = staging.cast_failures(raw).first()
    assert fails["started_at"] == 1 and fails["start_lat"] == 1 and fails["ended_at"] == 0
