"""Hot keys: one key holding a third of all rows must be collapsed before the shuffle."""

import datetime as dt

from helpers import T, ride, rides_df
from pyspark.sql import functions as F

from spokes.operators import facts, marts, stations


def _partial_before_exchange(df, marker) -> bool:
    """A line matching ``marker`` (a map-side partial step) sits below an exchange."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    ex = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    partial = [i for i, line in enumerate(lines) if marker(line)]
    return bool(ex) and bool(partial) and max(partial) > min(ex)  # partial sits below (after) the exchange line


def _partial_limit(line):
    return "WindowGroupLimit" in line and "Partial" in line


def _hot_rows(n_hot=300, n_other=600):
    t = T(2024, 1, 10, 9)
    hot = [ride("HOT", t, t + dt.timedelta(minutes=i % 50), s_id="7", ingested=T(2024, 2, 1) + dt.timedelta(hours=i))
           for i in range(n_hot)]
    other = [ride(f"r{i}", t, t + dt.timedelta(minutes=3), s_id=str(i % 5)) for i in range(n_other)]
    return hot + other


def test_hot_ride_id_dedup_is_partial_and_exact(spark):
    df = rides_df(spark, _hot_rows()).repartition(8)
    d = facts.dedup_latest(df)
    assert _partial_before_exchange(d, _partial_limit)
    hot = d.where(F.col("ride_id") == "HOT").collect()
    assert len(hot) == 1 and hot[0]["_ingested_at"] == T(2024, 2, 1) + dt.timedelta(hours=299)
    assert d.count() == 601


def test_hot_station_dimension_is_partial(spark):
    df = rides_df(spark, _hot_rows()).repartition(8)
    maxima = stations.latest_observation_times(stations.station_observations(df))
    assert _partial_before_exchange(maxima, lambda line: "partial_max" in line)
    dim = stations.dim_stations(df)
    plan = dim._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan  # observations filtered map-side against the maxima
    assert dim.where(F.col("station_id") == "7").count() == 1


def test_daily_mart_aggregates_partially(spark):
    fct = facts.fct_rides(rides_df(spark, _hot_rows()).repartition(8))
    daily = marts.agg_rides_daily(fct)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert daily.agg(F.sum("total_rides")).first()[0] == fct.count()


def test_station_seen_only_with_null_times_is_kept(spark):
    t = T(2024, 1, 10, 9)
    rows = [ride("a", None, None, s_id="9", e_id=None), ride("b", None, None, s_id="9", e_id=None, s_name="S9b"),
            ride("c", t, t, s_id="1", e_id=None)]
    dim = {r["station_id"]: r for r in stations.dim_stations(rides_df(spark, rows)).collect()}
    assert set(dim) == {"1", "9"} and dim["9"]["station_name"] == "S9"
