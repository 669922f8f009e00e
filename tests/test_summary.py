"""Counts and station sets kept by month against the rides."""

import datetime as dt
import random

from conftest import SF_SMALL
from helpers import T, ride, rides_df

from spokes.filters import RideFilter
from spokes.operators import facts, incremental, kpis, summary
from spokes.plans import registry
from spokes.session import work_dir

YEAR = RideFilter(("alpha", "beta"), dt.date(2024, 1, 1), dt.date(2024, 12, 1))
SPRING = RideFilter(("alpha",), dt.date(2024, 3, 1), dt.date(2024, 2, 1))


def rides(rng, n, day, months=(1, 4)):
    return [ride(str(rng.randint(0, 200)), T(2024, m := rng.randint(*months), rng.randint(1, 20), h := rng.randint(0, 20)), T(2024, m, 28, h),
                 s_id=rng.choice(["1", "2", "3", None, f"x{rng.randint(0, 60)}"]), e_id=rng.choice(["1", "2", None]),
                 system=rng.choice(["alpha", "beta"]), ingested=T(2024, 12, day)) for _ in range(n)]


def same(kept, fct):
    for f in (YEAR, SPRING):
        for query in (kpis.rides_by_hour, kpis.rides_by_dow, kpis.active_stations, kpis.top_routes, kpis.station_counts):
            more = [(side,) for side in ("start", "end")] if query is kpis.station_counts else [()]
            for m in more:
                a, b = query(kept, f, *m), query(fct, f, *m)
                assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect())), (query, f, m)


def test_summary_follows_the_fact(spark):
    rng = random.Random(3)
    path, root = work_dir(spark, "t-fact"), work_dir(spark, "t-summary")
    incremental.write_fact(facts.fct_rides(rides_df(spark, rides(rng, 150, 1))), path)
    kept = summary.update(spark, incremental.read_fact(spark, path), root)
    same(kept, incremental.read_fact(spark, path))
    for frame in (kept.counts, kept.stations):  # no ride is read
        assert all(root in p for p in frame.inputFiles())
    for day in (2, 3):
        months = []
        batch = rides(rng, 40, day) if day == 2 else [  # every ride of January moves to June: the month is empty
            ride(r.ride_id, T(2024, 6, 1, 1), T(2024, 6, 1, 2), system=r.system, s_id="new", ingested=T(2024, 12, day))
            for r in incremental.read_fact(spark, path).where("month(started_month) = 1").collect()]
        incremental.apply_batch(spark, rides_df(spark, batch), path, on_touch=months.extend)
        kept = summary.update(spark, incremental.read_fact(spark, path), root, months)
        same(kept, incremental.read_fact(spark, path))
    assert kept.counts.where("month(started_month) = 1").isEmpty() and kept.stations.where("month(started_month) = 1").isEmpty()


def test_many_stations_fill_many_bitmaps(spark):
    fct = spark.range(100_000).selectExpr("'alpha' AS system", "concat('s', id % 70000) AS start_station_id",
                                          "make_date(2024, 1 + id % 3, 1) AS started_month")
    codes = summary.new_codes(fct, None).checkpoint()
    assert codes.select("code").distinct().count() == codes.count() == 70_000
    kept = summary.Summary(None, summary.station_bitmaps(fct, codes))
    assert kept.active_stations(YEAR).collect()[0].active_stations == 70_000
    assert kept.active_stations(RideFilter(("alpha",), dt.date(2024, 1, 1), dt.date(2024, 1, 1))).collect()[0].active_stations == (
        fct.where("month(started_month) = 1").select("start_station_id").distinct().count())
    more = summary.new_codes(fct.selectExpr("system", "concat(start_station_id, 'b') AS start_station_id", "started_month").limit(10), codes)
    assert more.join(codes, "code").count() == 0


def test_a_summary_query_makes_its_rides_once(spark, monkeypatch):
    plans, update = [], summary.update
    monkeypatch.setattr(summary, "update", lambda s, fct, root: plans.append(fct._jdf.queryExecution().optimizedPlan().toString()) or update(s, fct, root))
    got = registry.REGISTRY["lattice_rides_by_dow"](spark, SF_SMALL).collect()
    want = kpis.rides_by_dow(registry._wh(spark, SF_SMALL).fct, registry.FILTER).collect()
    assert got == want and len(plans) == 1 and "Window" not in plans[0] and "Join" not in plans[0]
