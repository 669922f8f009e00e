import datetime as dt

from pyspark.sql import functions as F

from spokes.operators import marts, quality, zones

D = dt.date
FCT_DDL = ("system string, start_station_id string, end_station_id string, member_casual string, "
           "rideable_type string, duration_seconds int, started_dow int, is_round_trip boolean, "
           "is_night_owl boolean, started_month date")


def _fct(spark, rows):
    return spark.createDataFrame(rows, FCT_DDL)


def _seeds(spark):
    mapping = spark.createDataFrame([("1", "Z1"), ("2", "Z2"), ("3", "Z3"), ("4", "ZX")], "station_id string, zone_id string")
    meta = spark.createDataFrame([("Z1", 1.5, 38.9, -77.0), ("Z2", 2.0, 38.9, -77.1), ("Z3", 0.0, 38.8, -77.0)],
                                 "zone_id string, area_km2 double, centroid_lat double, centroid_lng double")
    pop = spark.createDataFrame([("Z1", 1000, 400, 50000.0), ("Z3", 0, 0, None)],
                                "zone_id string, population bigint, households bigint, median_household_income double")
    return mapping, meta, pop


def test_zone_rollup_semantics(spark):
    m = D(2024, 1, 1)
    rows = [
        ("alpha", "1", "2", "member", "electric_bike", 600, 6, False, True, m),
        ("alpha", "1", "1", "casual", "classic_bike", 300, 2, True, False, m),
        ("alpha", "3", "2", "member", "classic_bike", 100, 1, False, False, m),
        ("alpha", "4", "1", "member", "classic_bike", 100, 1, False, False, m),  # zone missing from meta
        ("beta", "1", "2", "member", "classic_bike", 100, 1, False, False, m),   # other system
    ]
    mapping, meta, pop = _seeds(spark)
    out = {r["zone_id"]: r for r in marts.zone_rollup(_fct(spark, rows), mapping, meta, pop, "alpha").collect()}
    assert set(out) == {"Z1", "Z3"}  # Z2 only has arrivals -> dropped; ZX not in meta -> dropped
    z1 = out["Z1"]
    assert (z1.total_rides, z1.member_rides, z1.casual_rides, z1.weekend_rides, z1.weekday_rides) == (2, 1, 1, 1, 1)
    assert (z1.electric_rides, z1.round_trip_rides, z1.night_owl_rides, z1.total_duration_seconds) == (1, 1, 1, 900)
    assert z1.arrival_rides == 2 and z1.station_count == 1 and z1.population == 1000
    assert out["Z3"].arrival_rides == 0 and out["Z3"].median_household_income is None


def test_zone_metrics_ratios_and_zero_divisors(spark):
    m = D(2024, 1, 1)
    rows = [("alpha", "1", "2", "member", "electric_bike", 90, 6, False, False, m)] * 3 + [
        ("alpha", "3", "2", "member", "classic_bike", 100, 1, False, False, m)]
    mapping, meta, pop = _seeds(spark)
    mart = marts.zone_rollup(_fct(spark, rows), mapping, meta, pop, "alpha")
    out = {r["zone_id"]: r for r in zones.zone_metrics(mart, "zone_id", m, m).collect()}
    z1 = out["Z1"]
    assert z1.avg_duration_minutes == 1.5 and z1.electric_pct == 100.0 and z1.rides_per_km2 == 2.0
    assert z1.rides_per_1k_residents == 3.0 and z1.net_flow == -3
    assert out["Z3"].rides_per_km2 is None and out["Z3"].rides_per_1k_residents is None


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "y"), ("b", "zz")], "k string, v string")
    suite = quality.ModelChecks("t").unique("k").not_null("k", "v").accepted_values("v", ["x", "y"])
    res = {r["test"]: r["failures"] for r in quality.run_checks(df, suite).collect()}
    assert res == {"unique_t_k": 1, "not_null_t_k": 1, "not_null_t_v": 1, "accepted_values_t_v": 1}
    rep = {r["status"]: r["n"] for r in quality.report(quality.run_checks(df, suite)).collect()}
    assert rep == {"ERROR": 4}


def test_unique_combination_groups_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "a string, b int")
    assert quality.unique_violations(df, ["a", "b"]).count() == 1
    assert quality.unique_violations(df, ["a"]).count() == 0


def test_freshness_thresholds(spark):
    df = spark.createDataFrame([("s1", dt.datetime(2024, 3, 1)), ("s2", dt.datetime(2024, 1, 20)),
                                ("s3", dt.datetime(2023, 12, 1))], "src string, loaded timestamp_ntz")
    out = {r["source"]: r["status"] for r in quality.freshness(df, "src", "loaded", dt.datetime(2024, 3, 15)).collect()}
    assert out == {"s1": "pass", "s2": "warn", "s3": "error"}
    assert F is not None


def test_all_boundaries_in_one_scan_equal_single_rollups(spark):
    from conftest import SF_MID
    from spokes.plans import registry
    from spokes.sources import zones as zone_src

    wh = registry._wh(spark, SF_MID)
    specs, singles = [], {}
    for name, spec in zone_src.BOUNDARIES.items():
        _, meta, pop, mapping = registry.zone_inputs(spark, SF_MID, name, wh)
        display = (spec["display_col"],) if spec["display_col"] else ()
        specs.append(marts.Boundary(name, spec["id_col"], mapping, meta, pop, display))
        singles[name] = registry.zone_mart(spark, SF_MID, name, wh)
    multi = marts.zone_rollups(wh.fct, specs, registry.ZONE_SYSTEM)
    for name in zone_src.BOUNDARIES:
        a = sorted(tuple(r) for r in multi[name].collect())
        b = sorted(tuple(r) for r in singles[name].collect())
        assert a == b and len(a) > 0
