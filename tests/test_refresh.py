import datetime as dt

from pyspark.sql import functions as F

from spokes.plans import refresh as R
from spokes.session import work_dir
from spokes.sources import fixtures, trips_csv


def test_refresh_end_to_end_and_rerun(spark):
    from conftest import SF_SMALL

    unioned = fixtures.staged_trips(spark, SF_SMALL)
    landing, root = work_dir(spark, "t-landing"), work_dir(spark, "t-root")
    rows = unioned["alpha"].unionByName(unioned["beta"])
    trips_csv.write_raw_csvs(rows, landing)
    mapping = spark.createDataFrame([(str(i), f"Z{i % 3}") for i in range(10)], "station_id string, zone_id string")
    meta = spark.createDataFrame([(f"Z{i}", 1.0 + i, 38.9, -77.0) for i in range(3)],
                                 "zone_id string, area_km2 double, centroid_lat double, centroid_lng double")
    pop = spark.createDataFrame([("Z0", 100, 40, 1.0)], "zone_id string, population bigint, households bigint, "
                                                      "median_household_income double")
    cfg = R.RefreshConfig(landing=landing, root=root, patterns=trips_csv.FIXTURE_SYSTEM_PATTERNS,
                          coord_type="double", zone_system="beta",
                          boundaries=(R.ZoneBoundary("zone", "zone_id", mapping, meta, pop),))
    out = R.refresh(spark, cfg, as_of=dt.datetime(2024, 3, 15))
    loaded = {r["status"]: r["n"] for r in trips_csv.ingest_summary(out["ingest"]).collect()}
    assert loaded["loaded"] == 3
    report = {r["status"]: r["n"] for r in out["dq_report"].collect()}
    assert report.get("ERROR", 0) == 0
    fct = spark.read.parquet(f"{root}/fct_rides")
    n1 = fct.count()
    assert n1 == fct.select("ride_id").distinct().count()
    assert spark.read.parquet(f"{root}/agg_rides_by_zone").count() > 0
    # second run: nothing new lands, incremental fact is unchanged
    out2 = R.refresh(spark, cfg)
    assert {r["status"]: r["n"] for r in trips_csv.ingest_summary(out2["ingest"]).collect()}["loaded"] == 0
    assert spark.read.parquet(f"{root}/fct_rides").count() == n1
    assert F is not None


def test_shuffle_sizing_only_raises(spark):
    from spokes.session import size_shuffles

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "300")
        assert size_shuffles(spark, 10) == 300  # small input never lowers it
        assert spark.conf.get("spark.sql.shuffle.partitions") == "300"
        # 100 TB of Parquet: as many as it takes, partitions stay at ~256 MB
        assert 1_200_000 <= size_shuffles(spark, 100 * 1024**4) <= 1_240_000
        # 1 TB -> ~12k partitions of ~256 MB decoded
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        assert 12_000 <= size_shuffles(spark, 1024**4) <= 12_400
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_cli_refresh(spark, capsys):
    from conftest import SF_SMALL
    from spokes import cli

    unioned = fixtures.staged_trips(spark, SF_SMALL)
    landing, root = work_dir(spark, "cli-landing"), work_dir(spark, "cli-root")
    trips_csv.write_raw_csvs(unioned["alpha"].unionByName(unioned["beta"]), landing)
    assert cli.main(["refresh", "--landing", landing, "--root", root, "--fixture-systems"]) == 0
    out = capsys.readouterr().out
    assert "loaded: 3" in out and "ERROR=0" in out


def test_cli_builds_zone_marts(spark, tmp_path, capsys):
    """One run from landed files, GeoJSON layers and a census response writes the zone mart; seeds give the others."""
    import json

    from conftest import SF_SMALL
    from spokes import cli

    unioned = fixtures.staged_trips(spark, SF_SMALL)
    landing, root = work_dir(spark, "cli-landing"), work_dir(spark, "cli-root")
    trips_csv.write_raw_csvs(unioned["alpha"].unionByName(unioned["beta"]), landing)
    beta = unioned["beta"].where("start_lat is not null and start_lng is not null")
    x0, x1, y0, y1 = beta.agg(F.min("start_lng"), F.max("start_lng"), F.min("start_lat"), F.max("start_lat")).first()
    mid = (x0 + x1) / 2

    def box(a, b):
        return {"type": "Polygon", "coordinates": [[[a, y0 - 1e-3], [b, y0 - 1e-3], [b, y1 + 1e-3], [a, y1 + 1e-3],
                                                    [a, y0 - 1e-3]]]}

    def layer(name, prop, parts):
        feats = [{"type": "Feature", "properties": {prop: k}, "geometry": g} for k, g in parts.items()]
        (tmp_path / name).write_text(json.dumps({"type": "FeatureCollection", "features": feats}))
        return str(tmp_path / name)

    zones = layer("zones.json", "zone_id", {"west": box(x0 - 1e-3, mid), "east": box(mid, x1 + 1e-3)})
    tracts = layer("tracts.json", "GEOID", {"11001000100": box(x0 - 1e-3, x1 + 1e-3)})
    header = ["NAME", "B01003_001E", "B11001_001E", "B19013_001E", "state", "county", "tract"]
    (tmp_path / "census.json").write_text("[" + json.dumps(header) + ",\n" + json.dumps(
        ["T", "1000.0", "400", "50000", "11", "001", "000100"]) + "]")
    seeds = tmp_path / "seeds"
    seeds.mkdir()
    ids = [r[0] for r in beta.select("start_station_id").where("start_station_id is not null").distinct().collect()]
    (seeds / "dc_station_clusters.csv").write_text("station_id,cluster_id\n" + "".join(f"{i},C1\n" for i in ids))
    (seeds / "dc_clusters.csv").write_text('cluster_id,cluster_display_name,area_km2,centroid_lat,centroid_lng\n'
                                           'C1,"One, and all",1.5,38.9,-77.0\n')
    (seeds / "dc_cluster_population.csv").write_text("cluster_id,population,households,median_household_income\nC1,5,2,1.0\n")
    args = ["refresh", "--landing", landing, "--root", root, "--fixture-systems", "--zone-system", "beta",
            "--seeds", str(seeds), "--zone-layer", zones, "--tract-layer", tracts, "--census", str(tmp_path / "census.json")]
    assert cli.main(args) == 0
    assert "freshness: alpha=pass  beta=pass" in capsys.readouterr().out
    mart = spark.read.parquet(f"{root}/agg_rides_by_zone")
    assert {r.zone_id for r in mart.select("zone_id").distinct().collect()} == {"west", "east"}
    people = {r.zone_id: r.population for r in mart.select("zone_id", "population").distinct().collect()}
    assert abs(sum(people.values()) - 1000) <= 1
    by_cluster = spark.read.parquet(f"{root}/agg_rides_by_cluster")
    departures = spark.read.parquet(f"{root}/fct_rides").where("system = 'beta' and start_station_id is not null").count()
    assert by_cluster.agg(F.sum("total_rides")).first()[0] == departures


def test_marts_follow_the_touched_months(spark, monkeypatch):
    """After a second landing the incremental marts and dimension equal those of a full refresh; untouched months
    are not written again, and a run that failed after the fact is made up for."""
    from conftest import SF_SMALL

    from spokes.schemas import DAILY_COLUMNS, DIM_STATION_COLUMNS

    unioned = fixtures.staged_trips(spark, SF_SMALL)
    rows = unioned["alpha"].unionByName(unioned["beta"])
    late = F.col("_source_file") == "alpha-tripdata_2.csv"
    landing, root, fresh = (work_dir(spark, x) for x in ("m-landing", "m-root", "m-fresh"))
    mapping = spark.createDataFrame([(str(i), f"Z{i % 3}") for i in range(100)], "station_id string, zone_id string")
    meta = spark.createDataFrame([(f"Z{i}", 1.0 + i, 38.9, -77.0) for i in range(3)],
                                 "zone_id string, area_km2 double, centroid_lat double, centroid_lng double")
    pop = spark.createDataFrame([("Z0", 100, 40, 1.0)], "zone_id string, population bigint, households bigint, "
                                                      "median_household_income double")

    def run(to):
        return R.refresh(spark, R.RefreshConfig(
            landing=landing, root=to, patterns=trips_csv.FIXTURE_SYSTEM_PATTERNS, coord_type="double",
            zone_system="alpha", boundaries=(R.ZoneBoundary("zone", "zone_id", mapping, meta, pop),)))

    def tables(of):
        read = lambda name: spark.read.parquet(f"{of}/{name}")
        zone = read("agg_rides_by_zone")
        return [sorted(map(str, df.collect())) for df in (
            read("agg_rides_daily").select(*DAILY_COLUMNS), read("dim_stations").select(*DIM_STATION_COLUMNS),
            zone.select(*sorted(zone.columns)))]

    trips_csv.write_raw_csvs(rows.where(~late), landing)
    run(root)
    trips_csv.write_raw_csvs(rows.where(late), landing)
    with monkeypatch.context() as m:
        m.setattr(R.marts, "agg_rides_daily", lambda fct: 1 / 0)
        try:
            run(root)
            raise AssertionError("the run should have failed")
        except ZeroDivisionError:
            pass
    written_again = []
    replace_months = R._replace_months
    monkeypatch.setattr(R, "_replace_months", lambda s, mart, path, col, months, *order: written_again.append(
        months) or replace_months(s, mart, path, col, months, *order))
    run(root)
    assert written_again and all(months for months in written_again)
    run(fresh)
    assert tables(root) == tables(fresh)
    written_again.clear()
    run(root)
    assert not written_again
