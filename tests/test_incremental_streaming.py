import datetime as dt

from helpers import T, ride, rides_df
from pyspark.sql import functions as F

from spokes.operators import facts, incremental
from spokes.schemas import FCT_COLUMNS
from spokes.session import work_dir


def _rows(df):
    return sorted(tuple(r) for r in df.select(*FCT_COLUMNS).collect())


def test_incremental_equals_full_refresh_when_copies_valid(spark):
    t = T(2024, 1, 31, 23, 0)
    batch1 = [ride("a", t, t + dt.timedelta(minutes=10), ingested=T(2024, 2, 1)),
              ride("b", t, t + dt.timedelta(minutes=20), ingested=T(2024, 2, 1))]
    batch2 = [ride("a", t + dt.timedelta(days=1), t + dt.timedelta(days=1, minutes=5), ingested=T(2024, 3, 1)),
              ride("c", t, t + dt.timedelta(minutes=1), ingested=T(2024, 3, 1))]
    path = work_dir(spark, "t-fct")
    incremental.write_fact(facts.fct_rides(rides_df(spark, batch1)), path)
    everything = rides_df(spark, batch1 + batch2)
    assert incremental.run_incremental(spark, everything, path) == 2
    got = spark.read.parquet(path)
    assert _rows(got) == _rows(facts.fct_rides(everything))
    # 'a' moved from January to February: the old partition no longer holds it
    assert got.where(F.col("ride_id") == "a").count() == 1
    # replaying the same run is a no-op (watermark) and the upsert itself is idempotent
    assert incremental.run_incremental(spark, everything, path) == 0
    incremental.apply_batch(spark, rides_df(spark, batch2), path)
    assert _rows(spark.read.parquet(path)) == _rows(facts.fct_rides(everything))


def test_schema_sync_adds_and_drops(spark):
    target = spark.createDataFrame([(1, "x")], "a int, b string")
    batch = spark.createDataFrame([(2, 3.0)], "a int, c double")
    out = incremental.schema_sync(target, batch.schema)
    assert out.columns == ["a", "c"] and out.first()["c"] is None


def test_stream_ingest_reruns_add_nothing(spark):
    from spokes.plans import registry

    from conftest import SF_SMALL

    df = registry.REGISTRY["stream_ingest"](spark, SF_SMALL)
    assert df.count() == registry.REGISTRY["rides_unioned"](spark, SF_SMALL).count()


def test_landing_runs_are_idempotent(spark):
    from spokes.plans import registry

    from conftest import SF_SMALL

    runs = registry.landing_runs(spark, SF_SMALL)
    s3 = {r["status"]: r["n"] for r in registry.trips_csv.ingest_summary(runs["run3"]).collect()}
    assert s3["loaded"] == 0 and s3["skipped"] == 4
    assert runs["raw"].count() == registry.REGISTRY["rides_unioned"](spark, SF_SMALL).count()


def test_strict_upsert_deletes_ride_whose_newest_copy_is_invalid(spark):
    t = T(2024, 1, 5, 12)
    first = [ride("a", t, t + dt.timedelta(minutes=10), ingested=T(2024, 2, 1)),
             ride("b", t, t + dt.timedelta(minutes=10), ingested=T(2024, 2, 1))]
    newer_invalid = [ride("a", t, t - dt.timedelta(minutes=1), ingested=T(2024, 3, 1))]
    for strict, expected in ((False, {"a", "b"}), (True, {"b"})):
        path = work_dir(spark, "t-strict")
        incremental.write_fact(facts.fct_rides(rides_df(spark, first)), path)
        incremental.run_incremental(spark, rides_df(spark, first + newer_invalid), path, strict=strict)
        got = {r["ride_id"] for r in spark.read.parquet(path).select("ride_id").collect()}
        assert got == expected, (strict, got)


def test_upsert_empties_a_month(spark):
    """The only ride of January is republished in February."""
    t = T(2024, 1, 31, 12)
    path = work_dir(spark, "t-empty")
    old = [ride("a", t, t + dt.timedelta(minutes=5), ingested=T(2024, 2, 1)),
           ride("b", t + dt.timedelta(days=9), t + dt.timedelta(days=9, minutes=5), ingested=T(2024, 2, 1))]
    moved = [ride("a", t + dt.timedelta(days=1), t + dt.timedelta(days=1, minutes=5), ingested=T(2024, 3, 1))]
    incremental.write_fact(facts.fct_rides(rides_df(spark, old)), path)
    incremental.apply_batch(spark, rides_df(spark, moved), path)
    got = sorted((r.ride_id, str(r.started_month)) for r in incremental.read_fact(spark, path).collect())
    assert got == [("a", "2024-02-01"), ("b", "2024-02-01")]
    # an older copy that comes again later changes nothing
    incremental.apply_batch(spark, rides_df(spark, old[:1]), path)
    assert sorted((r.ride_id, str(r.started_month)) for r in incremental.read_fact(spark, path).collect()) == got


def test_full_refresh_drops_stale_months(spark):
    path = work_dir(spark, "t-full")
    rows = [ride(str(m), T(2024, m, 5, 1), T(2024, m, 5, 2)) for m in (1, 2, 3)]
    incremental.write_fact(facts.fct_rides(rides_df(spark, rows)), path)
    incremental.write_fact(facts.fct_rides(rides_df(spark, rows[1:2])), path)
    assert [r.ride_id for r in incremental.read_fact(spark, path).collect()] == ["2"]


def test_columns_follow_the_batch(spark):
    path = work_dir(spark, "t-sync")
    rows = [ride(str(m), T(2024, m, 5, 1), T(2024, m, 5, 2), ingested=T(2024, 4, 1)) for m in (1, 2)]
    incremental.write_fact(facts.fct_rides(rides_df(spark, rows)), path)
    newer = facts.fct_rides(rides_df(spark, [ride("2", T(2024, 2, 6, 1), T(2024, 2, 6, 3), ingested=T(2024, 5, 1))]))
    newer = newer.withColumn("is_long_ride", F.lit(True)).drop("_source_file")
    incremental.upsert_rows(spark, newer, path)
    got = incremental.read_fact(spark, path)
    assert got.columns == newer.columns
    assert sorted((r.ride_id, r.is_long_ride) for r in got.collect()) == [("1", None), ("2", True)]


def _csv(folder, name, lines):
    import os

    from spokes.schemas import RAW_TRIP_COLUMNS

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join([",".join(RAW_TRIP_COLUMNS), *lines]) + "\n")


def _line(i, start="2024-06-01 00:00:00"):
    return f"{i},classic_bike,{start},2024-06-01 00:10:00,A,1,B,2,38.9,-77.0,38.9,-77.0,member"


def test_a_malformed_file_is_rejected_whole(spark, tmp_path):
    from spokes.sources import trips_csv

    landing, raw = str(tmp_path / "landing"), work_dir(spark, "t-raw")
    _csv(landing, "202406-alpha-tripdata.csv", [_line("a"), _line("b")])
    _csv(landing, "202407-alpha-tripdata.csv", [_line("c"), _line("d").rsplit(",", 3)[0]])
    _csv(landing, "202408-beta-tripdata.csv", [_line("e") + ",more"])
    patterns = trips_csv.FIXTURE_SYSTEM_PATTERNS
    said = {r.status: r.n for r in trips_csv.ingest_summary(trips_csv.ingest(spark, landing, raw, patterns)).collect()}
    assert said == {"loaded": 1, "skipped": 0, "failed": 2}
    assert sorted(r.ride_id for r in spark.read.parquet(raw).collect()) == ["a", "b"]
    _csv(landing, "202407-alpha-tripdata.csv", [_line("c"), _line("d")])  # corrected
    said = {r.status: r.n for r in trips_csv.ingest_summary(trips_csv.ingest(spark, landing, raw, patterns)).collect()}
    assert said == {"loaded": 1, "skipped": 1, "failed": 1}
    assert sorted(r.ride_id for r in spark.read.parquet(raw).collect()) == ["a", "b", "c", "d"]


def test_stream_dedup_keeps_late_rides(spark, tmp_path):
    """A ride never seen before stays, however far behind the others it comes."""
    from spokes.sources import trips_csv
    from spokes.streaming import jobs

    landing, out, ckpt = str(tmp_path / "l"), work_dir(spark, "t-dedup"), work_dir(spark, "t-ckpt")
    _csv(landing, "1-alpha-tripdata.csv", [_line("a"), _line("a")])
    jobs.stream_dedup(spark, f"{landing}/*.csv", out, ckpt, trips_csv.FIXTURE_SYSTEM_PATTERNS)
    _csv(landing, "2-alpha-tripdata.csv", [_line("b", "2024-01-01 00:00:00"), _line("c", "2024-06-02 00:00:00"), _line("a")])
    jobs.stream_dedup(spark, f"{landing}/*.csv", out, ckpt, trips_csv.FIXTURE_SYSTEM_PATTERNS)
    assert sorted(r.ride_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_stream_dedup_replays_rides_without_a_start(spark, tmp_path):
    """Rows with a null or empty start are found again in the partition that Spark reads as null."""
    from spokes.sources import trips_csv
    from spokes.streaming import jobs

    landing, out = str(tmp_path / "l"), work_dir(spark, "t-dedup-null")
    _csv(landing, "1-alpha-tripdata.csv", [_line("a", ""), _line("b", '""'), _line("c")])
    for name in ("t-ckpt-first", "t-ckpt-second"):  # a new checkpoint replays every file
        jobs.stream_dedup(spark, f"{landing}/*.csv", out, work_dir(spark, name), trips_csv.FIXTURE_SYSTEM_PATTERNS)
    assert sorted(r.ride_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_freshness_by_elapsed_time(spark):
    from spokes.operators import quality

    as_of = dt.datetime(2024, 3, 15, 1)
    ages = {"a": 35 * 24, "b": 35 * 24 + 1, "c": 60 * 24 + 1, "d": 35 * 24 - 1}
    rows = [(s, as_of - dt.timedelta(hours=h)) for s, h in ages.items()]
    got = quality.freshness(spark.createDataFrame(rows, "system string, at timestamp_ntz"), "system", "at", as_of)
    assert {r.source: r.status for r in got.collect()} == {"a": "pass", "b": "warn", "c": "error", "d": "pass"}
