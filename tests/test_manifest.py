"""The load manifest and what follows it."""

import os

from helpers import T
from pyspark.sql import functions as F

from spokes.operators import incremental, staging
from spokes.schemas import RAW_TRIP_COLUMNS
from spokes.session import work_dir
from spokes.sources import manifest, trips_csv

PATTERNS = trips_csv.FIXTURE_SYSTEM_PATTERNS


def csv(folder, name, ids, month=6):
    os.makedirs(folder, exist_ok=True)
    line = "{},classic_bike,2024-0{}-01 00:00:00,2024-0{}-01 00:10:00,A,1,B,2,38.9,-77.0,38.9,-77.0,member"
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join([",".join(RAW_TRIP_COLUMNS), *(line.format(i, month, month) for i in ids)]) + "\n")


def said(spark, landing, raw):
    return {r.status: r.n for r in trips_csv.ingest_summary(trips_csv.ingest(spark, landing, raw, PATTERNS)).collect()}


def test_loaded_files_come_from_the_manifest_alone(spark, tmp_path, monkeypatch):
    landing, raw = str(tmp_path / "landing"), work_dir(spark, "t-raw")
    csv(landing, "1-alpha-tripdata.csv", "ab")
    assert said(spark, landing, raw) == {"loaded": 1, "skipped": 0, "failed": 0}
    csv(landing, "1-beta-tripdata.csv", "c")
    read = []
    reader = type(spark.read)
    monkeypatch.setattr(reader, "parquet", lambda self, *paths, f=reader.parquet, **k: read.extend(paths) or f(self, *paths, **k))
    assert said(spark, landing, raw) == {"loaded": 1, "skipped": 1, "failed": 0}
    assert not [p for p in read if str(p).startswith(raw)]  # the raw table isn't read
    assert said(spark, landing, raw) == {"loaded": 0, "skipped": 2, "failed": 0}
    assert sorted((r.system, r.file, r.landing) for r in manifest.loaded(spark, raw).collect()) == [
        ("alpha", "1-alpha-tripdata.csv", 1), ("beta", "1-beta-tripdata.csv", 2)]


def test_a_landing_that_died_does_not_count(spark, tmp_path):
    landing, raw = str(tmp_path / "landing"), work_dir(spark, "t-raw")
    csv(landing, "1-alpha-tripdata.csv", "ab")
    said(spark, landing, raw)
    dead = manifest.begin(spark, raw)  # appends its rows and dies
    spark.read.schema(trips_csv.RAW_SCHEMA).parquet(raw).withColumns(
        {manifest.LANDING: F.lit(dead).cast("long"), "ride_id": F.lit("ghost")}).write.mode("append").partitionBy("system").parquet(raw)
    assert sorted(r.ride_id for r in trips_csv.read_raw(spark, raw).collect()) == ["a", "b"]
    csv(landing, "2-alpha-tripdata.csv", "c")
    assert said(spark, landing, raw) == {"loaded": 1, "skipped": 1, "failed": 0}
    assert sorted(r.ride_id for r in trips_csv.read_raw(spark, raw).collect()) == ["a", "b", "c"]
    assert manifest.head(spark, raw) == dead + 1


def test_a_table_from_before_the_manifest(spark, tmp_path):
    landing, raw = str(tmp_path / "landing"), work_dir(spark, "t-raw")
    csv(landing, "1-alpha-tripdata.csv", "ab")
    old = trips_csv.read_trip_csvs(spark, [f"{landing}/1-alpha-tripdata.csv"], PATTERNS).drop("_malformed")
    old.write.partitionBy("system").parquet(raw)
    csv(landing, "2-alpha-tripdata.csv", "c")
    assert said(spark, landing, raw) == {"loaded": 1, "skipped": 1, "failed": 0}
    assert sorted(r.ride_id for r in trips_csv.read_raw(spark, raw).collect()) == ["a", "b", "c"]


def test_late_and_equal_stamps_come_in(spark, tmp_path):
    """The fact follows the landings: rows stamped like, or before, what it has are not lost."""
    landing, raw, path = str(tmp_path / "landing"), work_dir(spark, "t-raw"), work_dir(spark, "t-fact")
    stage = lambda rows: staging.stage_trips(rows, "alpha", "double")

    def run():
        return incremental.run_landings(spark, trips_csv.read_raw(spark, raw), stage, path, manifest.head(spark, raw))

    def land(ids, at, month):
        number = manifest.begin(spark, raw)
        csv(landing, f"{number}-alpha-tripdata.csv", ids, month)
        rows = trips_csv.read_trip_csvs(spark, [f"{landing}/{number}-alpha-tripdata.csv"], PATTERNS).drop("_malformed")
        rows = rows.withColumns({"_ingested_at": F.lit(at).cast("timestamp"), manifest.LANDING: F.lit(number).cast("long")})
        rows.select(*trips_csv.RAW_SCHEMA.names).write.mode("append").partitionBy("system").parquet(raw)
        manifest.commit(spark, raw, number, [("alpha", f"{number}-alpha-tripdata.csv")])

    ids = lambda: sorted(r.ride_id for r in incremental.read_fact(spark, path).collect())
    land("ab", T(2024, 7, 2), 6)
    incremental.write_fact(incremental.facts.fct_rides(stage(trips_csv.read_raw(spark, raw))), path)
    incremental.save_landing(spark, path, 1)
    assert run() == 0
    land("c", T(2024, 7, 2), 6)  # the same stamp
    land("d", T(2024, 7, 1), 5)  # an earlier one, committed later
    assert run() == 2 and ids() == ["a", "b", "c", "d"] and run() == 0
    land("a", T(2024, 7, 1), 4)  # an older copy of a ride doesn't replace the newer one
    run()
    assert ids() == ["a", "b", "c", "d"] and incremental.read_landing(spark, path) == 4
    assert incremental.read_fact(spark, path).where("ride_id = 'a'").first().started_month.month == 6
