"""What the streaming queries read, parse and write more than once."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from spokes.operators import incremental
from spokes.plans import registry
from spokes.session import work_dir
from spokes.sources import trips_csv
from spokes.streaming import jobs

PATTERNS = trips_csv.FIXTURE_SYSTEM_PATTERNS


def _rides(spark):
    return registry._wh(spark, SF_SMALL).unioned


def test_landings_are_written_from_one_reading(spark, monkeypatch):
    monkeypatch.setattr(registry, "_rides_written", None)  # no copy of the rides for the sake of the files
    landing = registry._landing(spark, SF_SMALL, replay=True)
    names = sorted(n for n in trips_csv.names(spark, landing))
    assert names == ["alpha-tripdata_1-replay.csv", "alpha-tripdata_1.csv", "alpha-tripdata_2.csv", "beta-tripdata.csv"]
    got = spark.read.option("header", True).csv(f"{landing}/alpha-tripdata_1-replay.csv")
    assert got.count() == _rides(spark).where("_source_file = 'alpha-tripdata_1.csv'").count() and got.columns == trips_csv.RAW_TRIP_COLUMNS


def test_odd_source_names_survive(spark):
    rows = _rides(spark).limit(6).withColumn("_source_file", F.lit("beta-tripdata a%20=b:c.csv"))
    landing = work_dir(spark, "t-odd")
    trips_csv.write_raw_csvs(rows, landing)
    assert trips_csv.names(spark, landing) == ["beta-tripdata a%20=b:c.csv"]


def test_the_source_is_named_once_and_without_regular_expressions(spark):
    landing = work_dir(spark, "t-named")
    trips_csv.write_raw_csvs(_rides(spark), landing)
    rows = trips_csv.read_trip_csvs(spark, [f"{landing}/{n}" for n in trips_csv.names(spark, landing)], PATTERNS).where(F.col("system").isNotNull())
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "LIKE" not in plan and plan.count("input_file_name()") <= 8 and "file_path" not in plan
    assert {tuple(r) for r in rows.select("_source_file", "system").distinct().collect()} == {
        ("alpha-tripdata_1.csv", "alpha"), ("alpha-tripdata_2.csv", "alpha"), ("beta-tripdata.csv", "beta")}


def test_routes_equal_like(spark):
    patterns = {"a": "alpha-tripdata", "dot": "x.csv", "wild": "q_z%"}
    texts = ["alpha-tripdata.csv", "alpha-tripdata.csv.gz", "zalpha-tripdata_1.csv", "alpha-tripdat.csv", "x.csv", "x.csv.csv", "qaz1.csv", "", None]
    got = spark.createDataFrame([(t,) for t in texts], "n string").select(trips_csv.route_system(F.col("n"), patterns).alias("s"))
    assert [r.s for r in got.collect()] == ["a", None, "a", None, None, "dot", "wild", None, None]


def test_an_upsert_parses_its_batch_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(incremental, "apply_batch", lambda s, fresh, *a: plans.append(fresh._jdf.queryExecution().optimizedPlan().toString()))
    landing = work_dir(spark, "t-once")
    trips_csv.write_raw_csvs(_rides(spark), landing, with_ingested=True)
    jobs.stream_upsert(spark, f"{landing}/*.csv/*.csv", work_dir(spark, "t-fct"), work_dir(spark, "t-ckpt"), PATTERNS,
                       ("alpha", "beta"), "double", ingested_in_file=True)
    assert len(plans) == 1 and "Union" not in plans[0]


def test_a_deduped_batch_is_staged_without_its_hash(spark, monkeypatch):
    staged, written = [], jobs.written
    monkeypatch.setattr(jobs, "written", lambda df, name: staged.append(df.columns) or written(df, name))
    assert registry.REGISTRY["stream_dedup"](spark, SF_SMALL).count() == _rides(spark).count()
    assert staged and all("_key" not in c for c in staged)


def test_an_upsert_leaves_packed_landings_of_bounded_files(spark, monkeypatch):
    landings, write = [], trips_csv.write_raw_csvs
    monkeypatch.setattr(trips_csv, "PACKED_ROWS", 500)
    monkeypatch.setattr(trips_csv, "write_raw_csvs", lambda rows, landing, *a, **k: landings.append(landing) or write(rows, landing, *a, **k))
    got = registry.REGISTRY["stream_upsert"](spark, SF_SMALL)
    assert got.count() == registry._wh(spark, SF_SMALL).fct.count()
    parts = spark.read.format("binaryFile").load(f"{landings[0]}/*.csv/part-*").select("path")
    assert all(r.path.endswith(".csv.gz") for r in parts.collect())
    sizes = spark.read.option("header", True).csv(f"{landings[0]}/*.csv/*.csv.gz").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in sizes) == _rides(spark).count() and max(r["count"] for r in sizes) <= 500
