"""What rides and candidates weigh in sorts, shuffles and written tables."""

from helpers import T, ride, rides_df
from pyspark.sql import functions as F

from spokes.operators import facts, incremental, key_index, nearest
from spokes.plans import registry
from spokes.session import RIDE_SETTINGS, work_dir
from spokes.sources import trips_csv


def test_ride_queries_size_their_tasks(spark, monkeypatch):
    keys = list(RIDE_SETTINGS)
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.unset(k)
        monkeypatch.setitem(registry.REGISTRY, "_none", None)
        registry.register("_none")(lambda s, sf: s.range(1))
        registry.REGISTRY["_none"](spark, "")
        assert {k: spark.conf.get(k) for k in keys} == RIDE_SETTINGS
        count = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        spark.conf.set(count, "5000")
        registry.REGISTRY["_none"](spark, "")
        assert spark.conf.get(count) == "5000"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_nearest_sorts_no_leaves(spark):
    """The aggregate by point sits above a generator, not above the leaves' arrays."""
    at = spark.range(200).select("id", (F.col("id") * 7 % 31).cast("double").alias("x"), (F.col("id") * 3 % 17).cast("double").alias("y"))
    got = nearest.nearest(at.withColumnRenamed("id", "p"), at.withColumnRenamed("id", "t"), "p", "t")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "min(array_min" not in plan and "Generate inline" in plan
    rows = at.collect()
    for r in got.collect():
        p = next(q for q in rows if q.id == r.p)
        assert (r.distance, r.t) == min((((q.x - p.x) ** 2 + (q.y - p.y) ** 2) ** 0.5, q.id) for q in rows)


def _fact(spark, name):
    path = work_dir(spark, name)
    rows = [ride(f"r{m}-{i}", T(2024, m, 5, 1), T(2024, m, 5, 2)) for m in (1, 2, 3) for i in range(4)]
    incremental.write_fact(facts.fct_rides(rides_df(spark, rows)), path)
    return path


def test_the_index_is_made_without_a_table_of_its_own(spark, monkeypatch):
    path = _fact(spark, "t-index-made")
    monkeypatch.setattr(key_index, "written", None)
    index = key_index.KeyIndex.open(spark, path, incremental.read_fact(spark, path), ["ride_id"])
    assert index.pairs().count() == 12


def test_an_upsert_moves_its_partitions_and_leaves_no_stage(spark):
    path = _fact(spark, "t-moved")
    batch = [ride(f"r1-{i}", T(2024, 2, 6, 1), T(2024, 2, 6, 2), ingested=T(2024, 5, 1)) for i in range(4)]
    batch.append(ride("none", None, None, ingested=T(2024, 5, 1)))
    assert incremental.apply_batch(spark, rides_df(spark, batch), path) == 4
    got = sorted((r.ride_id, r.started_month.month) for r in incremental.read_fact(spark, path).collect())
    assert got == sorted([(f"r1-{i}", 2) for i in range(4)] + [(f"r{m}-{i}", m) for m in (2, 3) for i in range(4)])
    assert incremental.names(spark, f"{path}_stage") == []
    assert "started_month=2024-01-01" not in incremental.names(spark, path)


def test_source_names_without_a_regular_expression(spark):
    cases = {"/l/a.csv": "a.csv", "/l/a.csv/part-0.csv": "a.csv", "/l/a.csv/part-0": "a.csv", "/l/x/.csv": "", "a.csv": "a.csv",
             "/a.csv/b/c": "", "/.csv/b.csv": "b.csv", "/l/a.csv.gz": "", None: None}
    rows = spark.createDataFrame(list(cases.items()), "path string, want string")
    got = rows.select("path", trips_csv.source_name(F.col("path")).alias("name"))
    assert {r["path"]: r["name"] for r in got.collect()} == cases
    old = rows.select("path", F.regexp_extract("path", r"([^/]+\.csv)(/[^/]*)?$", 1).alias("name"))
    assert {r["path"]: r["name"] for r in old.collect()} == cases
    assert "regexp" not in got._jdf.queryExecution().optimizedPlan().toString()
