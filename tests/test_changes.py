"""The change feed, the key index and what follows them."""

import random
import re

from helpers import T, ride, rides_df
from pyspark.sql import functions as F

from spokes.operators import changes, daily_view, facts, incremental, key_index
from spokes.operators.marts import agg_rides_daily
from spokes.session import work_dir
from spokes.streaming import jobs


def daily(spark, path):
    return sorted(map(tuple, agg_rides_daily(incremental.read_fact(spark, path)).collect()), key=str)


def followed(spark, out):
    return sorted(map(tuple, jobs.read_daily(spark, out).collect()), key=str)


def test_daily_view_follows_retractions(spark):
    """A month that loses its only ride leaves the mart; extremes that went are looked up again."""
    path, out, ckpt = (work_dir(spark, n) for n in ("t-fact", "t-daily", "t-ckpt"))
    first = [ride("a", T(2024, 1, 5, 1), T(2024, 1, 5, 2)), ride("b", T(2024, 2, 5, 1), T(2024, 2, 5, 2)),
             ride("c", T(2024, 2, 5, 1), T(2024, 2, 5, 5)), ride("d", T(2024, 2, 5, 1), T(2024, 2, 5, 3), member=None)]
    incremental.write_fact(facts.fct_rides(rides_df(spark, first)), path)
    jobs.stream_daily_rollup(spark, path, out, ckpt)
    assert followed(spark, out) == daily(spark, path)
    moved = [ride("a", T(2024, 3, 5, 1), T(2024, 3, 5, 2), ingested=T(2024, 5, 1)),  # January is empty
             ride("c", T(2024, 2, 5, 1), T(2024, 2, 5, 4), ingested=T(2024, 5, 1))]  # the longest ride is shorter
    incremental.apply_batch(spark, rides_df(spark, moved), path)
    jobs.stream_daily_rollup(spark, path, out, ckpt)
    assert followed(spark, out) == daily(spark, path)
    assert min(r[0] for r in followed(spark, out)).month == 2
    back = [ride("a", T(2024, 1, 5, 1), T(2024, 1, 5, 3), ingested=T(2024, 6, 1))]
    incremental.apply_batch(spark, rides_df(spark, back), path)
    jobs.stream_daily_rollup(spark, path, out, ckpt)
    assert followed(spark, out) == daily(spark, path)


def test_daily_view_random_changes_replays_and_resets(spark):
    path, out = work_dir(spark, "t-fact"), work_dir(spark, "t-daily")
    rng = random.Random(4)

    def rides(n, day):
        return [ride(str(rng.randint(0, 25)), T(2024, rng.randint(1, 3), 1, h := rng.randint(0, 5)), T(2024, 4, 1, h, rng.randint(0, 3)),
                     ingested=T(2024, 5, day), member=rng.choice(["member", "casual", None])) for _ in range(n)]

    incremental.write_fact(facts.fct_rides(rides_df(spark, rides(20, 1))), path)
    read = lambda: incremental.read_fact(spark, path)
    daily_view.follow(spark, path, read, out, [], reset=True)
    done = changes.head(spark, path)
    for day in range(2, 6):
        incremental.apply_batch(spark, rides_df(spark, rides(8, day)), path)
        if day % 2:
            seqs = list(range(done + 1, changes.head(spark, path) + 1))
            daily_view.follow(spark, path, read, out, seqs)
            assert followed(spark, out) == daily(spark, path)
            daily_view.follow(spark, path, read, out, seqs)  # the batch comes again after a failure
            assert followed(spark, out) == daily(spark, path)
            done = seqs[-1]
    incremental.write_fact(facts.fct_rides(rides_df(spark, rides(5, 9))), path)
    daily_view.follow(spark, path, read, out, [], reset=True)
    daily_view.follow(spark, path, read, out, seqs)  # changes from before the reset count for nothing
    assert followed(spark, out) == daily(spark, path)


def test_a_dead_run_is_logged_as_reset(spark):
    path, out, ckpt = (work_dir(spark, n) for n in ("t-fact", "t-daily", "t-ckpt"))
    fct = facts.fct_rides(rides_df(spark, [ride("a", T(2024, 1, 5, 1), T(2024, 1, 5, 2))]))
    incremental.write_fact(fct, path)
    jobs.stream_daily_rollup(spark, path, out, ckpt)
    changes.stage(spark, path, changes.begin(spark, path), fct, fct)  # and then the run died
    incremental.apply_batch(spark, rides_df(spark, [ride("b", T(2024, 2, 5, 1), T(2024, 2, 5, 2), ingested=T(2024, 6, 1))]), path)
    assert changes.head(spark, path) == 3
    jobs.stream_daily_rollup(spark, path, out, ckpt)
    assert followed(spark, out) == daily(spark, path)
    changes.trim(spark, path, 3)
    assert changes.begin(spark, path) == 4


def test_upsert_reads_only_months_the_index_names(spark, monkeypatch):
    """Keys of the other months are not read: the plan's scans are pruned to the touched month and the keys' buckets."""
    path = work_dir(spark, "t-index")
    rows = [ride(f"r{m}-{i}", T(2024, m, 5, 1), T(2024, m, 5, 2)) for m in range(1, 9) for i in range(20)]
    incremental.write_fact(facts.fct_rides(rides_df(spark, rows)), path)
    monkeypatch.setattr(key_index, "BUCKET_KEYS", 20)
    open_index = key_index.KeyIndex.open
    monkeypatch.setattr(key_index.KeyIndex, "open", classmethod(lambda cls, s, p, f, k: open_index(s, p, f, k, 20)))
    incremental.apply_batch(spark, rides_df(spark, [ride("r1-0", T(2024, 1, 6, 1), T(2024, 1, 6, 2), ingested=T(2024, 9, 1))]), path)

    read, pairs = [], []
    old_read, old_pairs = incremental.read_fact, key_index.KeyIndex.pairs
    monkeypatch.setattr(incremental, "_in_months", lambda months, f=incremental._in_months: read.append(sorted(map(str, months))) or f(months))
    monkeypatch.setattr(key_index.KeyIndex, "pairs", lambda self: pairs.append(self.state) or old_pairs(self))
    batch = [ride(f"r3-{i}", T(2024, 3, 6, 1), T(2024, 3, 6, 2), ingested=T(2024, 9, 2)) for i in range(2)]
    incremental.apply_batch(spark, rides_df(spark, batch), path)
    assert read == [["2024-03-01"], ["2024-03-01"]] and pairs[0]["buckets"] == 9
    index = key_index.KeyIndex.open(spark, path, None, ["ride_id"])
    wanted = {r[0] for r in index.hashes(rides_df(spark, batch)).select(F.pmod("key", F.lit(9)).cast("int")).collect()}
    pruned = old_pairs(index).where(F.col("bucket").isin(list(wanted)))
    files = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in files
    got = {r.ride_id: str(r.started_date) for r in old_read(spark, path).where("ride_id LIKE 'r3-%'").collect()}
    assert len(got) == 20 and [got["r3-0"], got["r3-2"]] == ["2024-03-06", "2024-03-05"]
    month = old_read(spark, path).where(F.col("started_month").isin([T(2024, 3, 1).date()]))
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*started_month", plan), plan[plan.index("PartitionFilters"):][:300]


def test_index_misses_no_month_over_many_batches(spark, monkeypatch):
    """Rides that move month again and again leave one copy; packing keeps every pair."""
    monkeypatch.setattr(key_index, "BATCHES", 2)
    path, rng = work_dir(spark, "t-index"), random.Random(7)
    have = {}
    for day in range(1, 6):
        batch = {str(rng.randint(0, 12)): rng.randint(1, 4) for _ in range(8)}
        rows = rides_df(spark, [ride(i, T(2024, m, 5, 1), T(2024, m, 5, 2), ingested=T(2024, 9, day)) for i, m in batch.items()])
        incremental.apply_batch(spark, rows, path)
        have |= batch
        assert {r.ride_id: r.started_month.month for r in incremental.read_fact(spark, path).collect()} == have
        assert incremental.read_fact(spark, path).count() == len(have)
    index = key_index.KeyIndex.open(spark, path, None, ["ride_id"])
    pairs = {(r.key, r.started_month.month) for r in index.pairs().collect()}
    assert {(r.key, r.m) for r in incremental.read_fact(spark, path).select(
        F.xxhash64("ride_id").alias("key"), F.month("started_month").alias("m")).collect()} <= pairs
    assert index.state["version"] >= 1
    other = key_index.KeyIndex.open(spark, path, incremental.read_fact(spark, path), ["system", "ride_id"])  # other keys, another index
    assert other.pairs().count() == len(have)
