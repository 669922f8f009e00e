"""The daily mart kept up by the fact's changes, retractions included.

The view keeps sums instead of averages, so a change adds to or takes from its
groups.  Only where it takes away a group's shortest or longest ride does the
group have to be seen again: it is rolled up anew from its month of the fact.
A group that has lost all rides stays as an empty row (hidden from readers):
every group knows the last change it has, so a change that comes again after a
failure is left out group by group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fs import exists, read_text, write_text
from ..schemas import DAILY_COLUMNS
from ..session import written
from . import changes

GROUP = ["started_date", "system", "member_casual", "rideable_type"]
FLOOR = "_rebuilt.txt"  # the change that the view was last made anew at


def _metrics() -> list[Column]:
    return [F.count("*").alias("n"), F.sum("duration_seconds").cast("long").alias("seconds"),
            F.sum("duration_minutes").cast("decimal(28,2)").alias("minutes"), F.min("duration_minutes").alias("shortest"),
            F.max("duration_minutes").alias("longest"), F.count_if("is_night_owl").alias("night"),
            F.count_if("is_round_trip").alias("round")]


STATE = [*GROUP, "n", "seconds", "minutes", "shortest", "longest", "night", "round", "seq"]


def _rolled(rides: DataFrame, seq: int) -> DataFrame:
    return rides.groupBy(*GROUP).agg(*_metrics()).withColumn("seq", F.lit(seq).cast("long")).select(*STATE)


def _write(state: DataFrame, path: str, mode: str) -> None:
    rows = state.withColumn("_month", F.trunc("started_date", "month"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("_month").parquet(path)


def rebuild(spark: SparkSession, fact_path: str, fact: DataFrame, path: str) -> None:
    """Roll up the whole fact; all changes until now are in it."""
    seq = changes.head(spark, fact_path)
    _write(_rolled(fact, seq), path, "static")
    write_text(spark, f"{path}/{FLOOR}", str(seq))


def _same(a: str, b: str) -> Column:
    out = F.lit(True)
    for c in GROUP:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def follow(spark: SparkSession, fact_path: str, read_fact: Callable[[], DataFrame], path: str, seqs: list[int], reset: bool = False) -> None:
    """Bring the view at ``path`` up to the changes ``seqs`` (rows of the feed's log); ``reset``: one of them is a reset.

    Reads the changes, the months of the view that they touch and, of the
    fact, the months of the groups that lost their shortest or longest ride.
    """
    if reset or not exists(spark, f"{path}/{FLOOR}"):
        return rebuild(spark, fact_path, read_fact(), path)
    floor = int(read_text(spark, f"{path}/{FLOOR}"))
    seqs = [s for s in seqs if s > floor]
    if not seqs:
        return None
    state = spark.read.parquet(path)
    rows = changes.read(spark, fact_path, seqs).alias("c")
    done = state.select(*GROUP, F.col("seq").alias("_done")).alias("s")
    live = rows.join(done, _same("c", "s"), "left").where("_done IS NULL OR _seq > _done")
    # a ride that went and came again with the same length leaves no trace in the extremes
    net = live.groupBy(*(F.col(f"c.{c}") for c in GROUP), "duration_minutes").agg(
        F.sum("_op").alias("k"), F.sum(F.col("_op") * F.col("duration_seconds")).alias("seconds"),
        F.sum(F.when(F.col("is_night_owl"), F.col("_op"))).alias("night"),
        F.sum(F.when(F.col("is_round_trip"), F.col("_op"))).alias("round"))
    came, went = F.when(F.col("k") > 0, F.col("duration_minutes")), F.when(F.col("k") < 0, F.col("duration_minutes"))
    delta = written(net.groupBy(*GROUP).agg(
        F.sum("k").alias("n"), F.sum("seconds").alias("seconds"), F.sum(F.col("k") * F.col("duration_minutes")).alias("minutes"),
        F.coalesce(F.sum("night"), F.lit(0)).alias("night"), F.coalesce(F.sum("round"), F.lit(0)).alias("round"),
        F.min(came).alias("low"), F.max(came).alias("high"), F.min(went).alias("low_gone"), F.max(went).alias("high_gone")),
        "daily-delta")
    months = [r[0] for r in delta.select(F.trunc("started_date", "month")).distinct().collect()]
    if not months:
        return None
    touched = state.where(F.col("_month").isin(months)).select(*STATE)

    def total(c: str, kind: str) -> Column:
        return (F.coalesce(F.col(f"s.{c}"), F.lit(0)) + F.coalesce(F.col(f"d.{c}"), F.lit(0))).cast(kind).alias(c)

    changed = F.col("d.n").isNotNull()
    low, high = F.least("s.shortest", "d.low"), F.greatest("s.longest", "d.high")
    merged = touched.alias("s").join(delta.alias("d"), _same("s", "d"), "full")
    merged = merged.select(
        *(F.coalesce(f"s.{c}", f"d.{c}").alias(c) for c in GROUP), total("n", "long"), total("seconds", "long"),
        total("minutes", "decimal(28,2)"), low.alias("shortest"), high.alias("longest"), total("night", "long"), total("round", "long"),
        F.when(changed, F.lit(max(seqs)).cast("long")).otherwise(F.col("s.seq")).alias("seq"),
        F.coalesce(changed & ((F.col("d.low_gone") <= low) | (F.col("d.high_gone") >= high)), F.lit(False)).alias("again"))
    merged = written(merged, "daily-merged")
    empty = F.col("n") == 0
    kept = merged.where("NOT again OR n = 0").select(*(
        F.when(~empty, F.col(c)).alias(c) if c in ("shortest", "longest") else F.col(c) for c in STATE))
    lost = merged.where("again AND n <> 0").select(*GROUP)
    at = [r[0] for r in lost.select(F.trunc("started_date", "month")).distinct().collect()]
    if at:
        rides = read_fact().where(F.col("started_month").isin(at)).alias("r")
        rides = rides.join(lost.alias("l"), _same("r", "l"), "left_semi")
        kept = kept.unionByName(_rolled(rides, changes.head(spark, fact_path)))
    _write(written(kept, "daily-new"), path, "dynamic")
    spark.catalog.refreshByPath(path)
    return None


def read(spark: SparkSession, path: str) -> DataFrame:
    """The daily mart of the view: groups that have rides."""
    n = F.col("n")
    return spark.read.parquet(path).where("n > 0").select(
        *GROUP, n.alias("total_rides"), (F.col("seconds") / F.lit(3600.0)).alias("total_hours_on_bike"),
        (F.col("minutes").cast("double") / n).alias("avg_ride_minutes"), F.col("shortest").alias("shortest_ride_minutes"),
        F.col("longest").alias("longest_ride_minutes"), F.col("night").alias("night_owl_rides"),
        F.col("round").alias("round_trip_rides")).select(*DAILY_COLUMNS)
