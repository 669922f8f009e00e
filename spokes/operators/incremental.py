"""Incremental fact maintenance.

The fact is plain Parquet partitioned by ``started_month``.  An incremental
run: watermark -> new rows -> dedup/features/B3 -> delete+insert by key.
Only the partitions the batch touches are rewritten, in two phases so no job
overwrites a path it is reading:

1. the new contents of every touched partition (old rows minus replaced keys,
   plus the batch) are written to a staging folder beside the table;
2. each staged partition is moved into the place of the target's (other
   partitions stay as they are, no row is written twice), and partitions that
   have no rows left are removed.

A partition that phase 2 hasn't moved is still whole in the staging folder after
a failure; the upsert itself is idempotent (replaying a batch yields the same table).  A
row of the target that is newer than the batch's copy stays, so a late replay
of an old batch changes nothing.

The months that hold copies of a batch's rides are looked up in a key index
(``key_index``), so no other month is read, and what an upsert retracted and
inserted goes to the change feed (``changes``) for tables that follow the fact.

The table's columns follow the newest batch: its schema is kept beside the data
files and ``read_fact`` reads all of them by it, older files without a new
column giving NULLs, so no untouched partition is rewritten.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..fs import delete, exists, names, read_text, replace, write_text
from ..session import written
from . import changes, facts
from .key_index import KeyIndex

LOW_WATERMARK = dt.datetime(1900, 1, 1)
PARTITION = "started_month"
SCHEMA_FILE = "_schema.json"  # the leading underscore hides it from table scans
MARK_FILE = "_watermark.txt"
LANDING_FILE = "_landing.txt"


def watermark(target: DataFrame, col: str = "_ingested_at") -> DataFrame:
    """One row, ``max_ingested_at`` = COALESCE(MAX(col), 1900-01-01)."""
    return target.agg(
        F.coalesce(F.max(col), F.lit(LOW_WATERMARK).cast("timestamp_ntz")).alias("max_ingested_at")
    )


def new_rows(unioned: DataFrame, target: DataFrame, col: str = "_ingested_at") -> DataFrame:
    """Rows strictly newer than the target's high-water mark.

    The mark is collected as a literal (one value) so the predicate reaches the
    Parquet scan as a pushed filter.
    """
    return _after(unioned, watermark(target, col).first()[0], col)


def _after(rows: DataFrame, mark: dt.datetime, col: str = "_ingested_at") -> DataFrame:
    return rows.where(F.col(col) > F.lit(mark).cast("timestamp_ntz"))


def schema_sync(target: DataFrame, batch_schema: StructType) -> DataFrame:
    """A11 (sync_all_columns): target projected onto the batch schema.

    Columns new in the batch appear as typed NULLs; columns the batch dropped
    are removed.
    """
    have = set(target.columns)
    return target.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in batch_schema.fields
        ]
    )


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str] = ("ride_id",),
           delete_keys: DataFrame | None = None) -> DataFrame:
    """A10 delete+insert: target rows whose key is in the batch are replaced.

    ``delete_keys`` (default: the batch's keys) lets a strict run also delete
    rides whose newest copy was dropped by B3 (SURVEY §2.13-4).
    """
    keys = list(keys)
    kill = delete_keys if delete_keys is not None else batch.select(*keys).distinct()
    target = schema_sync(target, batch.schema)
    return target.join(kill, keys, "left_anti").unionByName(batch)


def incremental_batch(unioned: DataFrame, target: DataFrame, keys: Sequence[str] = ("ride_id",)):
    """(fact rows of the new batch, all deduped keys of the batch before B3)."""
    fresh = new_rows(unioned, target)
    deduped = facts.dedup_latest(fresh, keys)
    return facts.physically_possible(facts.ride_features(deduped)), deduped.select(*keys)


def write_fact(fct: DataFrame, path: str) -> None:
    """Full refresh (A12): replace the whole partitioned table, also months that the new one lacks.

    ``REBALANCE(started_month)`` lets AQE size the write tasks: a month's rows
    land in few files instead of one file per (task, month), and a month
    holding a large share of all rides is split across tasks, not funnelled
    into one.  The change feed gets a reset.
    """
    spark, mark = fct.sparkSession, Observation()
    seq = changes.begin(spark, path)
    (
        fct.observe(mark, F.max("_ingested_at").alias("at")).hint("rebalance", PARTITION).write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy(PARTITION).parquet(path)
    )
    _save_schema(spark, path, fct.schema)
    _save_mark(spark, path, mark.get["at"] or LOW_WATERMARK)
    changes.commit(spark, path, seq, changes.RESET)


def _save_mark(spark: SparkSession, path: str, mark: dt.datetime) -> None:
    """Keep the high-water mark beside the table, so that a run without news reads nothing of it."""
    write_text(spark, f"{path}/{MARK_FILE}", mark.isoformat())


def read_mark(spark: SparkSession, path: str) -> dt.datetime:
    """The mark kept beside the fact, or the rows' own where there is none."""
    if exists(spark, f"{path}/{MARK_FILE}"):
        return dt.datetime.fromisoformat(read_text(spark, f"{path}/{MARK_FILE}"))
    return watermark(read_fact(spark, path)).first()[0]


def _save_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    nullable = StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
    write_text(spark, f"{path}/{SCHEMA_FILE}", nullable.json())


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The fact by its newest schema (a table without a saved one is read by its files')."""
    saved = f"{path}/{SCHEMA_FILE}"
    if not exists(spark, saved):
        return spark.read.parquet(path)
    schema = StructType.fromJson(json.loads(read_text(spark, saved)))
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def apply_batch(spark: SparkSession, fresh: DataFrame, path: str, keys: Sequence[str] = ("ride_id",),
                strict: bool = False, on_touch: Callable[[list], None] | None = None) -> int:
    """Delete+insert the fact rows of ``fresh`` (staged ride rows) into the table at ``path``.

    Used by the watermark run below and by the streaming ``foreachBatch``.
    """
    keys = list(keys)
    deduped = facts.dedup_latest(fresh, keys)
    batch = facts.physically_possible(facts.ride_features(deduped))
    killed = deduped.select(*keys, "_ingested_at") if strict else None
    return upsert_rows(spark, batch, path, keys, killed, on_touch)


def upsert_rows(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str] = ("ride_id",),
                killed: DataFrame | None = None, on_touch: Callable[[list], None] | None = None) -> int:
    """Upsert fact rows (unique by ``keys``) into the table at ``path``; returns the rows written.

    ``killed`` (keys, _ingested_at) lists further rows to delete.  The fact ends
    with the batch's columns.  ``on_touch`` is told the months that are about to
    change.
    """
    keys = list(keys)
    if not exists(spark, path):
        write_fact(batch, path)
        return read_fact(spark, path).count()
    target = read_fact(spark, path)
    batch = written(batch, "fct-batch")
    stamped = [*keys, "_ingested_at"]
    incoming = batch.select(*stamped)
    if killed is not None:
        incoming = incoming.union(killed.select(*stamped))
    incoming = incoming.groupBy(*keys).agg(F.max("_ingested_at").alias("_batch_at"))
    # the target's copies of the batch's rides: a few columns of the months that the index names
    index = KeyIndex.open(spark, path, target, keys)
    found = index.lookup(incoming)
    held = [r[0] for r in found.select(PARTITION).distinct().collect()]  # months, not rides
    have = target.where(_in_months(held)).select(*stamped, PARTITION).join(incoming, keys)
    have = written(have.withColumn("_newer", F.coalesce(F.col("_ingested_at") > F.col("_batch_at"), F.lit(False))),
                    "fct-have")
    batch = batch.join(have.where("_newer"), keys, "left_anti")
    replaced = have.where("not _newer")
    seq = changes.begin(spark, path)
    if target.schema.names != batch.schema.names:
        _save_schema(spark, path, batch.schema)
    months = batch.select(PARTITION).union(replaced.select(PARTITION)).distinct()
    touched = [r[0] for r in months.collect()]  # months, not rides
    if not touched:
        return 0
    if on_touch:
        on_touch(touched)
    mark = read_mark(spark, path)
    old = target.where(_in_months(touched))
    merged = upsert(old, batch, keys, replaced.select(*keys))
    gone = schema_sync(old, batch.schema).join(replaced.select(*keys), keys, "left_semi")
    changes.stage(spark, path, seq, gone, batch)
    index.add(batch, found)
    stage = f"{path}_stage/{seq:020d}"
    merged.hint("rebalance", PARTITION).write.mode("overwrite").partitionBy(PARTITION).parquet(stage)
    left = {n for n in names(spark, stage) if n.startswith(f"{PARTITION}=")}
    for folder in sorted(left):
        replace(spark, f"{stage}/{folder}", f"{path}/{folder}")
    for month in touched:
        folder = f"{PARTITION}={'__HIVE_DEFAULT_PARTITION__' if month is None else month}"
        if folder not in left:
            delete(spark, f"{path}/{folder}")
    delete(spark, stage)
    spark.catalog.refreshByPath(path)
    _save_mark(spark, path, max(mark, watermark(batch).first()[0]))
    changes.commit(spark, path, seq)
    return batch.count()


def _in_months(months: list) -> Column:
    known = F.col(PARTITION).isin([m for m in months if m is not None])
    return known | F.col(PARTITION).isNull() if None in months else known


def read_landing(spark: SparkSession, path: str) -> int | None:
    """The last landing that the table at ``path`` has; None where that isn't kept."""
    at = f"{path}/{LANDING_FILE}"
    return int(read_text(spark, at)) if exists(spark, at) else None


def save_landing(spark: SparkSession, path: str, landing: int) -> None:
    write_text(spark, f"{path}/{LANDING_FILE}", str(landing))


def run_landings(spark: SparkSession, raw: DataFrame, stage: Callable[[DataFrame], DataFrame], path: str, head: int,
                 keys: Sequence[str] = ("ride_id",), strict: bool = False, on_touch: Callable[[list], None] | None = None) -> int:
    """One incremental run over the landings (column ``_landing`` of ``raw``) that the fact lacks, until ``head``.

    ``stage`` makes ride rows of raw ones.  No clock is asked, so rows that
    share a stamp with loaded ones, or carry an earlier one, come in.  A fact
    that knows of no landing is brought up by its watermark once.
    """
    done = read_landing(spark, path)
    n = 0
    if done is None:
        n = run_incremental(spark, stage(raw), path, keys, strict, on_touch)
    elif done < head:
        n = apply_batch(spark, stage(raw.where(F.col("_landing") > done)), path, keys, strict, on_touch)
    if done != head:
        save_landing(spark, path, head)
    return n


def run_incremental(spark: SparkSession, unioned: DataFrame, path: str, keys: Sequence[str] = ("ride_id",),
                    strict: bool = False, on_touch: Callable[[list], None] | None = None) -> int:
    """One watermark-driven incremental run against the Parquet fact at ``path``."""
    fresh = _after(unioned, read_mark(spark, path))
    # Nothing landed since the last run: the pushed-down watermark predicate
    # lets the scan skip row groups, and no dedup or staging job is started.
    if fresh.isEmpty():
        return 0
    return apply_batch(spark, fresh, path, keys, strict, on_touch)
