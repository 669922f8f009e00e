"""Structured Streaming twins of the incremental operators.

* S1 ``stream_ingest``: file source over the landing folder; the checkpoint
  records processed files, so each file is loaded exactly once and a re-run
  after a clean finish adds nothing (replaces the skip-loaded listing, and
  the timestamp watermark of S5).
* S2 ``stream_upsert``: ``foreachBatch`` runs the delete+insert upsert; it is
  idempotent, so the at-least-once replay of a failed batch is harmless.
* S3 ``stream_dedup``: drops exact replays by comparing with the written table.
* S4 ``stream_daily_rollup``: follows the fact's change feed, retractions included.

Neither S3 nor S4 holds state or a watermark, so no late row is lost.
All jobs run with ``trigger(availableNow=True)`` and return when caught up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..fs import exists
from ..operators import changes, daily_view, incremental, staging
from ..schemas import RAW_TRIP_COLUMNS, RAW_TRIP_SCHEMA
from ..session import written
from ..sources.trips_csv import with_source


def _trip_stream(spark: SparkSession, landing_glob: str, patterns: dict[str, str], files_per_trigger: int | None,
                 ingested_in_file: bool = False):
    """Landed trip rows.  ``_ingested_at`` is the arrival time, or, for replayable
    fixtures, a text column carried by the files themselves."""
    schema = (
        StructType(RAW_TRIP_SCHEMA.fields + [StructField("_ingested_at", StringType())])
        if ingested_in_file
        else RAW_TRIP_SCHEMA
    )
    reader = spark.readStream.schema(schema).option("header", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    df = reader.csv(landing_glob)
    ingested = F.col("_ingested_at").cast("timestamp_ntz") if ingested_in_file else F.current_timestamp()
    rows = with_source(df.select(*RAW_TRIP_COLUMNS, ingested.alias("_ingested_at")), patterns)
    return rows.where(F.col("system").isNotNull())


def _run(writer) -> None:
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def stream_ingest(spark: SparkSession, landing_glob: str, raw_root: str, checkpoint: str,
                  patterns: dict[str, str], files_per_trigger: int | None = None) -> None:
    """New landing files -> raw table partitioned by system (append, exactly once per file)."""
    stream = _trip_stream(spark, landing_glob, patterns, files_per_trigger)
    _run(
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .partitionBy("system").option("path", raw_root).outputMode("append")
    )


def stream_upsert(spark: SparkSession, landing_glob: str, fact_path: str, checkpoint: str,
                  patterns: dict[str, str], systems: tuple[str, ...], coord_type: str = "decimal(18,15)",
                  keys: tuple[str, ...] = ("ride_id",), files_per_trigger: int | None = None,
                  ingested_in_file: bool = False) -> None:
    """Each micro-batch of landed rows is staged and upserted into the fact."""
    stream = _trip_stream(spark, landing_glob, patterns, files_per_trigger, ingested_in_file)

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        # all systems at once: a branch for each would parse the files once for each
        staged = staging.stage_trips(batch.where(F.col("system").isin(*systems)), F.col("system"), coord_type)
        incremental.apply_batch(batch.sparkSession, staging.union_rides(staged), fact_path, keys)

    _run(stream.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", checkpoint))


def stream_dedup(spark: SparkSession, landing_glob: str, out_path: str, checkpoint: str,
                 patterns: dict[str, str]) -> None:
    """S3: append raw rows that the table doesn't hold yet (same 13 raw columns), however late they come.

    Each micro-batch is compared with the months of the table that it touches;
    there is no state and no time limit.  A replayed batch finds its own rows
    and adds nothing.
    """
    stream = _trip_stream(spark, landing_glob, patterns, None).select(*RAW_TRIP_COLUMNS)
    month = F.substring(F.coalesce("started_at", F.lit("")), 1, 7)
    schema = StructType([*RAW_TRIP_SCHEMA.fields, StructField("_month", StringType())])

    def append_new(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        new = batch.dropDuplicates(RAW_TRIP_COLUMNS).withColumn("_month", month)
        new = written(new, "stream-batch")
        if exists(session, out_path):
            months = [r[0] for r in new.select("_month").distinct().collect()]
            held = session.read.schema(schema).parquet(out_path)
            held = held.where(F.coalesce("_month", F.lit("")).isin(months))  # an empty partition value is read as null
            held = held.withColumn("_key", F.xxhash64(*RAW_TRIP_COLUMNS)).alias("h")
            keyed = new.withColumn("_key", F.xxhash64(*RAW_TRIP_COLUMNS)).alias("n")
            same = F.col("n._key") == F.col("h._key")
            for c in RAW_TRIP_COLUMNS:
                same = same & F.col(f"n.{c}").eqNullSafe(F.col(f"h.{c}"))
            new = written(keyed.join(held, same, "left_anti").drop("_key"), "stream-new")
        new.write.mode("append").partitionBy("_month").parquet(out_path)

    _run(stream.writeStream.foreachBatch(append_new).option("checkpointLocation", checkpoint))


def stream_daily_rollup(spark: SparkSession, fact_path: str, out_path: str, checkpoint: str) -> None:
    """The daily mart, kept up with what the fact's upserts retract and insert.

    The stream reads the log of the fact's change feed; each micro-batch applies
    its changes to the groups they touch (``daily_view``).  A fact without a feed
    is rolled up once.  A month that loses its last ride leaves the mart, late
    rides count, and a batch replayed after a failure changes nothing.
    """
    if not exists(spark, changes.log_path(fact_path)):
        changes.commit(spark, fact_path, changes.begin(spark, fact_path), changes.RESET)
    log = spark.readStream.schema(changes.LOG_SCHEMA).json(changes.log_path(fact_path))

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        entries = [tuple(r) for r in batch.select("seq", "kind").collect()]  # one for each upsert since the last run
        if entries:
            daily_view.follow(session, fact_path, lambda: incremental.read_fact(session, fact_path), out_path,
                              sorted(s for s, kind in entries if kind == changes.CHANGES),
                              reset=any(kind == changes.RESET for _, kind in entries))

    _run(log.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint))


def read_daily(spark: SparkSession, out_path: str) -> DataFrame:
    """The daily mart that the stream keeps."""
    return daily_view.read(spark, out_path)
