"""Trip-CSV landing: list, route, skip-already-loaded, append.

A landing folder holds monthly trip files; the system is recognised from
the file name.  A file written by Spark is a folder ``name.csv/`` with part
files; both forms are recognised by the ``*.csv`` path component.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..fs import delete, exists, names, replace
from ..schemas import RAW_TRIP_COLUMNS, RAW_TRIP_SCHEMA
from ..session import work_dir, written
from . import manifest

# Filename patterns of the reference deployment (fixed values).
REFERENCE_SYSTEM_PATTERNS = {
    "capitalbikeshare": "capitalbikeshare-tripdata",
    "citibike": "citibike-tripdata",
}
# Rows of a compressed file: it is read by one task, which sorts them.
PACKED_ROWS = 100_000
# Patterns of the fixture systems.
FIXTURE_SYSTEM_PATTERNS = {"alpha": "alpha-tripdata", "beta": "beta-tripdata"}


def source_name(path: Column) -> Column:
    """Basename of the logical source file (``x.csv`` or the ``x.csv/`` folder of part files)."""
    # by string functions: this runs for every row, and a regular expression tries every place of a long path
    file, folder = F.substring_index(path, "/", -1), F.substring_index(F.substring_index(path, "/", -2), "/", 1)

    def is_source(name: Column) -> Column:
        return name.endswith(".csv") & (F.length(name) > len(".csv"))

    return F.when(is_source(folder), folder).when(is_source(file), file).when(path.isNotNull(), "")


def route_system(name: Column, patterns: dict[str, str]) -> Column:
    """A3: file name -> system, NULL when no pattern matches (the file is skipped)."""
    expr = None
    for system, pat in patterns.items():
        # LIKE is a regular expression here; a pattern without wildcards that can't run into the ending needs none
        plain = not set(pat) & set("%_\\") and not pat.endswith((".", ".c", ".cs", ".csv"))
        cond = name.contains(pat) & name.endswith(".csv") if plain else name.like(f"%{pat}%.csv")
        expr = F.when(cond, F.lit(system)) if expr is None else expr.when(cond, F.lit(system))
    return expr


def with_source(rows: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Rows of a file scan with ``_source_file`` and ``system``.

    ``input_file_name`` is no deterministic expression, so the name is made once
    for a row; one of ``_metadata.file_path`` is made again wherever the name is used.
    """
    named = rows.withColumn("_source_file", source_name(F.input_file_name()))
    return named.withColumn("system", route_system(F.col("_source_file"), patterns))


def landing_files(spark: SparkSession, landing: str, patterns: dict[str, str]) -> DataFrame:
    """(file, system, path) for every CSV under ``landing``; listing only, contents not read."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(landing)
        .select("path")
    )
    named = listed.select(source_name(F.col("path")).alias("file"), "path")
    return named.select("file", route_system(F.col("file"), patterns).alias("system"), "path")


def unprocessed_files(files: DataFrame, done: DataFrame) -> DataFrame:
    """Routed files whose name the manifest doesn't have for their system."""
    known = files.where(F.col("system").isNotNull())
    return known.join(done.select("system", "file"), ["system", "file"], "left_anti")


def file_statuses(files: DataFrame, done: DataFrame) -> DataFrame:
    """Per logical file: loaded (new) / skipped (unknown system or already loaded); a load may still fail."""
    logical = files.select("file", "system").distinct()
    done = done.select("system", "file").distinct().withColumn("_done", F.lit(True))
    logical = logical.join(done, ["system", "file"], "left")
    status = F.when(F.col("system").isNull() | F.col("_done").isNotNull(), "skipped").otherwise("loaded")
    return logical.select("file", "system", status.alias("status"))


def ingest_summary(statuses: DataFrame) -> DataFrame:
    """A5: loaded / skipped / failed counts."""
    counts = statuses.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    base = statuses.sparkSession.createDataFrame([("loaded",), ("skipped",), ("failed",)], "status string")
    return base.join(counts, "status", "left").select("status", F.coalesce(F.col("n"), F.lit(0)).alias("n"))


def read_trip_csvs(spark: SparkSession, paths: list[str], patterns: dict[str, str]) -> DataFrame:
    """A1 + A2: header CSV with the fixed all-text schema, stamped with provenance.

    ``_malformed`` tells rows with too few or too many fields; columns aren't
    pruned, since the parser sees the number of fields only in whole rows.
    """
    schema = StructType([*RAW_TRIP_SCHEMA.fields, StructField("_bad", StringType())])
    df = (
        spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad").option("columnPruning", False).csv(paths)
    )
    return with_source(df.select(
        *RAW_TRIP_COLUMNS,
        F.col("_bad").isNotNull().alias("_malformed"),
        F.current_timestamp().alias("_ingested_at"),
    ), patterns)


RAW_SCHEMA = StructType([*RAW_TRIP_SCHEMA.fields, StructField("_ingested_at", TimestampType()), StructField("_source_file", StringType()),
                         StructField(manifest.LANDING, LongType()), StructField("system", StringType())])


def read_raw(spark: SparkSession, raw_root: str) -> DataFrame:
    """The raw rows of all committed landings."""
    return spark.read.schema(RAW_SCHEMA).parquet(raw_root).where(manifest.counts(spark, raw_root))


def ingest(spark: SparkSession, landing: str, raw_root: str, patterns: dict[str, str]) -> DataFrame:
    """One idempotent load run; returns the per-file statuses of this run.

    What is loaded the manifest knows; the raw table isn't read.  A file with a
    malformed row fails as a whole: none of its rows is appended, the other
    files load, and a corrected file of that name loads next time.  Only names
    of new files reach the driver (to build the reader's path list); rows are
    parsed once, into a staging table, and go from there to the partitioned
    append.  They count when the landing is committed.
    """
    files = landing_files(spark, landing, patterns)
    if exists(spark, raw_root) and not manifest.head(spark, raw_root):  # a table from before the manifest
        held = spark.read.schema(RAW_SCHEMA).parquet(raw_root).select("system", "_source_file").distinct().collect()
        manifest.commit(spark, raw_root, manifest.begin(spark, raw_root), [tuple(r) for r in held])
    done = manifest.loaded(spark, raw_root)
    # frozen before the commit changes the manifest (reliable checkpoint in spark.checkpoint.dir, not a local one)
    statuses = file_statuses(files, done).checkpoint()
    todo = [r["path"] for r in unprocessed_files(files, done).select("path").collect()]
    if not todo:
        return statuses
    number = manifest.begin(spark, raw_root)
    rows = written(read_trip_csvs(spark, todo, patterns), "landed")
    failed = rows.where("_malformed").select("system", F.col("_source_file").alias("file")).distinct()
    failed = written(failed, "failed-files")
    statuses = statuses.join(failed.withColumn("_failed", F.lit(True)), ["system", "file"], "left").select(
        "file", "system", F.when(F.col("_failed"), "failed").otherwise(F.col("status")).alias("status")).checkpoint()
    whole = rows.join(failed.withColumnRenamed("file", "_source_file"), ["system", "_source_file"], "left_anti")
    whole = whole.withColumn(manifest.LANDING, F.lit(number).cast("long"))
    whole.select(*RAW_SCHEMA.names).write.mode("append").partitionBy("system").parquet(raw_root)
    loaded = statuses.where("status = 'loaded'").select("system", "file").collect()  # of this landing, as its paths
    manifest.commit(spark, raw_root, number, [tuple(r) for r in loaded])
    return statuses


def write_raw_csvs(staged: DataFrame, landing: str, with_ingested: bool = False, suffix: str = "",
                   compression: str = "none") -> None:
    """Fixture sink: staged rows -> one CSV source per ``_source_file`` (text, header).

    ``with_ingested`` also writes ``_ingested_at`` so a stream can replay the
    fixture's load times; ``suffix`` renames the files (a replayed copy).  A packed
    file can't be split, so it has up to ``PACKED_ROWS`` rows.  The rows
    are made and read once for all sources: each is a partition, moved to its name.
    """
    extra = [F.col("_ingested_at").cast("string").alias("_ingested_at")] if with_ingested else []
    texts = staged.select(*[F.col(c).cast("string").alias(c) for c in RAW_TRIP_COLUMNS], *extra, "_source_file")
    spark = staged.sparkSession
    stage, writers = work_dir(spark, "csv-stage"), "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers, None)
    spark.conf.set(writers, "16")  # a task's rows go to their few sources as they come, without a sort
    try:
        texts.where(F.col("_source_file").isNotNull()).write.partitionBy("_source_file").option("header", True).option(
            "compression", compression).option("maxRecordsPerFile", 0 if compression == "none" else PACKED_ROWS).csv(stage)
    finally:
        spark.conf.unset(writers) if before is None else spark.conf.set(writers, before)
    for folder in [n for n in names(spark, stage) if n.startswith("_source_file=")]:
        name = unquote(folder.partition("=")[2])
        replace(spark, f"{stage}/{folder}", f"{landing}/{name[:-4] + suffix + '.csv' if suffix else name}")
    delete(spark, stage)
