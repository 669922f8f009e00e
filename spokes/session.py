"""SparkSession helpers.

Library code never creates its own session; it takes the caller's.  These
helpers are for tests, the benchmark and the CLI entry points.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session used with this package should carry.  Ride times are
# wall-clock TIMESTAMP_NTZ end to end; UTC only matters for the streaming cast.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # row_number() = 1 dedups rely on the partial WindowGroupLimit (map-side
    # top-1 per key before the shuffle); keep the rule on.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


# Settings of the ride queries.  A ride is some 25 bytes in Parquet and 450 in a
# sort, so tasks of Spark's usual sizes (128 MB of a file, 64 MB of a shuffle) sort
# more than a core's share of memory and spill it.  Many initial partitions cost
# little: small ones are merged up to the advisory size.
RIDE_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "spokes",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SPOKES_DRIVER_MEMORY", "8g"))
    )
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the session settings the operators rely on (idempotent)."""
    for k, v in SESSION_DEFAULTS.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def apply_ride_settings(spark: SparkSession) -> SparkSession:
    """Size tasks for rides; an initial partition count that is larger already stays."""
    count = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    for k, v in RIDE_SETTINGS.items():
        if k != count or int(spark.conf.get(k, None) or 0) < int(v):
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared, durable folder and is
    used as is; unset, it is an error there, since a folder of one machine is no
    place for what others read.  A local session gets a scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is not set: it has to name a folder that all executors share")
    if not current:
        current = tempfile.mkdtemp(prefix="spokes-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    import uuid

    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared work folder: cut lineage, known bytes."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Target bytes per shuffle partition when sizing for the input (AQE coalesces
# smaller ones and splits skewed ones; this sets the upper end).
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
MIN_SHUFFLE_PARTITIONS = 200


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total on-disk bytes under ``paths`` (file-system metadata only, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def size_shuffles(spark: SparkSession, nbytes: int, expansion: float = 3.0) -> int:
    """Set ``spark.sql.shuffle.partitions`` so each partition holds ~256 MB of
    in-memory rows (Parquet expands ~``expansion`` x when decoded).

    Only ever raises the setting; AQE coalesces partitions that turn out small.
    """
    want = int(nbytes * expansion // TARGET_PARTITION_BYTES) + 1
    want = max(MIN_SHUFFLE_PARTITIONS, want)
    current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    if want > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(want))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(want))
    return max(want, current)
