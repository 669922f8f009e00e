"""The fact's change feed: what every upsert retracted and inserted.

Beside a table at ``path`` lie ``<path>_feed/data/<seq>``, the rows of one
upsert with ``_op`` (-1 the copy that went, +1 the copy that came), and
``<path>_feed/log/<seq>.json``, written when the table has the change.  A reader
follows the log, so it never sees half a change.  Where a run died between the
two, the next one logs that number as ``reset``: readers start from the table
again.  A full refresh is a reset too.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fs import delete, exists, names, publish_text

LOG_SCHEMA = "seq long, kind string"
CHANGES, RESET = "changes", "reset"


def log_path(path: str) -> str:
    return f"{path}_feed/log"


def _data(path: str, seq: int) -> str:
    return f"{path}_feed/data/{seq:020d}"


def head(spark: SparkSession, path: str) -> int:
    """The last number logged; 0 where there is no feed."""
    return max((int(n.split(".")[0]) for n in names(spark, log_path(path)) if n.endswith(".json")), default=0)


def begin(spark: SparkSession, path: str) -> int:
    """The number of the next change; one that a dead run left open becomes a reset."""
    seq = head(spark, path) + 1
    if exists(spark, _data(path, seq)):
        commit(spark, path, seq, RESET)
        seq += 1
    return seq


def stage(spark: SparkSession, path: str, seq: int, retracted: DataFrame, inserted: DataFrame) -> None:
    """Write a change before the table gets it."""
    rows = retracted.withColumn("_op", F.lit(-1)).unionByName(inserted.withColumn("_op", F.lit(1)), allowMissingColumns=True)
    rows.write.mode("overwrite").parquet(_data(path, seq))


def commit(spark: SparkSession, path: str, seq: int, kind: str = CHANGES) -> None:
    publish_text(spark, f"{log_path(path)}/{seq:020d}.json", json.dumps({"seq": seq, "kind": kind}) + "\n")


def trim(spark: SparkSession, path: str, upto: int) -> None:
    """Delete the rows of changes that all readers have; the log stays."""
    for name in names(spark, f"{path}_feed/data"):
        if int(name) <= upto:
            delete(spark, f"{path}_feed/data/{name}")


def read(spark: SparkSession, path: str, seqs: list[int]) -> DataFrame:
    """The rows of some changes, with ``_op`` and ``_seq``."""
    each = [spark.read.parquet(_data(path, s)).withColumn("_seq", F.lit(s).cast("long")) for s in seqs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each)
