"""The load manifest: an append-only log of landings beside the raw table.

Every landing has a number.  ``<raw>_log/<number>.open`` says that it has begun,
``<number>.json``, published by a rename, that its rows are in the raw table and
which files they come from (a line each).  The raw rows carry the number, so
what follows the raw table asks for the landings after the last it has seen and
depends on no clock.  A landing that was begun and never committed (one ingest
runs at a time) is logged as aborted by the next one; its rows don't count.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fs import names, publish_text, write_text

SCHEMA = "landing long, aborted boolean, system string, file string"
LANDING = "_landing"


def _folder(raw_root: str) -> str:
    return f"{raw_root}_log"


def _numbers(spark: SparkSession, raw_root: str, kind: str) -> set[int]:
    return {int(n.split(".")[0]) for n in names(spark, _folder(raw_root)) if n.endswith(kind)}


def head(spark: SparkSession, raw_root: str) -> int:
    """The last landing committed (or aborted); 0 where there is none."""
    return max(_numbers(spark, raw_root, ".json"), default=0)


def _publish(spark: SparkSession, raw_root: str, landing: int, lines: list[dict]) -> None:
    text = "".join(json.dumps({"landing": landing, **line}) + "\n" for line in lines)
    publish_text(spark, f"{_folder(raw_root)}/{landing:020d}.json", text)


def begin(spark: SparkSession, raw_root: str) -> int:
    """Open the next landing."""
    done, opened = _numbers(spark, raw_root, ".json"), _numbers(spark, raw_root, ".open")
    for dead in sorted(opened - done):
        _publish(spark, raw_root, dead, [{"aborted": True}])
    landing = max(done | opened, default=0) + 1
    write_text(spark, f"{_folder(raw_root)}/{landing:020d}.open", "")
    return landing


def commit(spark: SparkSession, raw_root: str, landing: int, files: list[tuple[str, str]]) -> None:
    """The rows of ``files`` (system, name) are in the raw table."""
    _publish(spark, raw_root, landing, [{"aborted": False, "system": s, "file": f} for s, f in files] or [{"aborted": False}])


def _log(spark: SparkSession, raw_root: str) -> DataFrame:
    if not _numbers(spark, raw_root, ".json"):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("pathGlobFilter", "*.json").json(_folder(raw_root))


def loaded(spark: SparkSession, raw_root: str) -> DataFrame:
    """``system, file, landing`` of every file loaded; the raw table isn't read."""
    return _log(spark, raw_root).where("file IS NOT NULL").select("system", "file", "landing")


def counts(spark: SparkSession, raw_root: str) -> Column:
    """Whether a raw row counts: its landing is committed (rows from before the manifest have none)."""
    dead = [r[0] for r in _log(spark, raw_root).where("aborted").select("landing").collect()]  # landings that died
    known = F.col(LANDING) <= head(spark, raw_root)
    return F.col(LANDING).isNull() | (known & ~F.col(LANDING).isin(dead) if dead else known)
