"""Staging and union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import RAW_TRIP_COLUMNS, STG_COLUMNS


def stage_trips(raw: DataFrame, system: str | Column, coord_type: str = "decimal(18,15)", strict: bool = True) -> DataFrame:
    """Raw text landing rows -> typed staging rows of one system, or of the systems of a column.

    Casts text timestamps to TIMESTAMP_NTZ and coordinates to ``coord_type``,
    tags the ``system`` and drops rows without ``ride_id`` (B2).
    ``strict=True`` uses ANSI casts (a malformed value aborts the job, as a
    Postgres cast aborts the load); ``strict=False`` turns bad values into NULL.
    """
    cast = (lambda c, t: F.col(c).cast(t)) if strict else (lambda c, t: F.col(c).try_cast(t))
    typed = {
        "started_at": cast("started_at", "timestamp_ntz"),
        "ended_at": cast("ended_at", "timestamp_ntz"),
        **{c: cast(c, coord_type) for c in ("start_lat", "start_lng", "end_lat", "end_lng")},
    }
    cols = [typed.get(c, F.col(c)).alias(c) for c in RAW_TRIP_COLUMNS]
    ingested = F.col("_ingested_at") if "_ingested_at" in raw.columns else F.lit(None).cast("timestamp")
    return raw.where(F.col("ride_id").isNotNull()).select(
        *cols,
        ingested.cast("timestamp_ntz").alias("_ingested_at"),
        F.col("_source_file"),
        F.lit(system).alias("system"),
    )


def union_rides(*systems: DataFrame) -> DataFrame:
    """UNION ALL of every system's staging rows, by column name (G1)."""
    parts = [df.select(*STG_COLUMNS) for df in systems]
    return reduce(lambda a, b: a.unionByName(b), parts)


def cast_failures(raw: DataFrame, coord_type: str = "decimal(18,15)") -> DataFrame:
    """Quarantine count for ``strict=False`` staging: per typed column, the
    number of non-NULL texts that do not cast (one aggregate pass)."""
    targets = {"started_at": "timestamp_ntz", "ended_at": "timestamp_ntz",
               **{c: coord_type for c in ("start_lat", "start_lng", "end_lat", "end_lng")}}
    return raw.agg(
        *[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in targets.items()]
    )
