"""Deterministic synthetic trips and zones derived from the driver's Parquet tables.

The raw trip CSVs and GeoJSON layers of a real deployment are not available in
tests, so every query runs on rides that Spark derives from the TPC-H-ish
tables: system ``alpha`` from ``events``, system ``beta`` from ``lineitem``
joined to ``orders``.  Work therefore grows with the input tables.

The mapping is documented in FIXTURES.md §2 and mirrored in SQL by
``spokes.oracle`` for the DuckDB comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import STG_COLUMNS

SYSTEMS = ("alpha", "beta")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _station_cols(prefix: str, x: Column, k: Column) -> list[Column]:
    """id / name / lat / lng of synthetic station ``x`` jittered by ``k``.

    Ids 90-99 reuse the names of 0-9 (a relocated station keeps its name).
    """
    is_null = x.isNull()

    def nn(c: Column) -> Column:
        return F.when(~is_null, c)

    return [
        nn(x.cast("string")).alias(f"{prefix}_station_id"),
        nn(F.concat(F.lit("Station "), (x % 90).cast("string"))).alias(f"{prefix}_station_name"),
        nn((F.lit(38_800_000) + (x % 10) * 20_000 + (k % 7) * 100) / F.lit(1e6)).alias(f"{prefix}_lat"),
        nn((F.lit(-77_120_000) + F.floor(x / 10) * 20_000 + (k % 5) * 100) / F.lit(1e6)).alias(f"{prefix}_lng"),
    ]


def alpha_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    eid, uid = F.col("event_id"), F.col("user_id")
    s = F.when(eid % 41 != 0, uid % 100)
    e = F.when(eid % 37 == 0, F.lit(None)).when(eid % 10 == 0, uid % 100).otherwise(eid % 100)
    end_micros = F.floor(F.col("value") * 1000).cast("bigint") * 20_000 - 60_000_000
    df = ev.select(
        F.concat(F.lit("E"), eid.cast("string")).alias("ride_id"),
        F.when(F.col("event_type").isin("view", "click"), "classic_bike")
        .otherwise("electric_bike")
        .alias("rideable_type"),
        F.col("ts").cast("timestamp_ntz").alias("started_at"),
        F.timestamp_add("MICROSECOND", end_micros, F.col("ts").cast("timestamp_ntz")).alias("ended_at"),
        *_station_cols("start", s, eid),
        *_station_cols("end", e, eid),
        F.when(uid % 3 == 0, "casual").otherwise("member").alias("member_casual"),
        F.when(eid % 2 == 0, F.lit("2024-02-01 00:00:00"))
        .otherwise(F.lit("2024-02-02 00:00:00"))
        .cast("timestamp_ntz")
        .alias("_ingested_at"),
        F.when(eid % 2 == 0, "alpha-tripdata_1.csv").otherwise("alpha-tripdata_2.csv").alias("_source_file"),
        F.lit("alpha").alias("system"),
    )
    return df.select(*STG_COLUMNS)


def beta_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    start = F.timestamp_add(
        "MINUTE", sk % 60, F.timestamp_add("HOUR", pk % 24, F.col("o_orderdate").cast("timestamp_ntz"))
    )
    end_seconds = (
        F.col("l_quantity").cast("bigint") * 90
        - 300
        + F.when(F.col("l_discount") >= 0.1, F.lit(2 * 86_400)).otherwise(F.lit(0))
    )
    s = sk % 100
    e = F.when(pk % 37 == 0, F.lit(None)).when(pk % 10 == 0, sk % 100).otherwise(pk % 100)
    df = j.select(
        F.concat(F.lit("L"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias(
            "ride_id"
        ),
        F.when(F.col("l_linestatus") == "O", "classic_bike").otherwise("electric_bike").alias("rideable_type"),
        start.alias("started_at"),
        F.timestamp_add("SECOND", end_seconds, start).alias("ended_at"),
        *_station_cols("start", s, pk),
        *_station_cols("end", e, pk),
        F.when(F.col("l_returnflag") == "R", "casual").otherwise("member").alias("member_casual"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("_ingested_at"),
        F.lit("beta-tripdata.csv").alias("_source_file"),
        F.lit("beta").alias("system"),
    )
    return df.select(*STG_COLUMNS)


def staged_trips(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Per-system staged trips (the shape of a staging view)."""
    return {"alpha": alpha_trips(spark, sf_dir), "beta": beta_trips(spark, sf_dir)}
