"""What the dashboard counts, kept by month: a lattice of ride counts, and station sets as bitmaps.

One pass over the rides counts them by start, by end, by route, by hour and by
weekday (``GROUPING SETS``), for each system and month; counts of any period are
sums of these.  Distinct stations don't add up, so each month keeps an exact
bitmap of dictionary codes; the bitmaps of a period are united.  Both tables
follow the fact month by month, and their readers see no ride.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..filters import RideFilter
from ..fs import delete, exists, names
from ..session import written

MONTH = "started_month"
CUTS = {"start": ["start_station_name"], "end": ["end_station_name"], "route": ["start_station_name", "end_station_name"],
        "hour": ["started_hour"], "dow": ["started_dow", "started_dow_name"]}
COLUMNS = ["start_station_name", "end_station_name", "started_hour", "started_dow", "started_dow_name"]
READ = [MONTH, "system", "start_station_id", *COLUMNS]  # all that an update reads of a ride


def lattice(fct: DataFrame) -> DataFrame:
    """``started_month, cut, system``, the cut's columns (others null) and ``rides``, by one aggregate."""
    every = [MONTH, "system"]
    sets = [[*every, *cols] for cols in CUTS.values()]
    got = fct.groupingSets(sets, *every, *COLUMNS).agg(F.grouping_id().alias("_set"), F.count("*").alias("rides"))
    # the grouping id has a bit for each column that is rolled up, the last column's the lowest
    of = [*every, *COLUMNS]
    number = {name: sum(1 << (len(of) - 1 - i) for i, c in enumerate(of) if c not in (*every, *cols)) for name, cols in CUTS.items()}
    cut = F.create_map(*(x for name, k in number.items() for x in (F.lit(k).cast("long"), F.lit(name))))
    return got.select(MONTH, cut[F.col("_set").cast("long")].alias("cut"), "system", *COLUMNS, "rides")


def new_codes(fct: DataFrame, codes: DataFrame | None) -> DataFrame:
    """``system, station_id, code`` of the start stations that ``codes`` lacks; codes lie close together."""
    seen = fct.where("start_station_id IS NOT NULL").select("system", F.col("start_station_id").alias("station_id")).distinct()
    base = 0
    if codes is not None:
        seen = seen.join(codes, ["system", "station_id"], "left_anti")
        base = ((codes.agg(F.max("code")).first()[0] or 0) >> 33) + 1
    # numbers run within each task, 32 768 to a bitmap
    return seen.select("system", "station_id", (F.monotonically_increasing_id() + F.lit(base << 33)).alias("code"))


def station_bitmaps(fct: DataFrame, codes: DataFrame) -> DataFrame:
    """``started_month, system, bucket, stations``: the start stations of each month as bitmaps of their codes."""
    rides = fct.where("start_station_id IS NOT NULL").groupBy(MONTH, "system", F.col("start_station_id").alias("station_id")).agg(F.lit(1))
    coded = rides.join(codes, ["system", "station_id"])
    return coded.groupBy(MONTH, "system", F.bitmap_bucket_number("code").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("stations"))


@dataclass
class Summary:
    """The kept tables, in place of the fact for the dashboard's counts."""

    counts: DataFrame
    stations: DataFrame

    def _of(self, cut: str, f: RideFilter) -> DataFrame:
        return self.counts.where((F.col("cut") == cut) & f.monthly())

    def _sum(self, cut: str, f: RideFilter) -> DataFrame:
        return self._of(cut, f).groupBy("system", *CUTS[cut]).agg(F.sum("rides").alias("rides"))

    def station_counts(self, f: RideFilter, side: str) -> DataFrame:
        """Rides by station name."""
        name = f"{side}_station_name"
        return self._sum(side, f).where(F.col(name).isNotNull()).withColumnRenamed(name, "station_name")

    def route_counts(self, f: RideFilter) -> DataFrame:
        """Rides by pair of different names."""
        return self._sum("route", f).where(F.col("start_station_name") != F.col("end_station_name"))

    def by_hour(self, f: RideFilter) -> DataFrame:
        return self._sum("hour", f)

    def by_dow(self, f: RideFilter) -> DataFrame:
        return self._sum("dow", f)

    def active_stations(self, f: RideFilter) -> DataFrame:
        """Distinct start stations of the period."""
        united = self.stations.where(f.monthly()).groupBy("system", "bucket").agg(F.bitmap_or_agg("stations").alias("stations"))
        return united.groupBy("system").agg(F.sum(F.bitmap_count("stations")).alias("active_stations"))


def read(spark: SparkSession, root: str) -> Summary:
    return Summary(spark.read.parquet(f"{root}/ride_counts"), spark.read.parquet(f"{root}/month_stations"))


def update(spark: SparkSession, fct: DataFrame, root: str, months: list[dt.date] | None = None) -> Summary:
    """Bring the tables under ``root`` up to the fact: all of them, or the ``months`` it has changed."""
    codes_at, counts_at, sets_at = (f"{root}/{n}" for n in ("station_codes", "ride_counts", "month_stations"))
    if months is None or not all(exists(spark, at) for at in (codes_at, counts_at, sets_at)):
        months, mode = None, "static"
    else:
        mode = "dynamic"
        fct = fct.where(F.col(MONTH).isin(months))
    # codes stay: the other months' bitmaps count on them
    codes = spark.read.parquet(codes_at) if exists(spark, codes_at) else None
    written(new_codes(fct, codes), "station-codes").write.mode("append").parquet(codes_at)
    codes = spark.read.parquet(codes_at)
    for rows, at, keys in ((lattice(fct), counts_at, ["cut", MONTH]), (station_bitmaps(fct, codes), sets_at, [MONTH])):
        rows = written(rows, "summary")
        rows.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*keys).parquet(at)
        gone = set(months or ()) - {r[0] for r in rows.select(MONTH).distinct().collect()}
        for month in gone:  # a month without rides
            for folder in [f"{at}/{n}" for n in names(spark, at) if n.startswith("cut=")] or [at]:
                delete(spark, f"{folder}/{MONTH}={month}")
        spark.catalog.refreshByPath(at)
    return read(spark, root)
