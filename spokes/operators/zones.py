"""Zone analytics over a zone x month mart.

All inputs here are zone-grained (hundreds of rows per month), so the
aggregates are cheap; ratios are rounded to one decimal exactly (integer
arithmetic, half away from zero, as numeric ROUND does) so that they do not
depend on floating point.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_div

# The metric registry of the zone page (fixed labels).
METRICS = {
    "total_rides": "Total rides",
    "rides_per_km2": "Rides per km²",
    "rides_per_1k_residents": "Rides per 1,000 residents",
    "member_pct": "Member ride %",
    "avg_duration_minutes": "Avg trip duration (min)",
    "electric_pct": "E-bike ride %",
    "round_trip_pct": "Round trip %",
    "night_owl_pct": "Night owl % (12–5am)",
    "rides_per_station": "Rides per station",
}

# Column labels of the zone table, in display order (fixed values).
TABLE_LABELS = {
    "zone_id": "Zone",
    "total_rides": "Total rides",
    "arrival_rides": "Arrivals",
    "net_flow": "Net inflow",
    "electric_pct": "E-bike %",
    "round_trip_pct": "Round trip %",
    "night_owl_pct": "Night owl %",
    "rides_per_station": "Rides/station",
    "weekday_rides": "Weekday rides",
    "weekend_rides": "Weekend rides",
    "member_pct": "Member %",
    "rides_per_km2": "Rides/km²",
    "rides_per_1k_residents": "Rides/1k residents",
    "avg_duration_minutes": "Avg duration (min)",
    "population": "Population",
    "median_household_income": "Median HH income",
}


def ratio1(num: Column, den: Column, scale: int = 1) -> Column:
    """ROUND(num * scale / NULLIF(den, 0), 1) for non-negative integers, exactly."""
    n = num.cast("bigint") * F.lit(10 * scale)
    d = den.cast("bigint")
    return F.when(d != 0, round_div(n, d) / F.lit(10.0))


def zone_metrics(mart: DataFrame, id_col: str, month_start: dt.date, month_end: dt.date) -> DataFrame:
    """Re-aggregate a month-grained zone mart over a closed month range.

    Additive columns are summed, static context re-aggregates by MAX, and
    every ratio is recomputed from the sums (never averaged).
    """
    a, b = sorted((month_start, month_end))
    m = mart.where(F.col("started_month").between(F.lit(a), F.lit(b)))
    g = m.groupBy(F.col(id_col).alias("zone_id")).agg(
        F.sum("total_rides").alias("total_rides"),
        F.sum("member_rides").alias("member_rides"),
        F.sum("casual_rides").alias("casual_rides"),
        F.sum("total_duration_seconds").alias("_dur"),
        F.max("area_km2").alias("area_km2"),
        F.max("centroid_lat").alias("centroid_lat"),
        F.max("centroid_lng").alias("centroid_lng"),
        F.max("population").alias("population"),
        F.max("households").alias("households"),
        F.max("median_household_income").alias("median_household_income"),
        F.sum("weekday_rides").alias("weekday_rides"),
        F.sum("weekend_rides").alias("weekend_rides"),
        F.sum("arrival_rides").alias("arrival_rides"),
        F.sum("electric_rides").alias("electric_rides"),
        F.sum("round_trip_rides").alias("round_trip_rides"),
        F.sum("night_owl_rides").alias("night_owl_rides"),
        F.max("station_count").alias("station_count"),
    )
    n = F.col("total_rides")
    area_units = (F.col("area_km2").cast("decimal(18,4)") * 10000).cast("bigint")
    return g.select(
        "zone_id",
        "total_rides",
        "member_rides",
        "casual_rides",
        ratio1(F.col("_dur"), n * 60).alias("avg_duration_minutes"),
        "area_km2",
        "centroid_lat",
        "centroid_lng",
        "population",
        "households",
        "median_household_income",
        "weekday_rides",
        "weekend_rides",
        "arrival_rides",
        (F.col("arrival_rides") - n).alias("net_flow"),
        "electric_rides",
        ratio1(F.col("electric_rides"), n, 100).alias("electric_pct"),
        "round_trip_rides",
        "night_owl_rides",
        "station_count",
        ratio1(F.col("round_trip_rides"), n, 100).alias("round_trip_pct"),
        ratio1(F.col("night_owl_rides"), n, 100).alias("night_owl_pct"),
        ratio1(n, F.col("station_count")).alias("rides_per_station"),
        ratio1(F.col("member_rides"), n, 100).alias("member_pct"),
        ratio1(F.col("weekend_rides"), n, 100).alias("weekend_pct"),
        ratio1(n, F.col("population"), 1000).alias("rides_per_1k_residents"),
        ratio1(n, area_units, 10000).alias("rides_per_km2"),
    )


def zone_table(metrics: DataFrame, sort_metric: str = "total_rides") -> DataFrame:
    """Zone table sorted by a chosen metric, descending, renamed for display."""
    if sort_metric not in METRICS:
        raise ValueError(f"unknown metric {sort_metric}")
    ordered = metrics.orderBy(F.col(sort_metric).desc_nulls_last(), F.col("zone_id"))
    return ordered.select(*[F.col(c).alias(label) for c, label in TABLE_LABELS.items()])


def zone_metric_quantiles(metrics: DataFrame, names=tuple(METRICS)) -> DataFrame:
    """p05 / p95 of each map metric (D25), linear interpolation like pandas.

    Input is one row per zone, so one exact ``percentile`` per metric is cheap.
    """
    long = metrics.select(
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in names])
        ).alias("r")
    ).select("r.*")
    q = long.groupBy("metric").agg(F.percentile(F.col("v"), F.array(F.lit(0.05), F.lit(0.95))).alias("q"))
    return q.select("metric", F.col("q")[0].alias("p05"), F.col("q")[1].alias("p95"))


def zone_display_names(metrics: DataFrame, meta: DataFrame, id_col: str, display_col: str | None) -> DataFrame:
    """Zone id -> display name, falling back to the id (C17)."""
    if display_col is None:
        return metrics.select("zone_id", F.col("zone_id").alias("display_name"))
    names = meta.select(F.col(id_col).alias("zone_id"), F.col(display_col).alias("_name"))
    return metrics.join(names, "zone_id", "left").select(
        "zone_id", F.coalesce(F.col("_name"), F.col("zone_id")).alias("display_name")
    )


def stations_per_zone_top(mapping: DataFrame, zone_col: str, n: int = 10) -> DataFrame:
    """Value counts of a station -> zone mapping, top n zones (D29); ties by zone id."""
    counts = mapping.groupBy(zone_col).agg(F.count(F.lit(1)).alias("stations"))
    return counts.orderBy(F.desc("stations"), F.asc(zone_col)).limit(n)


def top_population_zones(pop: DataFrame, zone_col: str, n: int = 10) -> DataFrame:
    """Head-n zones by population after a sort (F6); ties by zone id."""
    return pop.orderBy(F.col("population").desc_nulls_last(), F.asc(zone_col)).limit(n)


def layer_filter(layer: DataFrame, name_col: str, type_col: str | None = None, type_value: str | None = None,
                 polygon_only: bool = True) -> DataFrame:
    """Polygon features with a non-blank trimmed name [and an attribute value]."""
    name = F.trim(F.coalesce(F.col(name_col), F.lit("")))
    cond = name != ""
    if polygon_only:
        cond = cond & (F.col("geometry_type") == "Polygon")
    if type_col is not None:
        cond = cond & (F.col(type_col) == type_value)
    return layer.withColumn(name_col, name).where(cond)


def name_search(layer: DataFrame, name_col: str, pattern: str) -> DataFrame:
    """Case-insensitive regex 'contains'; NULL names never match."""
    return layer.where(F.col(name_col).isNotNull() & F.col(name_col).rlike("(?i)" + pattern))


def category_counts(layer: DataFrame, col: str) -> DataFrame:
    """Features per category."""
    return layer.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def listing(layer: DataFrame, sort_cols: list[str]) -> DataFrame:
    """multi-key listing sort."""
    return layer.orderBy(*sort_cols)
