"""The refresh pipeline: land -> stage -> fact (incremental) -> dimension -> marts -> checks.

``refresh`` is the Spark counterpart of the shell + model-runner refresh:
each step reads what the previous one wrote, so a failed run can be resumed
from the last written table.  Tables live under ``root`` (a shared folder):

    root/raw            raw landing rows, partitioned by system (append)
    root/fct_rides      ride fact, partitioned by started_month (incremental)
    root/dim_stations   station dimension (overwrite)
    root/agg_rides_daily
    root/ride_counts, root/month_stations   the dashboard's counts and station sets by month
    root/agg_rides_by_<boundary>   zone x month marts (overwrite)
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo
from ..operators import facts, incremental, marts, quality, spatial, staging, stations, summary
from ..sources import census as census_src
from ..sources import geojson, manifest, seeds, trips_csv
from ..fs import delete, exists, read_text, write_text
from ..session import input_bytes, size_shuffles, written


@dataclass
class ZoneBoundary:
    """Seeds of one boundary definition (station -> zone map, meta, population)."""

    name: str
    id_col: str
    mapping: DataFrame
    meta: DataFrame
    population: DataFrame
    display_col: str | None = None


# Boundary -> (file stem of its seeds, zone column, display column).
SEEDED = {
    "neighborhood": ("neighborhood", "neighborhood_name", None),
    "cluster": ("cluster", "cluster_id", "cluster_display_name"),
    "tract": ("census_tract", "tract_geoid", "tract_name"),
    "block_group": ("block_group", "bg_geoid", "bg_name"),
}


def seeded_boundaries(spark: SparkSession, folder: str, prefix: str = "dc_") -> tuple[ZoneBoundary, ...]:
    """The boundaries whose three seed files are in ``folder``.

    ``<prefix><stem>s.csv`` (zones), ``<prefix><stem>_population.csv`` and
    ``<prefix>station_<stem>s.csv``, read by their headers with the declared types.
    """
    types = {"area_km2": "decimal(18,4)", "centroid_lat": "double", "centroid_lng": "double", "population": "bigint",
             "households": "bigint", "median_household_income": "double"}

    def seed(name: str) -> DataFrame:
        path = f"{folder}/{prefix}{name}.csv"
        header = spark.read.option("header", True).csv(path).columns
        return seeds.read_seed(spark, path, ", ".join(f"`{c}` {types.get(c, 'string')}" for c in header))

    out = []
    for name, (stem, id_col, display) in SEEDED.items():
        if exists(spark, f"{folder}/{prefix}{stem}s.csv"):
            out.append(ZoneBoundary(name, id_col, seed(f"station_{stem}s"), seed(f"{stem}s"),
                                    seed(f"{stem}_population"), display))
    return tuple(out)


def enriched_boundary(spark: SparkSession, name: str, layer: DataFrame, census: DataFrame, tracts: DataFrame,
                      stations_dim: DataFrame, id_col: str = "zone_id") -> ZoneBoundary:
    """A boundary made from a polygon layer: area and centroid, population by tract overlap, stations by place.

    ``layer`` (``id_col``, geometry); ``tracts`` (geoid, geometry); ``census`` (geoid and the cleaned counts).
    """
    meta = layer.select(id_col, geo.area_km2(F.col("geometry")).alias("area_km2"),
                        geo.let(F.col("geometry"), geo.centroid).alias("c"))
    meta = meta.select(id_col, "area_km2", F.round("c.y", 6).alias("centroid_lat"), F.round("c.x", 6).alias("centroid_lng"))
    overlay = spatial.polygon_overlay(layer, tracts, id_col, "geoid")
    pop = spatial.area_weighted_population(overlay, census, id_col, "geoid")
    mapping = spatial.assign_stations(stations_dim, layer, zone_col=id_col).select("station_id", id_col)
    return ZoneBoundary(name, id_col, written(mapping, "station-zones"), written(meta, "zone-meta"), written(pop, "zone-pop"))


@dataclass
class RefreshConfig:
    landing: str
    root: str
    patterns: dict[str, str] = field(default_factory=lambda: dict(trips_csv.REFERENCE_SYSTEM_PATTERNS))
    coord_type: str = "decimal(18,15)"
    keys: tuple[str, ...] = ("ride_id",)
    zone_system: str = "capitalbikeshare"
    boundaries: tuple[ZoneBoundary, ...] = ()
    zone_layer: str | None = None  # GeoJSON FeatureCollection of zones, property zone_id
    tract_layer: str | None = None  # GeoJSON FeatureCollection of census tracts, property GEOID
    census: str | None = None  # census API response
    full_refresh: bool = False
    size_shuffles: bool = True


class _Pending:
    """Months of the fact that the marts have to follow, in a small file."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self) -> set[str]:
        return set(json.loads(read_text(self.spark, self.path))) if exists(self.spark, self.path) else set()

    def add(self, months: list) -> None:
        write_text(self.spark, self.path, json.dumps(sorted(self._read() | {str(m) for m in months})))

    def months(self) -> list[dt.date] | None:
        """The months; None for all (also where a ride has none)."""
        found = self._read()
        return None if found & {"all", "None"} else sorted(map(dt.date.fromisoformat, found))

    def clear(self) -> None:
        delete(self.spark, self.path)


def _of_months(fct: DataFrame, months: list[dt.date] | None) -> DataFrame:
    return fct if months is None else fct.where(F.col("started_month").isin(months))


def _replace_months(spark: SparkSession, mart: DataFrame, path: str, col: str, months: list[dt.date] | None,
                    *order) -> None:
    """Write a mart partitioned by month: all of it, or the given months alone (an empty one is removed)."""
    # sorted by the month first, as the writer wants it, so that it keeps the order within
    fresh = mart if months is None else written(mart, "mart-months")
    mode = "static" if months is None else "dynamic"
    fresh.sortWithinPartitions(col, *order).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(
        col).parquet(path)
    if months is None:  # nothing is left of the old table; the rows aren't made again to see their months
        return
    for m in set(months) - {r[0] for r in fresh.select(col).distinct().collect()}:
        delete(spark, f"{path}/{col}={m}")


def _digest(*lookups: DataFrame) -> str:
    """What tells whether lookup tables have changed."""
    out = []
    for df in lookups:
        rows = F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))
        out.append(":".join(map(str, df.agg(F.count("*"), rows).first())))
    return " ".join(out)


def write_zone_mart(spark: SparkSession, mart: DataFrame, path: str, months: list[dt.date] | None = None) -> None:
    """a folder for each month, the busiest zone first within each written file."""
    _replace_months(spark, mart, path, "started_month", months, F.desc("total_rides"))


def _refresh_dim(spark: SparkSession, raw: DataFrame, stage: Callable[[DataFrame], DataFrame], path: str, head: int, full: bool) -> None:
    """The station dimension: anew, or the written one merged with the rides landed since."""
    done = None if full or not exists(spark, path) else incremental.read_landing(spark, path)
    if done is None:
        dim = stations.dim_stations(stage(raw))
    elif done == head:
        return
    else:
        news = stage(raw.where(F.col(manifest.LANDING) > done))
        dim = written(stations.merge_dim(spark.read.parquet(path), news), "dim-merged")
    dim.write.mode("overwrite").parquet(path)
    incremental.save_landing(spark, path, head)


def refresh(spark: SparkSession, cfg: RefreshConfig, as_of: dt.datetime | None = None) -> dict[str, DataFrame]:
    """Run one refresh; returns the ingest statuses, DQ results and DQ report."""
    statuses = trips_csv.ingest(spark, cfg.landing, f"{cfg.root}/raw", cfg.patterns)
    if cfg.size_shuffles:
        size_shuffles(spark, input_bytes(spark, f"{cfg.root}/raw"))
    raw, head = trips_csv.read_raw(spark, f"{cfg.root}/raw"), manifest.head(spark, f"{cfg.root}/raw")
    systems = sorted(cfg.patterns)

    def stage(rows: DataFrame) -> DataFrame:
        return staging.union_rides(*[staging.stage_trips(rows.where(F.col("system") == s), s, cfg.coord_type) for s in systems])

    unioned = stage(raw)

    fct_path = f"{cfg.root}/fct_rides"
    full = cfg.full_refresh or not exists(spark, fct_path)
    # What the fact changed and the marts have not followed yet; it outlives a failed run.
    pending = _Pending(spark, f"{cfg.root}/_pending.json")
    if full:
        pending.add(["all"])
        incremental.write_fact(facts.fct_rides(unioned, cfg.keys), fct_path)
        incremental.save_landing(spark, fct_path, head)
    else:
        incremental.run_landings(spark, raw, stage, fct_path, head, cfg.keys, on_touch=pending.add)
    fct = incremental.read_fact(spark, fct_path)
    months = pending.months()  # None: all of them

    _refresh_dim(spark, raw, stage, f"{cfg.root}/dim_stations", head, full)
    if months != []:
        daily = marts.agg_rides_daily(_of_months(fct, months)).withColumn("_month", F.trunc("started_date", "month"))
        _replace_months(spark, daily, f"{cfg.root}/agg_rides_daily", "_month", months)
        summary.update(spark, fct, cfg.root, months)
    if cfg.zone_layer:
        prop = T.StructType([T.StructField("zone_id", T.StringType()), T.StructField("GEOID", T.StringType())])
        layer = geojson.read_features(spark, cfg.zone_layer, prop).select("zone_id", "geometry")
        tracts = geojson.read_features(spark, cfg.tract_layer, prop).select(F.col("GEOID").alias("geoid"), "geometry")
        counts = census_src.clean(census_src.read_census(spark, cfg.census)).drop("NAME")
        dim = spark.read.parquet(f"{cfg.root}/dim_stations").where(F.col("system") == cfg.zone_system)
        zone = enriched_boundary(spark, "zone", layer, counts, tracts, dim)
        cfg = replace(cfg, boundaries=(*cfg.boundaries, zone))
    if cfg.boundaries:
        specs = [
            marts.Boundary(b.name, b.id_col, b.mapping, b.meta, b.population, (b.display_col,) if b.display_col else ())
            for b in cfg.boundaries
        ]
        # a mart whose lookups are new or have changed is built anew, the others follow the touched months
        digests = {b.name: _digest(b.station_zone, b.zone_meta, b.zone_pop) for b in specs}
        files = {n: f"{cfg.root}/agg_rides_by_{n}_lookups.txt" for n in digests}
        same = {n for n, d in digests.items() if exists(spark, files[n]) and read_text(spark, files[n]) == d}
        for part, some in (([b for b in specs if b.name not in same], None), ([b for b in specs if b.name in same], months)):
            if part and some != []:
                for name, mart in marts.zone_rollups(_of_months(fct, some), part, cfg.zone_system).items():
                    write_zone_mart(spark, mart, f"{cfg.root}/agg_rides_by_{name}", some)
                    write_text(spark, files[name], digests[name])
    pending.clear()

    frames = {
        "rides_unioned": unioned, "fct_rides": fct, "dim_stations": spark.read.parquet(f"{cfg.root}/dim_stations"),
        "agg_rides_daily": spark.read.parquet(f"{cfg.root}/agg_rides_daily"),
        **{f"stg_{s}": unioned.where(F.col("system") == s) for s in systems},
        **{f"agg_rides_by_{b.name}": spark.read.parquet(f"{cfg.root}/agg_rides_by_{b.name}") for b in cfg.boundaries},
    }
    suites = quality.declared_suites(systems, {f"agg_rides_by_{b.name}": b.id_col for b in cfg.boundaries})
    results = quality.run_suites(frames, suites)
    results = results.checkpoint()
    out = {"ingest": statuses, "dq_results": results, "dq_report": quality.report(results)}
    if as_of is not None:
        out["freshness"] = quality.freshness(raw, "system", "_ingested_at", as_of)
    return out
