"""The refresh chain as lazily composed DataFrames.

``trips -> rides_unioned -> fct_rides -> {dim_stations, agg_rides_daily}``.
Nothing here collects; callers either run a query on the lazy frames (Catalyst
optimises the whole chain) or ``materialize`` the marts to Parquet once and
point the KPI queries at the written tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import facts, incremental, marts, stations, staging
from ..sources import fixtures


@dataclass
class Warehouse:
    unioned: DataFrame
    fct: DataFrame
    daily: DataFrame
    _dim: DataFrame | None = None

    @property
    def dim(self) -> DataFrame:
        """Station dimension, built on first use (its size check runs a small job)."""
        if self._dim is None:
            self._dim = stations.dim_stations(self.unioned)
        return self._dim


def from_unioned(unioned: DataFrame, keys=("ride_id",)) -> Warehouse:
    return over_fact(unioned, facts.fct_rides(unioned, keys))


def over_fact(unioned: DataFrame, fct: DataFrame) -> Warehouse:
    """The warehouse of a fact that is there already."""
    return Warehouse(unioned=unioned, fct=fct, daily=marts.agg_rides_daily(fct))


def fixture_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    per_system = fixtures.staged_trips(spark, sf_dir)
    return from_unioned(staging.union_rides(*per_system.values()))


def materialize(spark: SparkSession, wh: Warehouse, root: str) -> Warehouse:
    """Write fact (partitioned by started_month), dimension and daily mart; reread them.

    Writing cuts the lineage: the KPI queries then scan Parquet with partition
    pruning on ``started_month`` and pushed filters instead of re-running the
    chain.  ``root`` must be a shared folder on a cluster.
    """
    incremental.write_fact(wh.fct, f"{root}/fct_rides")
    fct = spark.read.parquet(f"{root}/fct_rides")
    daily = marts.agg_rides_daily(fct)
    daily.write.mode("overwrite").parquet(f"{root}/agg_rides_daily")
    wh.dim.write.mode("overwrite").parquet(f"{root}/dim_stations")
    return Warehouse(
        unioned=wh.unioned,
        fct=fct.select(*wh.fct.columns),
        daily=spark.read.parquet(f"{root}/agg_rides_daily"),
        _dim=spark.read.parquet(f"{root}/dim_stations"),
    )
