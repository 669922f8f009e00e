"""Zone layers, seeds and census tiles derived from the driver tables (FIXTURES.md §3).

Real deployments read GeoJSON layers and seed CSVs (see ``sources.geojson``
and ``sources.seeds``); tests and the registry build the same shapes from
``nation`` / ``region`` / ``customer`` so that zones and populations grow with
the input tables:

* 25 square cells z = n_nationkey (side 0.04°), named after the nation; cells
  with z % 7 = 3 stand aside of the grid, which leaves polygon gaps.
* Four boundary definitions over the cells: neighbourhood = cell, cluster =
  the nation's region, tract = z div 5, block group = z * 4 + q (quarters).
* Population from customers by nation (nation 23 left out).
* 4 x 4 census tiles of side 0.05 for the area-weighted overlay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from .fixtures import table

# Fixed values of the fixture grid (FIXTURES.md §3).
GRID_X0 = -77.13
GRID_Y0 = 38.79
CELL = 0.04
TILE = 0.05
GAP_RULE_MOD, GAP_RULE_REM = 7, 3
GAP_ASIDE = 4.0  # degrees
UNMAPPED_STATIONS_FROM = 95


def rect(x0: Column, y0: Column, w: float, h: float) -> Column:
    """Closed counter-clockwise rectangle ring."""
    x1, y1 = x0 + F.lit(w), y0 + F.lit(h)
    return F.array(
        geo.point(x0, y0), geo.point(x1, y0), geo.point(x1, y1), geo.point(x0, y1), geo.point(x0, y0)
    )


def _cell_x0(z: Column) -> Column:
    aside = F.when(z % GAP_RULE_MOD == GAP_RULE_REM, F.lit(GAP_ASIDE)).otherwise(F.lit(0.0))
    return F.lit(GRID_X0) + (z % 5).cast("double") * F.lit(CELL) + aside


def _cell_y0(z: Column) -> Column:
    return F.lit(GRID_Y0) + F.floor(z / 5).cast("double") * F.lit(CELL)


def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygon layer: z, name, region, geometry (multipolygon); gap cells stand aside of the grid."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    z = F.col("n_nationkey").cast("int")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        z.alias("z"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("int").alias("region_key"),
        F.col("r_name").alias("region_name"),
        F.array(F.array(rect(_cell_x0(z), _cell_y0(z), CELL, CELL))).alias("geometry"),
    )


_CELL_META: dict[tuple[str, str], DataFrame] = {}


def grid_cell_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cell_meta(grid_cells(...))``, built once per session and input folder.

    The frame is lazy; memoising it only saves re-building its (large)
    geometry expressions on the driver, not any data.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CELL_META:
        _CELL_META[key] = cell_meta(grid_cells(spark, sf_dir))
    return _CELL_META[key]


def cell_meta(cells: DataFrame) -> DataFrame:
    """z, area_km2 (UTM 18N), centroid_lat/lng (planar degrees, 6 dp)."""
    c = geo.centroid(F.col("geometry"))
    return cells.select(
        "z",
        "name",
        "region_key",
        "region_name",
        geo.area_km2(F.col("geometry")).alias("area_km2"),
        F.round(c["y"], 6).alias("centroid_lat"),
        F.round(c["x"], 6).alias("centroid_lng"),
    )


def station_cell(sid: Column) -> Column:
    """Cell that contains synthetic station ``sid`` under every jitter."""
    return F.floor(F.floor(sid / 10) / 2) + F.floor((sid % 10) / 2) * 5


# Boundary registry: id column, optional display column and the zone of (z, station).
BOUNDARIES = {
    "neighborhood": {"id_col": "neighborhood_name", "display_col": None},
    "cluster": {"id_col": "cluster_id", "display_col": "cluster_display_name"},
    "tract": {"id_col": "tract_geoid", "display_col": "tract_name"},
    "block_group": {"id_col": "bg_geoid", "display_col": "bg_name"},
}


def _tract_geoid(z: Column) -> Column:
    return F.concat(F.lit("11001"), F.lpad((F.floor(z / 5) * 100 + 100).cast("string"), 6, "0"))


def _tract_label(z: Column) -> Column:
    return F.format_string("%.2f", ((F.floor(z / 5) * 100 + 100) / F.lit(100.0)))


def zone_meta(cells_meta: DataFrame, boundary: str) -> DataFrame:
    """Seed table ``(id[, display], area_km2 decimal(18,4), centroid_lat, centroid_lng)``.

    Coarser zones sum their cells' areas and take the area-weighted centroid.
    """
    m = cells_meta
    z = F.col("z")
    if boundary == "neighborhood":
        return m.select(
            F.col("name").alias("neighborhood_name"),
            F.col("area_km2").cast("decimal(18,4)").alias("area_km2"),
            "centroid_lat",
            "centroid_lng",
        )
    if boundary == "block_group":
        q = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("q")
        return m.select("*", q).select(
            (z * 4 + F.col("q")).cast("string").alias("bg_geoid"),
            F.concat(F.lit("BG "), F.col("q").cast("string"), F.lit(", Tract "), _tract_label(z)).alias("bg_name"),
            F.bround(F.col("area_km2") / 4, 4).cast("decimal(18,4)").alias("area_km2"),
            "centroid_lat",
            "centroid_lng",
        )
    if boundary == "cluster":
        key = [F.col("region_key").cast("string").alias("cluster_id"), F.col("region_name").alias("cluster_display_name")]
    elif boundary == "tract":
        key = [_tract_geoid(z).alias("tract_geoid"), F.concat(F.lit("Tract "), _tract_label(z)).alias("tract_name")]
    else:
        raise ValueError(boundary)
    a = F.col("area_km2")
    return m.groupBy(*key).agg(
        F.bround(F.sum(a), 4).cast("decimal(18,4)").alias("area_km2"),
        F.round(F.sum(a * F.col("centroid_lat")) / F.sum(a), 6).alias("centroid_lat"),
        F.round(F.sum(a * F.col("centroid_lng")) / F.sum(a), 6).alias("centroid_lng"),
    )


def cell_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by nation: z, q, population, households, income_sum; z is NULL for nation 23, which so has none.

    Split by quarter q = c_custkey % 4 so block groups can be built from it.
    """
    cust = table(spark, sf_dir, "customer")
    z = F.nullif(F.col("c_nationkey").cast("int"), F.lit(23))
    return cust.groupBy(z.alias("z"), (F.col("c_custkey") % 4).cast("int").alias("q")).agg(
        F.count(F.lit(1)).alias("population"),
        F.sum("c_acctbal").alias("acctbal_sum"),
    )


def zone_population(spark: SparkSession, sf_dir: str, boundary: str) -> DataFrame:
    """Seed ``(id, population, households, median_household_income)``.

    population = customers, households = population div 2, income =
    round(avg(c_acctbal)) over the zone's customers.
    """
    pop = cell_population(spark, sf_dir)
    z = F.col("z")
    if boundary == "neighborhood":
        nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("z"), "n_name")
        pop = pop.join(nation, "z").withColumn("_id", F.col("n_name"))
    elif boundary == "cluster":
        nation = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").cast("int").alias("z"), F.col("n_regionkey").cast("string").alias("_id")
        )
        pop = pop.join(nation, "z")
    elif boundary == "tract":
        pop = pop.withColumn("_id", _tract_geoid(z))
    elif boundary == "block_group":
        pop = pop.withColumn("_id", (z * 4 + F.col("q")).cast("string"))
    else:
        raise ValueError(boundary)
    id_col = BOUNDARIES[boundary]["id_col"]
    n = F.sum("population")
    return pop.where(F.col("_id").isNotNull()).groupBy(F.col("_id").alias(id_col)).agg(
        n.cast("bigint").alias("population"),
        F.floor(n / 2).cast("bigint").alias("households"),
        F.round(F.sum("acctbal_sum") / n, 0).alias("median_household_income"),
    )


def station_zone_map(dim: DataFrame, spark: SparkSession, sf_dir: str, boundary: str, system: str) -> DataFrame:
    """Seed ``(station_id, zone id)`` for the stations of ``system`` in the dimension.

    Stations 95-99 have a NULL zone; the others' cell comes from the grid rule.
    """
    st = dim.where(F.col("system") == system).select("station_id").distinct()
    sid = F.col("station_id").cast("bigint")
    st = st.withColumn("z", F.when(sid < UNMAPPED_STATIONS_FROM, station_cell(sid).cast("int")))
    z = F.col("z")
    id_col = BOUNDARIES[boundary]["id_col"]
    if boundary == "neighborhood":
        nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("z"), "n_name")
        out = st.join(nation, "z", "left").select("station_id", F.col("n_name").alias(id_col))
    elif boundary == "cluster":
        nation = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").cast("int").alias("z"), F.col("n_regionkey").cast("string").alias(id_col)
        )
        out = st.join(nation, "z", "left").select("station_id", id_col)
    elif boundary == "tract":
        out = st.select("station_id", _tract_geoid(z).alias(id_col))
    elif boundary == "block_group":
        out = st.select("station_id", (z * 4 + sid % 4).cast("string").alias(id_col))
    else:
        raise ValueError(boundary)
    return out


def census_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 tiles t (4 x 4, side 0.05): geoid, geometry, population, households, income.

    population = customers with c_custkey % 16 = t; income NULL when t % 5 = 0.
    """
    cust = table(spark, sf_dir, "customer")
    agg = cust.groupBy((F.col("c_custkey") % 16).cast("int").alias("t")).agg(
        F.count(F.lit(1)).alias("population"), F.avg("c_acctbal").alias("avg_bal")
    )
    t = F.col("t")
    x0 = F.lit(GRID_X0) + (t % 4).cast("double") * F.lit(TILE)
    y0 = F.lit(GRID_Y0) + F.floor(t / 4).cast("double") * F.lit(TILE)
    return agg.select(
        F.format_string("T%02d", t).alias("tile_id"),
        F.array(F.array(rect(x0, y0, TILE, TILE))).alias("geometry"),
        F.col("population").cast("bigint").alias("population"),
        F.floor(F.col("population") / 2).cast("bigint").alias("households"),
        F.when(t % 5 != 0, F.round(F.col("avg_bal"), 0)).alias("median_household_income"),
    )


# Borough names of the tabulation-area layer (fixed values).
BOROUGHS = ["Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island"]


def tabulation_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tabulation-area attribute layer derived from ``part``.

    nta2020, ntaname (some blank), boroname, ntatype ('0' = residential) and
    the geometry type (some Point label nodes among the polygons).
    """
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    brand_no = F.regexp_extract(F.col("p_brand"), r"(\d+)$", 1).cast("int")
    boro = F.element_at(F.array(*[F.lit(b) for b in BOROUGHS]), (brand_no % 5 + 1).cast("int"))
    return part.select(
        F.concat(F.lit("NT"), F.lpad(k.cast("string"), 5, "0")).alias("nta2020"),
        F.when(k % 13 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("p_name"))).alias("ntaname"),
        boro.alias("boroname"),
        F.when(F.col("p_size") % 5 == 0, "9").when(F.col("p_size") % 7 == 0, "5").otherwise("0").alias("ntatype"),
        F.when(k % 11 == 0, "Point").otherwise("Polygon").alias("geometry_type"),
    )
