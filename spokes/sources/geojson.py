"""GeoJSON polygon layers.

Geometry becomes ``array<array<array<struct<x, y>>>>`` (multipolygon): a
Polygon is wrapped as a one-part multipolygon.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .json_documents import elements, write_document

_POLY = "array<array<array<double>>>"
_MULTI = "array<array<array<array<double>>>>"


def _feature_schema(props: T.StructType) -> T.StructType:
    geom = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    return T.StructType(
        [T.StructField("type", T.StringType()), T.StructField("properties", props), T.StructField("geometry", geom)]
    )


def _to_points(ring: Column) -> Column:
    return F.transform(ring, lambda c: F.struct(c[0].alias("x"), c[1].alias("y")))


def geometry_column(gtype: Column, coords_json: Column) -> Column:
    poly = F.from_json(coords_json, _POLY)
    multi = F.from_json(coords_json, _MULTI)
    as_multi = F.when(gtype == "Polygon", F.array(poly)).when(gtype == "MultiPolygon", multi)
    return F.transform(as_multi, lambda p: F.transform(p, _to_points))


def read_features(spark: SparkSession, path: str, props: T.StructType, collection: bool = True) -> DataFrame:
    """FeatureCollection document(s) (``collection=True``) or GeoJSONSeq lines.

    A document is read by as many tasks as it has splits, on one line or many.
    Returns the property columns, ``geometry_type`` and ``geometry``.
    Geometries other than (Multi)Polygon get a NULL geometry.
    """
    feat = _feature_schema(props)
    if collection:
        # document { features [ feature {: the third bracket; other members may have objects as deep
        rows = elements(spark, path, depth=3, end="}").select(F.from_json("text", feat).alias("f")).where("f.type = 'Feature'")
    else:
        rows = spark.read.schema(feat).json(path).select(F.struct("*").alias("f"))
    return rows.select(
        "f.properties.*",
        F.col("f.geometry.type").alias("geometry_type"),
        geometry_column(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("geometry"),
    )


def feature_json(df: DataFrame, prop_cols: list[str], geom_col: str = "geometry") -> Column:
    coords = F.transform(
        F.col(geom_col), lambda p: F.transform(p, lambda r: F.transform(r, lambda q: F.array(q["x"], q["y"])))
    )
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(*prop_cols).alias("properties"),
            F.struct(F.lit("MultiPolygon").alias("type"), coords.alias("coordinates")).alias("geometry"),
        )
    )


def write_features(df: DataFrame, path: str, prop_cols: list[str], geom_col: str = "geometry") -> None:
    """GeoJSONSeq sink, one Feature per line, written by all tasks in parallel."""
    df.select(feature_json(df, prop_cols, geom_col).alias("value")).write.mode("overwrite").text(path)


def write_feature_collection(df: DataFrame, path: str, prop_cols: list[str], geom_col: str = "geometry") -> None:
    """One FeatureCollection document, its features written by all tasks and joined on commit."""
    rows = df.select(feature_json(df, prop_cols, geom_col).alias("value"))
    write_document(rows, path, '{"type": "FeatureCollection", "features": [\n', "]}\n")
