"""Seed tables: small CSV lookups with explicit column types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_seed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header CSV with quoting (values may contain commas); ids stay strings."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_seed(df: DataFrame, path: str, sort_cols: list[str]) -> None:
    """Sorted seed CSV.  Rows are range-partitioned by the sort key so the
    part files concatenate in order; no single task holds the table."""
    df.orderBy(*sort_cols).write.mode("overwrite").option("header", True).option("quoteAll", False).csv(path)
