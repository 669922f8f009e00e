"""Census API responses.

A response is a JSON array of string arrays, header first, on one line or many
(lines of arrays without the outer brackets are read too).  Splits of a file are
parsed in parallel; the header row is recognised by its first cell (``NAME``)
and its column positions are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .json_documents import elements

# Census variable codes and the suppression sentinel.
POPULATION = "B01003_001E"
HOUSEHOLDS = "B11001_001E"
MEDIAN_INCOME = "B19013_001E"
SUPPRESSED = -666666666


def _source() -> Column:
    """The response a row belongs to: its file, or the folder of part files that Spark wrote it as."""
    return F.regexp_replace(F.col("file"), r"/part-[^/]*$", "")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    rows = elements(spark, path, end="]").select(_source().alias("file"), F.from_json("text", "array<string>").alias("cells"))
    return written(rows.where(F.size("cells") > 0), "census-rows")


def read_census(spark: SparkSession, path: str) -> DataFrame:
    """Rows as named string columns, GEOID = state‖county‖tract[‖block group].

    Every file is read by its own header; a column that a file lacks is NULL.
    """
    rows = _rows(spark, path)
    is_header = F.col("cells")[0] == "NAME"
    headers = rows.where(is_header).select("file", F.col("cells").alias("names"))
    names = [r[0] for r in headers.select(F.explode("names").alias("n")).groupBy("n").agg(
        F.min("n").alias("_")).orderBy(F.col("n") != "NAME", "n").collect()]  # the census columns in use
    if not names:
        raise ValueError(f"no header row in {path}")
    body = rows.where(~F.coalesce(is_header, F.lit(False)))
    if body.isEmpty():
        raise ValueError(f"no data row in {path}")
    data = body.join(headers, "file").withColumn("row", F.map_from_arrays("names", F.transform("names", lambda n, i: F.get("cells", i))))
    out = data.select(*[F.col("row")[n].alias(n.replace(" ", "_")) for n in names])
    parts = [c for c in ("state", "county", "tract", "block_group") if c in out.columns]
    return out.withColumn("geoid", F.concat(*[F.col(c) for c in parts]))


def clean_count(c: Column) -> Column:
    """Numeric text ('12', '12.0') -> nullable bigint; else NULL."""
    return F.coalesce(c.try_cast("bigint"), F.round(c.try_cast("double")).try_cast("bigint"))


def clean_income(c: Column) -> Column:
    """Income <= 0 (the -666666666 sentinel) -> NULL."""
    v = c.try_cast("double")
    return F.when(v > 0, v)


def clean(census: DataFrame) -> DataFrame:
    return census.select(
        "geoid",
        "NAME",
        clean_count(F.col(POPULATION)).alias("population"),
        clean_count(F.col(HOUSEHOLDS)).alias("households"),
        clean_income(F.col(MEDIAN_INCOME)).alias("median_household_income"),
    )


def tract_label(tract: Column) -> Column:
    """H18: '001402' -> '14.02'."""
    return F.format_string("%.2f", tract.cast("int") / F.lit(100.0))


def labels(census: DataFrame) -> DataFrame:
    """Tract label and block-group display name ('BG n, Tract t')."""
    t = tract_label(F.col("tract"))
    bg = (
        F.concat(F.lit("BG "), F.col("block_group"), F.lit(", Tract "), t)
        if "block_group" in census.columns
        else F.lit(None).cast("string")
    )
    return census.select("geoid", t.alias("tract_label"), bg.alias("bg_name"))
