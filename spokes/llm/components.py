"""Connected components of a large link table by alternating star contractions.

Each round replaces links by links to the smallest neighbour (first of the
larger neighbours, then of the smaller ones), which shortens every path; the
number of links never grows and the rounds are logarithmic in the size of a
component.  Every round is written to the shared folder, so nothing of it is
recomputed when an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``links`` (two long columns); root is the smallest node reachable.

    Links to itself, repeated links and links with a null count for nothing.
    """
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (F.col(a) != F.col(b)).alias("two"))
    e = e.where(F.col("two") & F.col(a).isNotNull() & F.col(b).isNotNull()).select("u", "v")
    e = materialise(e, "links")
    n = e.count()  # links never become more
    e = materialise(e.distinct(), "links", n)
    while n:
        e = _small_star(_large_star(e, n), n)
        n = e.count()
        most = e.groupBy("u").count().agg(F.max("count")).first()[0]
        heads = e.select(F.col("u").alias("w")).distinct()
        if most == 1 and not e.join(heads, F.col("v") == F.col("w"), "left_semi").count():
            break  # every node has one link, to a node that has none: these are the roots
    roots = e.select("v").distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v"))


def _large_star(e: DataFrame, n: int) -> DataFrame:
    both = e.union(e.select("v", "u"))
    least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star-least", 2 * n)
    out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return materialise(out.distinct(), "star-large", n)


def _small_star(e: DataFrame, n: int) -> DataFrame:
    least = materialise(e.groupBy("u").agg(F.min("v").alias("m")), "star-least", n)
    moved = e.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return materialise(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "star-small", n)
