"""URL filter: fixed rules first, then logistic regression on hashed character n-grams.

The model is trained on a small labelled URL table with full-batch gradient
steps, each one aggregation in Spark; weights are a vector of fixed length, so
they travel as a literal.  Everything is DataFrame expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Fixed values: (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits the url, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):  # the longest comes last
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def features(host: Column, path: Column, dim: int, sizes: tuple[int, ...] = (2, 3, 4)) -> Column:
    """Bucket numbers (from 0) of the character n-grams of host and path, end marks and repeats included."""

    def grams(part: Column, tag: str, n: int) -> Column:
        last = F.length(part) - n
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

        def bucket(i: Column) -> Column:
            return F.pmod(F.xxhash64(F.lit(f"{tag}{n}"), F.substring(part, i + 1, F.lit(n))), F.lit(dim)).cast("int")

        return F.transform(starts, bucket)

    h, p = (F.concat(F.lit("^"), x, F.lit("$")) for x in (host, path))
    return F.concat(*[grams(part, tag, n) for part, tag in ((h, "h"), (p, "p")) for n in sizes])


@dataclass
class UrlModel:
    """Weights by bucket and the bias; ``score`` is the log-odds of block."""

    weights: list[float]
    bias: float

    def score(self, found: Column) -> Column:
        # one literal that the optimizer folds to an array; a Column for each weight would be slow to build
        w = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")
        total = F.aggregate(found, F.lit(0.0), lambda acc, i: acc + F.get(w, i))
        return F.lit(self.bias) + total / F.sqrt(F.greatest(F.size(found), F.lit(1)).cast("double"))


def train(labelled: DataFrame, dim: int = 4096, max_rows: int = 20_000, steps: int = 30, rate: float = 0.5,
          decay: float = 1e-4) -> UrlModel:
    """Fit on ``labelled`` (host, path, block 0/1): distinct rows, at most ``max_rows`` of them in hash order.

    Adagrad on the full batch: each step is one grouped sum over buckets, at
    most ``dim`` numbers.  With no labelled row, or one class alone, the weights
    stay zero and the bias says which class was seen (none: allow).  Otherwise
    both classes weigh the same, whatever their sizes.
    """
    rows = labelled.select("host", "path", "block").distinct()
    rows = rows.orderBy(F.xxhash64("host", "path"), "host", "path", "block").limit(max_rows)
    found = features(F.col("host"), F.col("path"), dim)
    rows = materialise(rows.select(F.col("block").cast("double").alias("y"), found.alias("f")), "url-labelled")
    n, pos = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    model = UrlModel([0.0] * dim, math.log((pos + 0.5) / (n - pos + 0.5)) if n else -1.0)
    if not n or pos in (0, n):
        return model
    model.bias = 0.0
    weight = F.when(F.col("y") > 0, F.lit(0.5 / pos)).otherwise(F.lit(0.5 / (n - pos)))
    seen = [1e-8] * (dim + 1)
    for _ in range(steps):
        odds = F.exp(-model.score(F.col("f")))
        err = (F.lit(1.0) / (F.lit(1.0) + odds) - F.col("y")) * weight
        each = rows.select(err.alias("e"), "f")
        cells = F.explode(F.concat(F.col("f"), F.array(F.lit(dim)))).alias("i")
        size = F.sqrt(F.greatest(F.size("f"), F.lit(1)).cast("double"))
        grad = (each.select(cells, (F.col("e") / size).alias("g"), "e").groupBy("i")
                .agg(F.sum("g").alias("g"), F.sum("e").alias("e")).collect())
        for i, g, e in grad:
            step = e if i == dim else g
            if i < dim:
                step += decay * model.weights[i]
            seen[i] += step * step
            step *= rate / math.sqrt(seen[i])
            if i == dim:
                model.bias -= step
            else:
                model.weights[i] -= step
    return model


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]], model: UrlModel, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """``id_col, host, path, rule, verdict, score`` for every row of ``pages``.

    A url without ``://``, or null, has an empty host and path.  Where no rule
    fits, ``verdict`` is block if the model's log-odds are above zero.  Repeated
    rows and null ids keep their rows; other columns are ignored.
    """
    url = F.col(url_col).cast("string")
    p = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    p = p.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
    dim = len(model.weights)
    p = p.withColumn("score", model.score(features(F.col("host"), F.col("path"), dim)))
    said = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return p.select(F.col("id").alias(id_col), "host", "path", F.col("found.rule").alias("rule"),
                    F.coalesce(F.col("found.verdict"), said).alias("verdict"), "score")


def labelled_by_rules(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url") -> DataFrame:
    """The labelled URL table that the rules themselves give: host, path, block."""
    url = F.col(url_col).cast("string")
    p = pages.select(host_of(url).alias("host"), path_of(url).alias("path"))
    p = p.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules)).where(F.col("found").isNotNull())
    return p.select("host", "path", (F.col("found.verdict") == "block").cast("int").alias("block"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages; the model learns from the urls that a rule judges."""
    pages = table(spark, sf_dir, "pages")
    model = train(labelled_by_rules(pages, RULES))
    return url_filter(pages, RULES, model)
