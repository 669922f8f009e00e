"""Quality classifier by importance resampling.

Texts are bags of hashed words and word pairs.  Two generative models are
counted over the corpus, one of target texts (a bounded sample of labelled good
rows) and one of raw texts (all rows); a text's weight is the log of the ratio
of its probabilities under the two, brought to the same length for all texts
(held-out labels are told apart far better than by the plain sum).  Sampling without replacement in proportion
to the weights is a top-k of weight plus Gumbel noise.  Labelled rows that the
models have not seen tell where good and bad weights part; k is the number of
rows above that cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, mix, table, text_of, unlike, word_hashes

BUCKETS = 1 << 16
# Weights are those of a text of so many grams.
LENGTH = 200


def grams(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket numbers of the text's words and word pairs, repeats included."""
    w = word_hashes(text.encode())
    pairs = mix(mix(w[:-1]) ^ w[1:])
    return (np.concatenate([mix(w), pairs]) % np.uint64(buckets)).astype(np.int64)


def counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Counts of the buckets over all rows: one vector of fixed length from each task, summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for x in b.column("text"):
                total += np.bincount(grams(x.as_py(), buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    each = docs.select(text_of(text_col).alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in each.groupBy("bucket").agg(F.sum("n")).collect():  # at most ``buckets`` rows
        out[bucket] = n
    return out


@dataclass
class RatioModel:
    """log p(target) - log p(raw) of each bucket, and the weight at which good and bad rows part."""

    logratio: np.ndarray
    cut: float


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, smooth: float = 5.0, id_col: str = "doc_id",
        text_col: str = "text", good: str = "quality = 1") -> RatioModel:
    """Both models and the cut, from at most ``max_rows`` labelled ids, taken in hash order.

    Half of them, by hash, give the target model (those that are ``good``), the
    other half the cut.  The raw model counts every row of ``docs``.  A bucket's
    ratio is drawn towards one as if ``smooth`` more counts of either kind had
    been seen, so that rare words say little.  Ids that are null, repeated
    labels and labels without a document do no harm; without labelled good rows
    all ratios are zero, without bad ones there is no cut and all rows pass.
    """
    flag = F.expr(f"coalesce({good}, false)").alias("_label_good")
    ids = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_label_id"), flag)
    ids = ids.groupBy("_label_id").agg(F.min("_label_good").alias("_label_good"))
    sample = materialise(ids.orderBy(F.xxhash64("_label_id"), "_label_id").limit(max_rows)
                         .withColumn("_label_fit", F.pmod(F.xxhash64("_label_id", F.lit("half")), F.lit(2)) == 0),
                         "labelled")
    labelled = docs.select(id_col, text_col).join(F.broadcast(sample), F.col(id_col) == F.col("_label_id"))  # at most max_rows ids
    target = counts(labelled.where("_label_good and _label_fit"), text_col)
    if not target.sum():
        return RatioModel(np.zeros(BUCKETS), -math.inf)
    raw = counts(docs, text_col)
    expected = raw * (target.sum() / raw.sum())
    model = RatioModel(np.log(target + smooth) - np.log(expected + smooth), -math.inf)
    held = weigh(labelled.where("not _label_fit"), model, id_col=id_col, text_col=text_col, keep=["_label_good"])
    model.cut = best_cut([tuple(r) for r in held.select("log_weight", "_label_good").collect()])
    return model


def best_cut(held: list[tuple[float, bool]]) -> float:
    """The weight that best parts good (above) from bad rows, both counting alike; the widest gap on a tie."""
    n_good = sum(g for _, g in held)
    n_bad = len(held) - n_good
    if not n_good or not n_bad:
        return -math.inf
    held = sorted(held)
    best, cut, score = (1.0, 0.0), -math.inf, 1.0  # below all rows every good one is kept, no bad one rejected
    for (w, is_good), (above, _) in zip(held, held[1:]):
        score += -1 / n_good if is_good else 1 / n_bad
        if above > w and (round(score, 9), above - w) > best:
            best, cut = (round(score, 9), above - w), (w + above) / 2
    return cut


def _log_weight(found: np.ndarray, ratio: np.ndarray) -> float:
    return LENGTH * float(ratio[found].mean()) if len(found) else 0.0


def _uniform(key: int, id_col: str, text_col: str) -> Column:
    """53 bits of a hash of id, text and key, never zero or one."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(key), id_col, text_of(text_col)), 11) + 0.5) / float(1 << 53)


def _gumbel(u: str) -> Column:
    return -F.log(-F.log(u))


def weigh(docs: DataFrame, model: RatioModel, key: int = 0, id_col: str = "doc_id",
          text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """``id, n_grams, log_weight, noise`` and the columns ``keep`` of every row.

    The noise is standard Gumbel, drawn by hash from id, text and key.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model.logratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = sent.value
        for b in batches:
            found = [grams(x.as_py()) for x in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(f) for f in found], pa.int64()),
                 pa.array([_log_weight(f, ratio) for f in found], pa.float64()),
                 b.column("u"),
                 *map(b.column, keep)], ["id", "n_grams", "log_weight", "u", *keep])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_grams", T.LongType()),
                           T.StructField("log_weight", T.DoubleType()), T.StructField("u", T.DoubleType()),
                           *(docs.schema[c] for c in keep)])
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), _uniform(key, id_col, text_col).alias("u"), *keep)
    return rows.mapInArrow(run, schema).select("id", "n_grams", "log_weight", _gumbel("u").alias("noise"), *keep)


def kth_largest(rows: DataFrame, col: str, k: int, bins: int = 4096) -> float:
    """The ``k``-th largest value of a double column, exactly, by counts in ever narrower bins."""
    lo, hi, n = rows.agg(F.min(col), F.max(col), F.count(col)).first()
    if not n or k > n:
        return -math.inf
    if k < 1:
        return math.inf
    above = 0
    while lo < hi:
        width = (hi - lo) / bins
        inside = rows.where((F.col(col) >= lo) & (F.col(col) <= hi))
        at = F.least(F.floor((F.col(col) - lo) / width), F.lit(bins - 1)) if width > 0 else F.lit(0)
        for _, n, least, most in sorted(inside.groupBy(at.alias("at")).agg(
                F.count("*"), F.min(col), F.max(col)).collect(), reverse=True):
            if above + n >= k:
                if (least, most) == (lo, hi):  # neighbouring doubles
                    return hi if above + inside.where(F.col(col) == hi).count() >= k else lo
                lo, hi = least, most
                break
            above += n
    return lo


def resample(docs: DataFrame, model: RatioModel, k: int | None = None, key: int = 0, id_col: str = "doc_id",
             text_col: str = "text", carry: list[str] = ()) -> DataFrame:
    """``id, n_grams, log_weight, sample_key, keep`` and the columns ``carry`` of every row: the top ``k`` rows by weight plus noise.

    ``k`` is the number of rows above the model's cut unless given.  Rows that
    tie with the last key are all kept, so repeated rows fare alike.  A text
    without words, or null, weighs zero.
    """
    rows, least = _sampled(docs, model, k, key, id_col, text_col, carry)
    return rows.withColumn("keep", F.col("sample_key") >= F.lit(least)).drop("noise")


def _sampled(docs: DataFrame, model: RatioModel, k: int | None, key: int, id_col: str, text_col: str,
             carry: list[str] = ()) -> tuple[DataFrame, float]:
    """Every row's weight and sampling key, and the least key that is kept."""
    rows = materialise(weigh(docs, model, key, id_col, text_col, carry), "weights")
    rows = rows.withColumn("sample_key", F.col("log_weight") + F.col("noise"))
    if k is None:
        k = rows.where(F.col("log_weight") >= F.lit(model.cut)).count()
    return rows, kth_largest(rows, "sample_key", k)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the resampling keeps; all columns stay.

    A row goes by its own text, also where others share its id or have none;
    rows equal in both fare alike.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    _, least = _sampled(docs, model, None, 0, id_col, text_col)
    if least == -math.inf:
        return docs
    # weighed again in a scan of their own: no text moves, and the key is the same function of id and text
    weight, u = unlike(docs, "_weight", "_u")
    sent = docs.sparkSession.sparkContext.broadcast(model.logratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_log_weight(grams(x.as_py() or ""), sent.value) for x in b.column(text_col).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.float64())], [*b.schema.names, weight])

    rows = docs.withColumn(u, _uniform(0, id_col, text_col))
    rows = rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField(weight, T.DoubleType())]))
    return rows.where(F.col(weight) + _gumbel(u) >= F.lit(least)).select(*(F.col(f"`{c}`") for c in docs.columns))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, sampling key and verdict of all documents."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return resample(docs, model).withColumnRenamed("id", "doc_id")
