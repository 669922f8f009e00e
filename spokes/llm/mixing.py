"""Mixing sources to target weights: whole documents whose sizes add up to each source's budget.

Every source gets a share of the corpus's size by its weight, at most
``most`` times its own size; what it can't take goes to the others by weight.
A source's budget is filled with whole passes over it, and what then remains
with documents counted by their exact length: a first choice follows the
length distribution and leaves a window of the budget open, which
bounded-knapsack dynamic programming over the counts left fits to the word.
Of each length the documents with the smallest seeded hashes are taken.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, table, text_of

WEIGHTS, MOST, SEED = (1, 2, 3), 3, 42
# Words of a budget that the dynamic programming fits; the bulk before it leaves so much open.
WINDOW = 1 << 14
# Rows of a range of the seeded order.
RANGE_ROWS = 50_000

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def count_words(texts: pa.Array, step: int = 1 << 23) -> np.ndarray:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of each text of an Arrow string array without nulls, some ``step`` bytes at a time."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    out, at = np.zeros(len(texts), np.int64), 0
    if not len(texts) or texts.buffers()[2] is None:
        return out
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, int(offsets[at]) + step, "right")) - 1)
        ends = offsets[at:end + 1].astype(np.int64) - int(offsets[at])
        word = ~_BLANK[data[offsets[at]:offsets[end]]]
        starts = word.copy()
        starts[1:] &= ~word[:-1]
        first = ends[:-1][np.diff(ends) > 0]
        starts[first] = word[first]  # nothing comes before a text's first byte
        out[at:end] = np.diff(np.searchsorted(np.flatnonzero(starts), ends))
        at = end
    return out


def sized(docs: DataFrame, columns: list[str], id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """``doc`` (struct of ``columns``), ``source, size, key`` of every row; the key is a seeded hash of id and text."""
    texts = text_of(text_col)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("doc"),
                       F.col(f"`{source_col}`").cast("string").alias("source"), texts.alias("text"),
                       F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), texts).alias("key"))
    schema = T.StructType([rows.schema["doc"], T.StructField("source", T.StringType()), T.StructField("size", T.LongType()),
                           T.StructField("key", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = pa.array(count_words(b.column("text")), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("source"), n, b.column("key")],
                                             ["doc", "source", "size", "key"])

    return rows.mapInArrow(run, schema)


def offsets(rows: DataFrame, group: list[str]) -> DataFrame:
    """``group, part, start, before``: where each range has its first row of a group, and how many came in ranges before.

    ``pos`` of ``rows`` are the ids that ``monotonically_increasing_id`` gave the
    ranges of an order by ``group`` and more: a row's rank in its group is
    ``pos - start + before``, though a group may fill any number of ranges.
    """
    counts = rows.groupBy(*group, F.shiftright("pos", 33).alias("part")).agg(F.count("*").alias("n"), F.min("pos").alias("start"))
    w = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*group, "part", "start", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))


def ranked_sources(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank``: 0, 1, ... by code point, null last."""
    order = F.col("source").asc_nulls_last()
    n = max(1, -(-sources.count() // RANGE_ROWS))
    rows = sources.repartitionByRange(n, order).sortWithinPartitions(order)
    rows = materialise(rows.withColumn("pos", F.monotonically_increasing_id()), "mix-sources")
    rows = rows.join(offsets(rows, []).withColumnRenamed("part", "_part"), F.shiftright("pos", 33) == F.col("_part"))
    return rows.withColumn("rank", F.col("pos") - F.col("start") + F.col("before")).drop("pos", "_part", "start", "before")


def with_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most: int = MOST) -> DataFrame:
    """``source, source_size`` with ``target``: its weight times the level at which all targets make up the budget.

    A target above ``most`` times its source's size stops there, and the level
    of the others rises; one aggregation over the sources a round, until no
    further target is above.
    """
    weigh = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = materialise(ranked_sources(sources).select("source", "source_size", weigh.cast("long").alias("weight")), "mix-weights")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    budget, level, full = total * share, 0.0, -1
    cap = F.col("source_size") * most
    while True:
        above = F.col("weight") * F.lit(level) > cap
        n, spent, weight = rows.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
                                    F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if n == full or not weight:
            break
        full, level = n, max(level, (budget - spent) / weight)
    return rows.select("source", "source_size", F.least(F.col("weight") * F.lit(level), cap.cast("double")).alias("target"))


def fit(lengths: list[int], counts: list[int], budget: int, window: int = WINDOW) -> list[int]:
    """How many documents of each length to take so that their lengths add up to ``budget``, or as near as can be.

    ``lengths`` are distinct and positive.  From the longest to the shortest,
    each length gives documents for its share of the budget, but ``window`` words
    of it (or all, if it is less) stay open.  Over these, sets of the documents
    left are reached length by length, each count cut into powers of two, until
    a set fits exactly; else the nearest sum counts (of two equally near, the
    smaller).  They come in a shuffled order, since the longest first would fill
    the window with long documents.  Where only documents longer than what is open are left, the
    nearest one of them is taken if that is nearer than none.
    """
    total, taken = sum(n * c for n, c in zip(lengths, counts)), [0] * len(lengths)
    if budget <= 0 or not total:
        return taken
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bulk, due, spent = max(0, budget - window), 0, 0
    for i in order:
        due += lengths[i] * counts[i]
        n = (2 * (due * bulk // total - spent) + lengths[i]) // (2 * lengths[i])  # what is due so far, rounded
        taken[i] = max(0, min(n, counts[i], (bulk - spent) // lengths[i]))
        spent += taken[i] * lengths[i]
    for i in order:  # what rounding has left open
        n = max(0, min(counts[i] - taken[i], (bulk - spent) // lengths[i]))
        taken[i], spent = taken[i] + n, spent + n * lengths[i]
    rest = budget - spent
    if rest > 4 * window:  # all documents left are longer than rest - window: two are no nearer than one
        left = [i for i in order if counts[i] > taken[i]]
        best = min(left, key=lambda i: (abs(lengths[i] - rest), lengths[i]), default=None)
        if best is not None and abs(lengths[best] - rest) < rest:
            taken[best] += 1
        return taken
    reached = np.zeros(2 * rest + 1, bool)
    reached[0] = True
    came = np.full(len(reached), -1, np.int64)  # the item by which a sum was first reached
    items: list[tuple[int, int]] = []
    random.Random(len(order)).shuffle(order)
    for i in order:
        left, size = counts[i] - taken[i], 1
        while left and not reached[rest]:
            n = min(size, left)
            left, size, step = left - n, 2 * size, n * lengths[i]
            if step >= len(reached):
                break
            new = np.zeros(len(reached), bool)
            new[step:] = reached[:-step]
            new &= ~reached
            came[new] = len(items)
            reached |= new
            items.append((i, n))
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - rest))])
    while at:
        i, n = items[came[at]]
        taken[i] += n
        at -= n * lengths[i]
    return taken


def quotas(counts: DataFrame, targets: DataFrame, window: int = WINDOW) -> DataFrame:
    """``source, size, passes, extra``: whole passes over the source, and documents of each length taken once more.

    One source's lengths and their counts are fitted by one task: a source of S
    words has less than sqrt(2 S) different lengths.
    """
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        whole, target = int(rows["source_size"].iloc[0]), round(rows["target"].iloc[0])
        passes, budget = divmod(target, whole) if whole else (0, 0)
        rows = rows.sort_values("size")
        some = rows[rows["size"] > 0]
        taken = fit(some["size"].tolist(), some["n"].tolist(), budget, window)
        return pd.DataFrame({"source": rows["source"], "size": rows["size"], "passes": passes,
                             "extra": [0] * (len(rows) - len(some)) + taken})

    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    rows = counts.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return rows.groupBy("source").applyInPandas(run, "source string, size long, passes long, extra long")


def mix_sources(docs: DataFrame, columns: list[str] | None = None, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0,
                most: int = MOST, seed: int = SEED, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """Every row of ``docs`` with how often a mix of its sources takes it.

    Returns ``doc`` (a struct of ``columns``, all of them by default, so that
    no name can clash), ``source, size, source_size, target, copies, taken``:
    size counts the words of the text, taken is copies times size, and copies is
    at most ``most``.  ``mixed_rows`` makes the mixed corpus of it.

    Null text counts as empty, an empty one has size 0 and is taken as often as
    whole passes go over its source.  Null is a source of its own, the last.
    Rows equal in id and text tie: how many of them are taken is determined, which
    (if their other columns differ) is not.  A source without words gets 0.
    An empty table gives an empty one.
    """
    rows = sized(docs, columns or docs.columns, id_col, text_col, source_col, seed)
    rows = materialise(rows.withColumn("uid", F.monotonically_increasing_id()), "mix-rows")
    n = rows.count()
    counts = materialise(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    sources = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = materialise(with_targets(sources, weights, share, most), "mix-targets")
    quota = materialise(quotas(counts, targets, window), "mix-quotas")

    order = ["source", "size", "key", "uid"]
    ranges = rows.repartitionByRange(max(1, -(-n // RANGE_ROWS)), *order).sortWithinPartitions(*order)
    ranked = materialise(ranges.withColumn("pos", F.monotonically_increasing_id()), "mix-order")
    t = targets.withColumnRenamed("source", "_source")
    quota = quota.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("source")
    quota = quota.withColumnRenamed("size", "_size")
    here = offsets(ranked, ["source", "size"])
    here = here.join(quota, F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")))
    here = here.drop("source", "size").withColumnRenamed("part", "_part")
    out = ranked.join(here, F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
                      & (F.shiftright("pos", 33) == F.col("_part")))
    rank = F.col("pos") - F.col("start") + F.col("before")
    copies = F.col("passes") + (rank < F.col("extra")).cast("long")
    return out.select("doc", "source", "size", "source_size", "target", copies.alias("copies"),
                      (copies * F.col("size")).alias("taken"))


def mixed_rows(mix: DataFrame) -> DataFrame:
    """The mixed corpus: the rows that ``mix_sources`` was given, each as often as it takes them."""
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mix.where("copies > 0").select("doc", times.alias("copy")).select("doc.*")


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix of all sources by the weights 1, 2, 3, ... takes."""
    mix = mix_sources(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return mix.select("doc.doc_id", "size", "source_size", "target", "taken", "copies", "source")
