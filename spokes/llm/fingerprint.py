"""Threshold-scaled sketches: every shingle hash below a fixed fraction of all hashes.

The sketch of a union is the union of sketches, and the share of one text's
sketch that another's holds estimates containment whatever their lengths.  A
text whose shingles all lie above the threshold keeps its smallest hash, so that
no sketch of a text with words is empty; that rule survives merging too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shingle_hashes, table, text_of, word_hashes

WORDS, FRACTION = 5, 1 / 4


def sketch(text: str, words: int = WORDS, fraction: float = FRACTION) -> np.ndarray:
    """Sorted distinct hashes kept of the text's ``words``-word shingles (a shorter text is one shingle)."""
    h = shingle_hashes(word_hashes(text.encode()), words)
    low = np.unique(h[h < np.uint64(int(fraction * 2**64))])
    return low if len(low) or not len(h) else h.min(keepdims=True)


def merge(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The sketch of two texts' shingles together."""
    both = np.union1d(a, b)
    low = both[both < np.uint64(int(fraction * 2**64))]
    return low if len(low) else both[:1]


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of ``a``'s shingles that ``b`` has; an empty ``a`` is contained in anything."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common shingles among all of both; two empty sketches are alike."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common) if len(a) or len(b) else 1.0


def to_hex(s: np.ndarray) -> str:
    return s.astype(">u8").tobytes().hex()


def from_hex(s: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(s), ">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, words: int = WORDS, fraction: float = FRACTION, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id_col, n_chars, fingerprint`` of every row; the fingerprint is its sketch, 16 hex digits a hash.

    Null text counts as empty, whose fingerprint is the empty string.  Repeated
    rows and null ids keep their rows; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(map(len, texts), pa.int64()),
                 pa.array([to_hex(sketch(t, words, fraction)) for t in texts], pa.string())],
                [id_col, "n_chars", "fingerprint"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_chars", T.LongType()),
                           T.StructField("fingerprint", T.StringType())])
    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, schema)


def ranged(rows: DataFrame, size: int, most: int = 20_000) -> DataFrame:
    """``id, text, part, guest``: ranges of the (long) id of about ``size`` rows each, at most ``most`` of them.

    The first row of each range comes once more as the ``guest`` that closes
    the range before it; the very first one closes the last range.  The driver
    sees the ranges' bounds and first ids only.
    """
    n = rows.count()
    parts = max(1, min(-(-n // size), most))
    shares = [i / parts for i in range(1, parts)]
    cuts = sorted({int(c) for c in rows.approxQuantile("id", shares, 0.1 / parts)}) if shares else []
    bounds = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))))

    def halve(lo, step):  # how many of the bounds the id reaches
        at = lo + step
        return F.when((at <= len(cuts)) & (F.get(bounds, at - 1) <= F.col("id")), at).otherwise(lo)

    part = F.when(F.col("id").isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), halve)) if cuts else F.lit(0)
    rows = rows.withColumn("part", part.cast("int")).withColumn("h", F.xxhash64("text"))
    first = F.min(F.struct(F.col("id").isNotNull().alias("named"), "id", "h"))
    firsts = sorted((r.part, r.f.id, r.f.h) for r in rows.groupBy("part").agg(first.alias("f")).collect())
    closing = [(i, h, firsts[k - 1][0]) for k, (_, i, h) in enumerate(firsts)]
    closing = rows.sparkSession.createDataFrame(closing, "gid long, gh long, host int")
    same = F.col("id").eqNullSafe(F.col("gid")) & (F.col("h") == F.col("gh"))
    guests = rows.join(F.broadcast(closing), same)  # a row for each range
    guests = guests.groupBy(F.col("host").alias("part")).agg(*(F.first(c).alias(c) for c in ("id", "text", "h")))
    cols = ["id", "text", "part", "h"]
    return rows.select(*cols, F.lit(False).alias("guest")).union(guests.select(*cols, F.lit(True)))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by the first as many (or all) of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def with_next(docs: DataFrame, words: int = WORDS, fraction: float = FRACTION, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Fingerprints of every row's text and edited text, and how like they are to it and to the next row's.

    Rows follow each other by ascending id (long), nulls first, then by a hash
    of the text; after the last comes the first.  Null text counts as empty;
    repeated rows keep their rows; other columns are ignored.  ``near_*`` are
    resemblances, ``part_of_*`` containments of the text's shingles.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    rows = ranged(rows, size=2000)
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
             "part_of_edited", "part_of_next"]

    def judge(i: int | None, text: str, mine: np.ndarray, following: str, theirs: np.ndarray) -> tuple:
        after = edited(text, following)
        changed = sketch(after, words, fraction)
        return (i, len(text), hashlib.sha256(after.encode()).hexdigest(), to_hex(mine), to_hex(changed),
                resemblance(mine, changed), resemblance(mine, theirs), containment(mine, changed),
                containment(mine, theirs))

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            out = []
            for i, x, guest in zip(b.column("id").to_pylist(), b.column("text"), b.column("guest").to_pylist()):
                text = x.as_py()
                now = (i, text, sketch(text, words, fraction))
                if held:
                    out.append(judge(*held, *now[1:]))
                held = None if guest else now
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    schema = T._parse_datatype_string(f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, "
                                      "edited_fingerprint string, near_edited double, near_next double, "
                                      "part_of_edited double, part_of_next double")
    ordered = rows.repartition("part").sortWithinPartitions("part", "guest", "id", "h")
    return ordered.select("id", "text", "guest").mapInArrow(run, schema)


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, their edited texts and their likeness to these and to the next document."""
    return with_next(table(spark, sf_dir, "documents"))
