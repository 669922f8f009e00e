"""Token counts through a digest cache.

Each text is known by the SHA-256 of its normalised content (null becomes the
empty text; nothing else may change, since every byte bears on the count) and
each tokenizer by the digest of its file.  Stored counts are joined by both
digests; only one row per missing digest is encoded, and its count is appended
to the cache table, so a later run over a grown corpus encodes new texts alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokes.fs import exists

from . import tokenizer
from .common import materialise, scratch, table, text_of

CACHE_SCHEMA = "digest binary, n_tokens long, version string"


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    Null text counts as empty (0 bytes, 0 tokens).  Null ids and repeated rows
    keep their rows, one result each.  Other columns of ``docs`` are ignored, so
    their names can't clash.  An empty table gives an empty result.
    ``cache_path`` is a folder in storage that all executors share; it is made
    on first use.
    """
    spark = docs.sparkSession
    kind, version, blob = tokenizer.read_file(tokenizer_path)
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    texts = texts.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    rows = materialise(texts.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes")),
                       "token-digests")
    present = rows.groupBy("digest").agg(F.min("id").alias("id"))
    misses = present
    if exists(spark, cache_path):
        misses = present.join(_cached(spark, cache_path, version), "digest", "left_anti")
    misses = materialise(misses, "token-misses")

    # With a warm cache the few rows to encode are listed, and the planner may broadcast the
    # list.  With a cold one the rows to leave are; every text moves once then, at any size.
    same = (F.col("t.digest") == F.col("l.digest")) & F.col("t.id").eqNullSafe(F.col("l.id"))
    n_rows, n_misses = rows.count(), misses.count()
    if n_misses:
        if 2 * n_misses <= n_rows:
            todo = texts.alias("t").join(misses.alias("l"), same, "left_semi")
        else:
            rest = rows.select("digest", "id").alias("t").join(misses.alias("l"), same, "left_anti")
            todo = texts.alias("t").join(materialise(rest, "token-rest").hint("merge").alias("l"), same, "left_anti")
        new = _encode(todo.select("digest", "text"), kind, version, blob)
        # a repeated row can bring its digest twice
        new = new.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
        new.withColumn("version", F.lit(version)).write.mode("append").parquet(cache_path)

    if exists(spark, cache_path):
        counts = _cached(spark, cache_path, version).join(present.select("digest"), "digest", "left_semi")
    else:
        counts = spark.createDataFrame([], "digest binary, n_tokens long")
    # two writers may have stored a digest at the same time
    counts = materialise(counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "token-known")
    return rows.join(counts, "digest", "left").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _cached(spark: SparkSession, path: str, version: str) -> DataFrame:
    stored = spark.read.schema(CACHE_SCHEMA).parquet(path)
    return stored.where(F.col("version") == version).select("digest", "n_tokens")


def _encode(todo: DataFrame, kind: str, version: str, blob: bytes) -> DataFrame:
    sent = todo.sparkSession.sparkContext.broadcast(blob)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokenizer.encoder(kind, version, sent.value)
        for b in batches:
            n = [len(enc.ids(x.as_py())) for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    return todo.mapInArrow(run, "digest binary, n_tokens long")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents; every call starts with a cache of its own."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        scratch(spark, "token-cache"))
