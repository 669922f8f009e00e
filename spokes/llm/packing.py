"""Best-fit packing by the sum-of-squares rule.

Documents are encoded once and cut into pieces; pieces are dealt by hash into
shards of a bounded size, and each shard is packed on its own: every piece goes
where the squared counts of open sequences per residual gap add up to the least
afterwards.  A shard can end with some sequences open, so shards are large
enough that these are few against all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokenizer
from .common import materialise, table, text_of

SHARD_PIECES = 50_000


def pieces(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``id, piece, start, length, ids_crc32``: the documents' ids, ``end_id`` at the end, in pieces of ``size``.

    Only a longer document is cut; its first piece takes the remainder.
    """
    kind, version, blob = tokenizer.read_file(tokenizer_path)
    sent = docs.sparkSession.sparkContext.broadcast(blob)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokenizer.encoder(kind, version, sent.value)
        for b in batches:
            row, out = [], []
            for r, x in enumerate(b.column("text")):
                ids = np.append(enc.ids(x.as_py()).astype("<u4"), np.array([end_id], "<u4"))
                cuts = list(range(len(ids), 0, -size))[::-1]
                for i, (s, e) in enumerate(zip([0, *cuts], cuts)):
                    row.append(r)
                    out.append((i, s, e - s, zlib.crc32(ids[s:e].tobytes())))
            n, s, length, crc = np.array(out, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(row, pa.int64())), pa.array(n.astype(np.int32)), pa.array(s),
                 pa.array(length), pa.array(crc)], ["id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) of each length, placed one after the other.

    Placing a length ``s`` into a gap ``g`` takes one from the count at ``g`` and
    adds one at ``g - s`` (a full sequence isn't counted); the least change of
    the sum of squares wins, the smaller gap on a tie.  A new sequence is opened
    only where no open one has room, which packs descending lengths best.
    """
    count = np.zeros(size + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    seq, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    far, opened = np.iinfo(np.int64).max, 0
    for i, s in enumerate(lengths.tolist()):
        gap = count[s:]  # by gap, from s on
        cost = 2 * (count[:size + 1 - s] - gap)
        cost[0] = -2 * gap[0] - 1  # it fills the sequence: nothing is added
        cost[gap == 0] = far
        cost[-1] = far - 1  # a new sequence
        g = s + int(cost.argmin())
        if g == size:
            seq[i] = opened
            opened += 1
        else:
            count[g] -= 1
            seq[i] = stacks[g].pop()
        offset[i] = size - g
        if g > s:
            count[g - s] += 1
            stacks[g - s].append(int(seq[i]))
    return seq, offset


def pack(parts: DataFrame, size: int = 1024) -> DataFrame:
    """``parts`` (id, piece, start, length, ...) with ``sequence_id`` and ``offset``; longest pieces first."""
    # the written number deals equal pieces (repeated rows, null ids) over all shards
    numbered = materialise(parts.withColumn("shard", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-numbered.count() // SHARD_PIECES))
    keyed = numbered.withColumn("shard", F.pmod(F.xxhash64("id", "piece", "ids_crc32", "shard"), F.lit(shards)))
    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "id", "piece"], ascending=[False, True, True], kind="stable")
        seq, offset = sum_of_squares(pdf["length"].to_numpy(), size)
        pdf["sequence_id"], pdf["offset"] = seq * shards + int(key[0]), offset
        return pdf.drop(columns="shard")

    return keyed.groupBy("shard").applyInPandas(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id_col, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every row.

    Null and empty texts make one piece of the end id.  Repeated rows are packed
    each for itself; null ids stay null; other columns are ignored.
    """
    packed = pack(pieces(docs, tokenizer_path, size, end_id, id_col, text_col), size)
    return packed.withColumnRenamed("id", id_col)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
