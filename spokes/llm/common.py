"""Helpers that several operators share: shared-folder tables and word splitting."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokes.session import ensure_checkpoint_dir

# Text is cut into pieces of about this many bytes before it is split into words,
# so that one huge document does not become one huge list.
BLOCK_BYTES = 1 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str, rows: int | None = None, per_file: int = 500_000) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage with files that outlive any executor; the reread table has
    a known byte size, so the planner can choose its joins by it.  Where it is
    known that ``df`` has at most ``rows`` rows, it is dealt out to files of about
    ``per_file`` (the stage before keeps all its tasks), not written in as many
    as there are shuffle partitions.
    """
    path = scratch(df.sparkSession, name)
    if rows is not None:
        df = df.repartition(max(1, -(-rows // per_file)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unlike(df: DataFrame, *names: str) -> tuple[str, ...]:
    """The ``names``, each led by as many underscores as it takes to be no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return tuple(out)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str) -> Column:
    """The column as text; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """Cut ``data`` at ASCII white space into pieces of at least ``size`` bytes (the last may be shorter)."""
    at = 0
    while len(data) - at > size:
        end = at + size
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[at:end]
        at = end
    yield data[at:] if at else data


def word_hashes(data: bytes) -> np.ndarray:
    """XXH64 of each word ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text, in order."""
    parts = []
    for block in blocks(data):
        words = block.split()  # bytes.split() cuts at exactly these six characters
        parts.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """64-bit hashes of all runs of ``k`` words, given the words' hashes; fewer words make one shingle."""
    k = min(k, len(words))
    if not k:
        return np.zeros(0, np.uint64)
    n = len(words) - k + 1
    h = np.full(n, np.uint64((0x9E3779B97F4A7C15 * (seed + k)) % 2**64), np.uint64)
    for i in range(k):
        h = mix(h ^ words[i:i + n])
    return h
