"""Where the fact's keys live: hash buckets of (key hash, month).

An upsert has to find the months that hold copies of its rides.  The index has
one 16-byte pair for each key and month, in folders by bucket, so a batch reads
the buckets its keys fall into, and then only the months found there.  Pairs
are added before the table changes and never taken back, so a month that held a
key once may be read for nothing, but none is missed; ``pack`` drops repeats
when many batches have been added.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fs import delete, exists, read_text, write_text
from ..session import written

# Keys of a bucket when the index is made (16 bytes each), and batches until it is packed.
BUCKET_KEYS, BATCHES = 4_000_000, 24
MONTH = "started_month"


class KeyIndex:
    """The index of one table; ``open`` makes it where there is none for these keys."""

    def __init__(self, spark: SparkSession, path: str, state: dict):
        self.spark, self.path, self.state = spark, path, state

    @classmethod
    def open(cls, spark: SparkSession, path: str, fact: DataFrame, keys: Sequence[str], bucket_keys: int = BUCKET_KEYS) -> KeyIndex:
        at = f"{path}/_keys/index.json"
        if exists(spark, at):
            index = cls(spark, path, json.loads(read_text(spark, at)))
            if index.state["keys"] == list(keys):
                return index
        # a fact has a key once: repeats, if any, are dropped by lookups and by the next packing, not by a shuffle here
        pairs = fact.select(F.xxhash64(*keys).alias("key"), MONTH)
        index = cls(spark, path, {"keys": list(keys), "buckets": 1 + fact.count() // bucket_keys, "version": 0, "batches": 0})
        index._write(pairs, 0)
        index._save()
        return index

    def _folder(self, version: int) -> str:
        return f"{self.path}/_keys/v{version}"

    def _save(self) -> None:
        write_text(self.spark, f"{self.path}/_keys/index.json", json.dumps(self.state))

    def _bucket(self):
        return F.pmod("key", F.lit(self.state["buckets"])).cast("int")

    def _write(self, pairs: DataFrame, version: int) -> None:
        rows = pairs.select("key", MONTH, self._bucket().alias("bucket"))
        rows.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(self._folder(version))

    def pairs(self) -> DataFrame:
        schema = f"key long, {MONTH} date, bucket int"
        return self.spark.read.schema(schema).parquet(self._folder(self.state["version"]))

    def hashes(self, rows: DataFrame) -> DataFrame:
        return rows.select(F.xxhash64(*self.state["keys"]).alias("key"))

    def lookup(self, rows: DataFrame) -> DataFrame:
        """The (key, month) pairs of the keys of ``rows``: the scan is pruned to their buckets."""
        wanted = written(self.hashes(rows).distinct().withColumn("bucket", self._bucket()), "key-wanted")
        buckets = [r[0] for r in wanted.select("bucket").distinct().collect()]  # at most the number of buckets
        held = self.pairs().where(F.col("bucket").isin(buckets))
        return written(held.join(wanted, ["bucket", "key"], "left_semi").select("key", MONTH).distinct(), "key-found")

    def add(self, rows: DataFrame, found: DataFrame) -> None:
        """Add the pairs of fact rows that ``found`` (their lookup) lacks; call it before the table gets the rows."""
        mine = rows.select(F.xxhash64(*self.state["keys"]).alias("key"), MONTH).distinct()
        f = found.select(F.col("key").alias("_key"), F.col(MONTH).alias("_month"))
        new = mine.join(f, (F.col("key") == F.col("_key")) & F.col(MONTH).eqNullSafe(F.col("_month")), "left_anti")
        self._write(new, self.state["version"])
        self.state["batches"] += 1
        self._save()
        if self.state["batches"] >= BATCHES:
            self.pack()

    def pack(self) -> None:
        """Write all pairs anew, once each, in few files; the old folder goes when the new one counts."""
        old = self.state["version"]
        self._write(self.pairs().select("key", MONTH).distinct(), old + 1)
        self.state |= {"version": old + 1, "batches": 0}
        self._save()
        delete(self.spark, self._folder(old))
