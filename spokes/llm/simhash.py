"""Near duplicates by SimHash, found through an index of positional bytes.

A 64-bit fingerprint is eight (position, byte) entries.  Two fingerprints that
differ in at most ``d`` bits share at least ``8 - d`` entries, so a pair's tally
of shared entries must reach that minimum.  A list for one entry would hold one
in 256 of all fingerprints, and tallying its pairs would grow with the square of
the corpus; so the index is keyed by every choice of ``8 - d`` positions at once:
two fingerprints meet in a list exactly when their tally reaches the minimum.
Within a list only ``d`` bytes differ; those bits are verified there, and a list
gives the links of its components to their smallest member, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks, materialise, table, text_of, unlike
from .components import connected_components

SEED = 42
ONES = np.uint64(0x0101010101010101)


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits (lowest first)."""
    out = np.zeros(64, np.int64)
    h = np.pad(h, (0, -len(h) % 255)).reshape(-1, 255)  # 255 ones fit a byte
    for bit in range(8):
        lanes = ((h >> np.uint64(bit)) & ONES).sum(axis=1, dtype=np.uint64)
        out[bit::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out


def fingerprint(text: str, shingle: int = 3) -> int:
    """The unsigned fingerprint of one text; no word gives zero."""
    counts, n, tail = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for block in blocks(text.encode().lower()):  # bytes.lower() changes A-Z alone
        words = tail + block.split()
        if len(words) >= shingle:
            runs = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
            h = np.fromiter((digest(r, SEED) for r in runs), np.uint64, len(words) - shingle + 1)
            counts += _bit_counts(h)
            n += len(h)
        tail = words[len(words) - shingle + 1:] if len(words) >= shingle else words
    if not n and tail:
        counts, n = _bit_counts(np.array([digest(b" ".join(tail), SEED)], np.uint64)), 1
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, text_col: str = "text", into: str = "fp",
                 keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all unless given) and the fingerprint as a signed long in the column ``into``."""
    keep = docs.columns if keep is None else keep
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(into, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(x.as_py() or "", shingle) for x in b.column(text_col)], np.uint64)
            yield pa.RecordBatch.from_arrays([*map(b.column, keep), pa.array(fp.view(np.int64))], [*keep, into])

    return docs.mapInArrow(run, schema)


def _roots(fps: np.ndarray, bits: int) -> np.ndarray:
    """For the distinct fingerprints of one list: the smallest of each one's component."""
    fps = np.sort(fps)
    u = fps.view(np.uint64)
    label = np.arange(len(u))
    if len(u) <= 256:
        near = np.bitwise_count(u[:, None] ^ u[None, :]) <= bits
        step = lambda lab: np.where(near, lab[None, :], len(u)).min(axis=1)
    else:
        differ = int(np.bitwise_or.reduce(u ^ u[0]))
        free = [1 << i for i in range(64) if differ >> i & 1]
        partners = []
        order = np.argsort(u)
        for k in range(1, bits + 1):
            for some in combinations(free, k):
                other = u ^ np.uint64(sum(some))
                at = order[np.minimum(np.searchsorted(u, other, sorter=order), len(u) - 1)]
                hit = np.flatnonzero(u[at] == other)
                if len(hit):
                    partners.append((hit, at[hit]))

        def step(lab):
            lab = lab.copy()
            for mine, yours in partners:
                lab[mine] = np.minimum(lab[mine], lab[yours])
            return lab

    while True:
        new = np.minimum(label, step(label))
        new = new[new]
        if (new == label).all():
            return np.column_stack([fps, fps[label]])
        label = new


def links(fps: DataFrame, bits: int = 2) -> DataFrame:
    """Links ``a, b`` between fingerprints (distinct longs in ``fp``) at most ``bits`` apart.

    Not every pair: within a list each member links to the smallest one that it
    reaches there, so components stay the same and the links stay linear.
    """
    masks = []
    for spared in combinations(range(8), bits):
        mask = 2**64 - 1 - sum(0xFF << 8 * i for i in spared)
        masks.append(F.struct(F.lit(len(masks)).alias("list"),
                              F.col("fp").bitwiseAND(F.lit(mask - 2**64 * (mask >> 63))).alias("bytes")))
    lists = fps.select("fp", F.explode(F.array(*masks)).alias("k")).groupBy("k.list", "k.bytes").agg(
        F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("fps")
            at, flat = col.offsets.to_numpy(), col.values.to_numpy()
            sizes = np.diff(at)
            two = at[:-1][sizes == 2]
            x, y = flat[two], flat[two + 1]
            near = np.bitwise_count((x ^ y).view(np.uint64)) <= bits
            out = [np.column_stack([x[near], y[near]])]
            out += [_roots(flat[at[i]:at[i + 1]], bits) for i in np.flatnonzero(sizes > 2)]
            out = np.concatenate(out)
            out = out[out[:, 0] != out[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])

    return lists.mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, shingle: int = 3, bits: int = 2, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id_col, fp, component_id`` for every row: fingerprint (signed) and smallest id reachable.

    Null and empty texts have fingerprint zero and are linked like any other.
    Repeated rows keep their rows; a null id is never the smallest one (a group
    of nothing else has a null component).  Other columns are ignored.
    """
    if not 0 <= bits <= 3:
        raise ValueError("bits: 0 to 3")
    rows, of = _groups(docs, shingle, bits, id_col, text_col)
    return rows.join(of, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def _groups(docs: DataFrame, shingle: int, bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows ``id, fp``; and for each fingerprint ``fp, component_id, first`` (the smallest (id, fp) of its group)."""
    if not 0 <= bits <= 3:
        raise ValueError("bits: 0 to 3")
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = materialise(fingerprints(rows, shingle, keep=["id"]), "simhash")
    n = rows.count()
    nodes = materialise(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes", n)
    # a fingerprint makes up to 56 rows of the index, so few of them to a task
    comp = connected_components(links(nodes.repartition(max(1, -(-n // 20_000))), bits))
    rooted = nodes.join(comp, F.col("fp") == F.col("node"), "left")
    rooted = materialise(rooted.select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-roots", n)
    first = F.min(F.struct(F.col("least").isNull().alias("none"), F.col("least").alias("id"), "fp"))
    groups = materialise(rooted.groupBy("root").agg(first.alias("first")), "simhash-first", n)
    of = rooted.join(groups, "root").select("fp", F.col("first.id").alias("component_id"), "first")
    return rows, materialise(of, "simhash-of", n)


def simhash_dedup(docs: DataFrame, shingle: int = 3, bits: int = 2, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each group of near duplicates: the one with the smallest id.

    All columns stay.  Null ids come last.  Where rows share an id, or have
    none, the smallest fingerprint among them decides; of rows that are equal in
    both, the one whose columns (but for maps) have the smallest hash stays.
    """
    rows, of = _groups(docs, shingle, bits, id_col, text_col)
    keep_id, keep_fp, several_id, into = unlike(docs, "_keep_id", "_keep_fp", "_several_id", "_keep_fp_of")
    keep = of.where("fp = first.fp").select(F.col("component_id").alias(keep_id), F.col("fp").alias(keep_fp))
    several = rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id is null")
    several = materialise(several.select(F.col("id").alias(several_id)), "simhash-several")
    mine = F.col(id_col)
    once = keep.join(several, F.col(keep_id).eqNullSafe(F.col(several_id)), "left_anti")
    one = docs.join(once, mine == F.col(keep_id), "left_semi")
    some = fingerprints(docs.join(several, mine.eqNullSafe(F.col(several_id)), "left_semi"), shingle, text_col, into)
    hashed = F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()))
    some = some.groupBy(id_col, into).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), hashed).alias("row"))
    some = some.select("row.*", F.col(into).alias(into))
    same = mine.eqNullSafe(F.col(keep_id)) & (F.col(into) == F.col(keep_fp))
    return one.unionByName(some.join(keep, same, "left_semi").drop(into))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of all documents: 3-word shingles, 2 bits."""
    g = simhash_groups(table(spark, sf_dir, "documents"), shingle=3, bits=2)
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
