"""Exact nearest target by leaves of equal counts.

Targets, one for each place, are cut into leaves of as many each along a
Z-order curve, wherever they lie: an empty stretch costs nothing, and a crowd is
cut as finely as its count asks for.  Each side of a leaf's bounding box touches
a target, which bounds how far a point's nearest target can be; only leaves whose
box comes that near are searched, by an equi-join on the leaf.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

# executors need numpy and pyarrow, not an installed copy of this package
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Targets of a leaf, and leaves at most (their boxes, 32 bytes each, go to every task); beyond, leaves hold more.
LEAF, MOST_LEAVES = 32, 1 << 18
BITS = 26  # of each coordinate in the curve


def _spread(v: Column) -> Column:
    """The lower bits of a long with a zero after each (to be interleaved)."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def leaves(targets: DataFrame, size: int = LEAF) -> tuple[DataFrame, np.ndarray]:
    """``targets`` (tid, tx, ty; distinct places) with ``leaf``, and each leaf's box (xmin, ymin, xmax, ymax)."""
    x0, y0, x1, y1, n = targets.agg(F.min("tx"), F.min("ty"), F.max("tx"), F.max("ty"), F.count("*")).first()
    scale = [((1 << BITS) - 1) / (hi - lo) if hi > lo else 0.0 for lo, hi in ((x0, x1), (y0, y1))]
    grid = [F.floor((F.col(c) - lo) * s).cast("long") for c, lo, s in (("tx", x0, scale[0]), ("ty", y0, scale[1]))]
    code = _spread(grid[0]).bitwiseOR(F.shiftleft(_spread(grid[1]), 1))
    size = max(size, -(-n // MOST_LEAVES))
    order = ["code", "tx", "ty"]
    # ranges of the curve, each sorted and written by one task, and cut into leaves by position
    rows = targets.withColumn("code", code).repartitionByRange(max(1, -(-n // (size * 512))), *order).sortWithinPartitions(*order)
    rows = written(rows.withColumn("pos", F.monotonically_increasing_id()), "nearest-order")
    rows = rows.select("tid", "tx", "ty", F.shiftright("pos", 33).alias("range"),
                       F.floor(F.col("pos").bitwiseAND(F.lit((1 << 33) - 1)) / size).alias("at"))
    boxes = rows.groupBy("range", "at").agg(F.min("tx"), F.min("ty"), F.max("tx"), F.max("ty")).orderBy("range", "at").collect()
    first = {}  # a range's first leaf
    for i, b in enumerate(boxes):
        first.setdefault(b[0], i)
    numbers = F.create_map(*(F.lit(v).cast("long") for kv in first.items() for v in kv))
    rows = rows.select("tid", "tx", "ty", (F.element_at(numbers, F.col("range")) + F.col("at")).alias("leaf"))
    return rows, np.array([b[2:] for b in boxes], float)


def _near_far(x: np.ndarray, y: np.ndarray, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distance of each point to each box, and to the farthest that its nearest target there can be."""
    x, y = x[:, None], y[:, None]
    xmin, ymin, xmax, ymax = boxes.T
    near = np.maximum(np.maximum(xmin - x, x - xmax), 0) ** 2 + np.maximum(np.maximum(ymin - y, y - ymax), 0) ** 2
    # a target lies on each side: on the nearer one of two sides, at most at its farther end
    dx0, dx1, dy0, dy1 = (x - xmin) ** 2, (x - xmax) ** 2, (y - ymin) ** 2, (y - ymax) ** 2
    far = np.minimum(np.minimum(dx0, dx1) + np.maximum(dy0, dy1), np.minimum(dy0, dy1) + np.maximum(dx0, dx1))
    return near, far


def candidate_leaves(x: np.ndarray, y: np.ndarray, boxes: np.ndarray, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(point, leaf) pairs: all leaves that can hold a point's nearest target, by groups of neighbouring leaves."""
    width = max(1, math.isqrt(len(boxes)))
    starts = np.arange(0, len(boxes), width)
    groups = np.column_stack([np.minimum.reduceat(boxes[:, :2], starts), np.maximum.reduceat(boxes[:, 2:], starts)])
    points, found = [], []
    for at in range(0, len(x), step):
        px, py = x[at:at + step], y[at:at + step]
        near, far = _near_far(px, py, groups)
        bound = far.min(axis=1)
        slack = 1 + 1e-12  # of rounding
        for g in np.argsort(near.min(axis=0)):  # the nearest group bounds best
            some = np.flatnonzero(near[:, g] <= bound * slack)
            if len(some):
                mine = _near_far(px[some], py[some], boxes[starts[g]:starts[g] + width])[1]
                bound[some] = np.minimum(bound[some], mine.min(axis=1))
        for g in range(len(starts)):
            some = np.flatnonzero(near[:, g] <= bound * slack)
            if len(some):
                mine = _near_far(px[some], py[some], boxes[starts[g]:starts[g] + width])[0]
                p, leaf = np.nonzero(mine <= bound[some][:, None] * slack)
                points.append(at + some[p])
                found.append(starts[g] + leaf)
    none = np.zeros(0, np.int64)
    return (np.concatenate(points), np.concatenate(found)) if points else (none, none)


def nearest(points: DataFrame, targets: DataFrame, pid: str, tid: str, px: str = "x", py: str = "y", tx: str = "x",
            ty: str = "y", leaf: int = LEAF) -> DataFrame:
    """Exact nearest target per point in planar units, ties -> smallest target id.

    Returns (pid, tid, distance).  Targets without coordinates are none; points
    without get no row; without targets every point gets NULLs.  Targets at one
    place count once (the smallest id), so a crowd there is one candidate.
    """
    usable = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in (tx, ty)]
    base = targets.where(usable[0] & usable[1]).groupBy(F.col(tx).cast("double").alias("tx"), F.col(ty).cast("double").alias("ty"))
    base = written(base.agg(F.min(tid).alias("tid")), "nearest-targets")
    if base.isEmpty():
        return points.select(pid).withColumn(tid, F.lit(None).cast(targets.schema[tid].dataType)).withColumn(
            "distance", F.lit(None).cast("double"))
    placed, boxes = leaves(base, leaf)
    sent = points.sparkSession.sparkContext.broadcast(boxes)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (b.column(c).to_numpy(zero_copy_only=False) for c in ("px", "py"))
            at, found = candidate_leaves(x, y, sent.value)
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(at)) for c in ("pid", "px", "py")),
                                              pa.array(found, pa.int64())], ["pid", "px", "py", "leaf"])

    rows = points.select(F.col(pid).alias("pid"), F.col(px).cast("double").alias("px"), F.col(py).cast("double").alias("py"))
    rows = rows.where("px IS NOT NULL AND py IS NOT NULL AND NOT isnan(px) AND NOT isnan(py)")
    # the search is the work: a small file's points are dealt out to all cores
    rows = rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism)
    schema = T.StructType([*rows.schema, T.StructField("leaf", T.LongType())])
    # a leaf's targets as one array: what is shuffled by point is the best of each leaf, not every target
    held = placed.groupBy("leaf").agg(F.collect_list(F.struct("tx", "ty", "tid")).alias("held"))
    met = rows.mapInArrow(pairs, schema).join(held, "leaf")

    def distance(t: Column) -> Column:
        d = F.sqrt((F.col("px") - t.tx) ** 2 + (F.col("py") - t.ty) ** 2)
        return F.struct(d.alias("d"), t.tid.alias("tid"))

    # by a generator, which no optimizer rule merges into the aggregate: that sorts the best of each leaf, not whole leaves
    best = met.select("pid", F.inline(F.array(F.array_min(F.transform("held", distance)))))
    best = best.groupBy("pid").agg(F.min(F.struct("d", "tid")).alias("b"))
    return best.select(F.col("pid").alias(pid), F.col("b.tid").alias(tid), F.col("b.d").alias("distance"))
