"""Polygon overlay: intersection areas of two layers.

A polygon is the signed sum of what lies under its edges, so the area two
polygons share is the signed sum of what lies under an edge of either.  Small
polygons go to each grid cell they meet, edges and all.  A pair meets in the one
cell that has the lower left corner of what their boxes share and is summed up
there, so what is shuffled are the layers, not the pairs.

Polygons with many edges, and those whose id comes twice, are paired by id
first: a polygon is also the signed sum of the fan triangles of its rings, and a
pair of triangles with overlapping boxes is clipped.  Layers are made and paired
by DataFrame operators; the areas of all pairs of a batch are one numpy
computation.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import written

# executors need numpy and pyarrow, not an installed copy of this package
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

CORNERS = [f"{c}{i}" for i in range(3) for c in "xy"]
# Pairs of triangles that are clipped at once, and pairs of edges that are summed up at once.
CHUNK, EDGE_CHUNK = 1 << 15, 1 << 13
# Edges of a polygon that goes whole to its cells, and numbers that it may send to all of them.
EDGES, SENT = 64, 1 << 20
# Polygons of a layer that meet in one block of a cell.
BLOCK = 2048


def _open(ring: Column) -> Column:
    n = F.size(ring)
    closed = (n > 1) & (F.try_element_at(ring, F.lit(1)) == F.try_element_at(ring, F.lit(-1)))
    return F.when(closed, F.slice(ring, 1, n - 1)).otherwise(ring)


def _cross(o: Column, a: Column, b: Column) -> Column:
    return (a.x - o.x) * (b.y - o.y) - (a.y - o.y) * (b.x - o.x)


def outline(geom: Column) -> Column:
    """``edges`` (x0, y0, x1, y1 of one after the other) and ``area`` of a polygon, read as in ``triangles``.

    An edge runs to the right if the polygon lies under it, else to the left;
    upright edges have nothing under them and are left out.
    """
    rings = F.flatten(F.transform(geom, lambda part: F.transform(part, lambda r, i: F.struct(_open(r).alias("ring"), (i > 0).alias("hole")))))
    rings = F.filter(rings, lambda r: F.size(r.ring) >= 3)

    def turned(r: Column) -> Column:
        steps = F.sequence(F.lit(1), F.size(r.ring) - 2)
        turn = F.aggregate(steps, F.lit(0.0), lambda s, i: s + _cross(F.get(r.ring, F.lit(0)), F.get(r.ring, i), F.get(r.ring, i + 1)))
        return F.struct(r.ring.alias("ring"), r.hole.alias("hole"), turn.alias("turn"))

    def edges(r: Column) -> Column:
        def edge(i: Column) -> Column:
            p, q = F.get(r.ring, i), F.get(r.ring, (i + 1) % F.size(r.ring))
            back = (r.turn > 0) != r.hole
            return F.when(back, F.array(q.x, q.y, p.x, p.y)).otherwise(F.array(p.x, p.y, q.x, q.y))

        return F.filter(F.transform(F.sequence(F.lit(0), F.size(r.ring) - 1), edge), lambda e: (e[0] != e[2]) & (r.turn != 0))

    def both(rs: Column) -> Column:
        area = F.aggregate(rs, F.lit(0.0), lambda s, r: s + F.when(r.hole, -F.abs(r.turn)).otherwise(F.abs(r.turn)) / 2)
        return F.struct(F.flatten(F.flatten(F.transform(rs, edges))).alias("edges"), area.alias("area"))

    return geo.let(F.transform(rings, turned), both)


def triangles(polys: DataFrame, id_col: str, geom_col: str = "geometry") -> DataFrame:
    """``id, sign, x0, y0, x1, y1, x2, y2``: counter-clockwise fan triangles whose signed areas add up to each polygon's.

    A ring may be closed (its last vertex equals the first one exactly) or
    open, and turn either way; rings after a part's first one are holes.
    Triangles without area and rings of fewer than three vertices give no row.
    """
    rings = polys.select(F.col(id_col).alias("id"), F.explode(geom_col).alias("part"))
    rings = rings.select("id", F.posexplode("part").alias("hole", "ring"))
    rings = rings.select("id", "hole", _open(F.col("ring")).alias("ring")).where(F.size("ring") >= 3)

    def triangle(i: Column) -> Column:
        o, a, b = (F.get("ring", k) for k in (F.lit(0), i, i + 1))
        return F.struct(o.x.alias("ox"), o.y.alias("oy"), a.x.alias("ax"), a.y.alias("ay"), b.x.alias("bx"), b.y.alias("by"),
                        _cross(o, a, b).alias("cross"))

    fans = rings.select("id", "hole", F.transform(F.sequence(F.lit(1), F.size("ring") - 2), triangle).alias("fan"))
    turn = F.aggregate("fan", F.lit(0.0), lambda s, t: s + t.cross)
    fans = fans.select("id", F.when(F.col("hole") > 0, -F.signum(turn)).otherwise(F.signum(turn)).alias("ring_sign"), F.explode("fan").alias("t"))
    left = F.col("t.cross") > 0  # else the last two corners change places
    corner = {"x0": F.col("t.ox"), "y0": F.col("t.oy")}
    for c in "xy":
        corner[f"{c}1"] = F.when(left, F.col(f"t.a{c}")).otherwise(F.col(f"t.b{c}"))
        corner[f"{c}2"] = F.when(left, F.col(f"t.b{c}")).otherwise(F.col(f"t.a{c}"))
    return fans.where("t.cross <> 0").select("id", (F.signum("t.cross") * F.col("ring_sign")).alias("sign"),
                                            *(corner[c].alias(c) for c in CORNERS))


def shared_areas(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Areas of the intersections of counter-clockwise triangles, pair by pair: (m, 3, 2) and (m, 3, 2).

    Each pair's triangle of ``a`` is cut by the three half-planes of ``b``'s: a
    vertex inside stays, a side that crosses gives a vertex; what is left has at
    most six vertices and is kept in the first places of its row.
    """
    m = len(a)
    origin = a[:, :1]
    pts, clip = a - origin, b - origin
    have = np.full(m, 3)
    rows = np.arange(m)[:, None]
    for k in range(3):
        p, q = clip[:, k], clip[:, (k + 1) % 3]
        d = q - p
        width = pts.shape[1]
        at = np.arange(width)
        valid = at < have[:, None]
        nxt = pts[rows, np.where(at + 1 < have[:, None], at + 1, 0)]

        def side(v: np.ndarray) -> np.ndarray:
            return d[:, None, 0] * (v[..., 1] - p[:, None, 1]) - d[:, None, 1] * (v[..., 0] - p[:, None, 0])

        s0, s1 = side(pts), side(nxt)
        inside, cross = valid & (s0 >= 0), valid & ((s0 >= 0) != (s1 >= 0))
        gap = np.where(cross, s0 - s1, 1.0)
        cut = pts + (s0 / gap)[..., None] * (nxt - pts)
        out = np.stack([pts, cut], axis=2).reshape(m, 2 * width, 2)
        keep = np.stack([inside, cross], axis=2).reshape(m, 2 * width)
        have = keep.sum(axis=1)
        order = np.argsort(~keep, axis=1, kind="stable")[:, :max(1, int(have.max(initial=0)))]
        pts = out[rows, order]
    at = np.arange(pts.shape[1])
    pts = np.where((at < have[:, None])[..., None], pts, pts[:, :1])  # a repeated vertex adds nothing
    x, y = pts[..., 0], pts[..., 1]
    area = 0.5 * np.abs((x * np.roll(y, -1, axis=1) - y * np.roll(x, -1, axis=1)).sum(axis=1))
    return np.where(have >= 3, area, 0.0)


def _clip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for r in batches:
        a, b = (np.column_stack([r.column(f"{t}_{c}").to_numpy() for c in CORNERS]).reshape(-1, 3, 2) for t in "ab")
        areas = [shared_areas(a[i:i + CHUNK], b[i:i + CHUNK]) for i in range(0, len(a), CHUNK)]
        sign = r.column("a_sign").to_numpy() * r.column("b_sign").to_numpy()
        total = np.concatenate(areas) * sign if areas else np.zeros(0)
        yield pa.RecordBatch.from_arrays([r.column("a_id"), r.column("b_id"), pa.array(total)], ["a_id", "b_id", "area"])


def under_both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums over the pairs of edges, row by row, of the area that lies under both: (m, i, 4) and (m, j, 4).

    Under means down to y = 0, with a minus below it and for an edge that runs
    to the left; an edge without extent counts for nothing.
    """
    def lines(e: np.ndarray) -> tuple[np.ndarray, ...]:
        x0, y0, x1, y1 = np.moveaxis(e, -1, 0)
        run = x1 - x0
        slope = (y1 - y0) / np.where(run == 0, 1.0, run)
        right = run > 0
        return np.where(right, x0, x1), np.where(right, x1, x0), np.where(right, y0, y1), slope, np.sign(run)

    la, ra, ya, ka, sa = (v[:, :, None] for v in lines(a))
    lb, rb, yb, kb, sb = (v[:, None, :] for v in lines(b))
    left, right = np.maximum(la, lb), np.minimum(ra, rb)
    width = np.maximum(right - left, 0.0)
    b0, b1 = yb + (left - lb) * kb, yb + (right - lb) * kb
    d0, d1 = ya + (left - la) * ka - b0, ya + (right - la) * ka - b1
    # b's line, less where a's is lower: from one end to the other, or to where they cross
    lower, apart = np.minimum(d0, 0.0) + np.minimum(d1, 0.0), np.abs(d0) + np.abs(d1)
    height = b0 + b1 - lower * lower / np.where(apart == 0, 1.0, apart)
    return (np.where(width > 0, 0.5 * width * height, 0.0) * (sa * sb)).sum(axis=(1, 2))


def _edges(col: pa.ListArray, rows: np.ndarray, width: int) -> np.ndarray:
    """(rows, width, 4): edges of some rows, filled up with ones without extent."""
    start, end = (col.offsets.to_numpy()[i][rows, None] for i in (slice(None, -1), slice(1, None)))
    at = start + np.arange(4 * width)
    return np.where(at < end, col.values.to_numpy()[np.minimum(at, end - 1)], 0.0).reshape(-1, width, 4)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for r in batches:
        if not r.num_rows:
            continue
        origin = np.column_stack([r.column(c).to_numpy() for c in ("x0", "y0")] * 2)[:, None, :]
        a, b = r.column("a_edges"), r.column("b_edges")
        # rows of like size together, sizes by powers of two
        size = [1 << np.ceil(np.log2(np.diff(col.offsets.to_numpy()) / 4)).astype(int) for col in (a, b)]
        shape, total = size[0] * (1 << 16) + size[1], np.zeros(r.num_rows)
        for s in np.unique(shape):
            i, j = int(s) >> 16, int(s) & 0xFFFF
            same = np.flatnonzero(shape == s)
            for rows in np.split(same, range(step := max(1, EDGE_CHUNK // (i * j)), len(same), step)):
                total[rows] = under_both(_edges(a, rows, i) - origin[rows], _edges(b, rows, j) - origin[rows])
        yield pa.RecordBatch.from_arrays([*(r.column(c) for c in ("a_id", "b_id")), pa.array(total), *(r.column(c) for c in ("a_area", "b_area"))],
                                         ["a_id", "b_id", "area", "a_area", "b_area"])


def _area(tris: DataFrame, tag: str) -> DataFrame:
    c = {k: F.col(k) for k in CORNERS}
    twice = (c["x1"] - c["x0"]) * (c["y2"] - c["y0"]) - (c["y1"] - c["y0"]) * (c["x2"] - c["x0"])
    return tris.groupBy(F.col("id").alias(f"{tag}_id")).agg(F.sum(F.col("sign") * twice / 2).alias(f"{tag}_area"))


def _by_cells(a: DataFrame, b: DataFrame, unit: float) -> DataFrame:
    """``a_id, b_id, area, a_area, b_area`` of layers whose polygons are small; ids come once.

    The work of a cell grows with the product of its polygons, so a full one is
    dealt out by blocks of either layer, and a small layer isn't broadcast to
    the few tasks that read the other one.
    """
    from .spatial import polygon_cells

    cell, near = ["_cx", "_cy"], {}
    for tag, layer in (("a", a), ("b", b)):
        cells = polygon_cells(layer, "geom", unit)
        near[tag] = cells.select(*(F.col(c).alias(f"{tag}_{c}") for c in ("id", "edges", "area")),
                                 *(F.col(f"box.{c}").alias(f"{tag}_{c}") for c in ("xmin", "xmax", "ymin", "ymax")), *cell)
    counts = [near[t].groupBy(*cell).agg(F.count(F.lit(1)).alias(f"{t}_n")) for t in "ab"]
    counts = written(counts[0].join(counts[1], cell), "overlay-cells")
    for tag, other in ("ab", "ba"):
        blocks = {t: F.ceil(F.col(f"{t}_n") / BLOCK) for t in "ab"}
        rows = near[tag].join(counts, cell).withColumns({
            f"_{tag}": F.pmod(F.xxhash64(f"{tag}_id"), blocks[tag]), f"_{other}": F.explode(F.sequence(F.lit(0).cast("long"), blocks[other] - 1))})
        near[tag] = rows.drop("a_n", "b_n")
    low = {ax: F.greatest(f"a_{ax}min", f"b_{ax}min") for ax in "xy"}
    met = near["a"].hint("merge").join(near["b"], [*cell, "_a", "_b"])
    for ax in "xy":  # boxes that only touch share no area
        met = met.where((low[ax] < F.least(f"a_{ax}max", f"b_{ax}max")) & (F.floor(low[ax] / unit) == F.col(f"_c{ax}")))
    met = met.select("a_id", "b_id", "a_edges", "b_edges", "a_area", "b_area", low["x"].alias("x0"), low["y"].alias("y0"))
    return met.mapInArrow(_meet, "a_id string, b_id string, area double, a_area double, b_area double")


def _by_triangles(a: DataFrame, b: DataFrame, pairs: DataFrame) -> DataFrame:
    """``a_id, b_id, area, a_area, b_area`` of the polygons of ``pairs`` (a_id, b_id), each pair once."""
    tris, areas = {}, {}
    for tag, layer in (("a", a), ("b", b)):
        t = written(triangles(layer, "id", "geom"), f"overlay-{tag}-triangles")
        areas[tag] = _area(t, tag)
        box = [f(*(F.col(c) for c in CORNERS if c[0] == ax)).alias(f"{tag}_{ax}_{n}") for ax in "xy" for n, f in (("min", F.least), ("max", F.greatest))]
        tris[tag] = t.select(F.col("id").alias(f"{tag}_id"), F.col("sign").alias(f"{tag}_sign"),
                             *(F.col(c).alias(f"{tag}_{c}") for c in CORNERS), *box)
    apart = [F.col(f"{s}_{ax}_min") > F.col(f"{t}_{ax}_max") for ax in "xy" for s, t in ("ab", "ba")]
    met = pairs.join(tris["a"], "a_id").join(tris["b"], (pairs["b_id"] == tris["b"]["b_id"]) & ~(apart[0] | apart[1] | apart[2] | apart[3]))
    met = met.select(pairs["a_id"], pairs["b_id"], "a_sign", "b_sign", *(f"{t}_{c}" for t in "ab" for c in CORNERS))
    shared = met.mapInArrow(_clip, "a_id string, b_id string, area double").groupBy("a_id", "b_id").agg(F.sum("area").alias("area"))
    return shared.join(areas["a"], "a_id").join(areas["b"], "b_id")


def polygon_overlay(a: DataFrame, b: DataFrame, a_id: str, b_id: str, geom_col: str = "geometry", project_utm: int | None = 18,
                    cell: float = 0.05, rel_tol: float = 1e-12) -> DataFrame:
    """Pairwise intersections of two polygon layers with their areas.

    Output (a_id, b_id, area, b_area, weight = area / b_area), pairs with a
    positive intersection only.  Candidate pairs come from an equi-join of the
    layers' covering cells.  Both (projected) layers are written once.
    ``project_utm=None`` keeps planar input units.
    """
    from .spatial import polygon_cells

    unit = cell if project_utm is None else cell * 111_000.0  # in the units of the (projected) layer
    layers, large = {}, {}
    for tag, layer, name in (("a", a, a_id), ("b", b, b_id)):
        g = F.col(geom_col) if project_utm is None else geo.project_multi(F.col(geom_col), project_utm)
        layer = layer.select(F.col(name).cast("string").alias("id"), g.alias("geom")).where("id IS NOT NULL")
        layer = layer.select("*", outline(F.col("geom")).alias("o"), geo.bbox(F.col("geom")).alias("box"))
        layers[tag] = layer = written(layer.select("id", "geom", "box", "o.edges", "o.area"), f"overlay-{tag}")
        cells = (F.floor(F.col("box.xmax") / unit) - F.floor(F.col("box.xmin") / unit) + 1.0) * (
            F.floor(F.col("box.ymax") / unit) - F.floor(F.col("box.ymin") / unit) + 1.0)
        small = (F.size("edges") <= 4 * EDGES) & (F.size("edges") * cells <= SENT) & (F.col("area") > 0) & (F.col("area") < float("inf"))
        ids = layer.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(small, F.lit(False))).alias("small"))
        large[tag] = written(ids.where("n > 1 OR NOT small").select("id"), f"overlay-{tag}-large")

    def some(tag: str, how: str) -> DataFrame:
        return layers[tag].join(large[tag], "id", how)

    empty = {tag: large[tag].isEmpty() for tag in "ab"}
    rest = {tag: layers[tag] if empty[tag] else some(tag, "left_anti") for tag in "ab"}
    out = _by_cells(rest["a"], rest["b"], unit)
    if not (empty["a"] and empty["b"]):
        def near(tag: str, layer: DataFrame) -> DataFrame:
            return polygon_cells(layer.select("id", "geom"), "geom", unit).select(F.col("id").alias(f"{tag}_id"), "_cx", "_cy")

        pairs = near("a", some("a", "left_semi")).join(near("b", layers["b"]), ["_cx", "_cy"]).unionByName(
            near("a", rest["a"]).join(near("b", some("b", "left_semi")), ["_cx", "_cy"]))
        out = out.unionByName(_by_triangles(layers["a"], layers["b"], pairs.select("a_id", "b_id").distinct()).select(*out.columns))
    # signed sums leave rounding dust where two outlines only touch: dust is relative to the two areas
    out = out.where(F.col("area") > F.lit(rel_tol) * F.least("a_area", "b_area"))
    return out.select(F.col("a_id").alias(a_id), F.col("b_id").alias(b_id), "area", "b_area",
                      (F.col("area") / F.col("b_area")).alias("weight"))
