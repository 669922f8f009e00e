"""Geometry as native Column expressions.

Representation (WGS84 degrees unless projected):
    point    struct<x: double, y: double>            x = longitude, y = latitude
    ring     array<point>, closed (last == first)
    polygon  array<ring>, first ring outer, the rest holes
    multi    array<polygon>

Everything here compiles to Catalyst expressions (``transform``,
``aggregate``, arithmetic), so it runs inside whole-stage code generation on
executors; no Python per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the WGS84 ellipsoid and the UTM projection (public standard).
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0


def utm_constants(zone: int) -> dict[str, float]:
    """Krüger-series coefficients (3rd order in n) for a northern UTM zone."""
    n = WGS84_F / (2 - WGS84_F)
    big_a = WGS84_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    return {
        "lon0": math.radians(-183 + 6 * zone),
        "c": 2 * math.sqrt(n) / (1 + n),
        "k0A": UTM_K0 * big_a,
        "a1": n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16,
        "a2": 13 * n**2 / 48 - 3 * n**3 / 5,
        "a3": 61 * n**3 / 240,
    }


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (a one-element ``transform``).

    Column builders otherwise inline a sub-expression at every reference, so a
    projected ring used by the shoelace sum would be re-projected per vertex.
    """
    return F.transform(F.array(value), fn)[0]


def point(x: Column, y: Column) -> Column:
    """L4: point struct from longitude / latitude columns."""
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _atanh(v: Column) -> Column:
    return F.log((F.lit(1.0) + v) / (F.lit(1.0) - v)) * 0.5


def _sinh(v: Column) -> Column:
    return (F.exp(v) - F.exp(-v)) * 0.5


def _cosh(v: Column) -> Column:
    return (F.exp(v) + F.exp(-v)) * 0.5


def utm(lng: Column, lat: Column, zone: int = 18) -> Column:
    """L1: EPSG:4326 -> UTM zone ``zone`` north, as struct<x: easting, y: northing> in metres."""
    k = utm_constants(zone)
    c = F.lit(k["c"])

    def en(q):
        xi, eta = q["xi"], q["eta"]
        east, north = eta, xi
        for j, a in ((1, k["a1"]), (2, k["a2"]), (3, k["a3"])):
            east = east + F.lit(a) * F.cos(xi * (2 * j)) * _sinh(eta * (2 * j))
            north = north + F.lit(a) * F.sin(xi * (2 * j)) * _cosh(eta * (2 * j))
        return F.struct(
            (F.lit(UTM_FALSE_EASTING) + F.lit(k["k0A"]) * east).alias("x"),
            (F.lit(k["k0A"]) * north).alias("y"),
        )

    def from_angles(a):
        s, dlam = a["s"], a["dlam"]
        return let(
            _sinh(_atanh(s) - c * _atanh(c * s)),
            lambda t: let(
                F.struct(
                    F.atan(t / F.cos(dlam)).alias("xi"),
                    _atanh(F.sin(dlam) / F.sqrt(F.lit(1.0) + t * t)).alias("eta"),
                ),
                en,
            ),
        )

    angles = F.struct(F.sin(F.radians(lat)).alias("s"), (F.radians(lng) - F.lit(k["lon0"])).alias("dlam"))
    return let(angles, from_angles)


def project_ring(ring: Column, zone: int = 18) -> Column:
    return F.transform(ring, lambda p: utm(p["x"], p["y"], zone))


def project_multi(multi: Column, zone: int = 18) -> Column:
    return F.transform(multi, lambda poly: F.transform(poly, lambda r: project_ring(r, zone)))


def ring_signed_area2(ring: Column) -> Column:
    """Twice the signed shoelace area of a closed ring, about its first vertex
    (a local origin keeps the cross products small in projected metres)."""
    o = ring[0]
    n = F.size(ring)
    return F.aggregate(
        F.sequence(F.lit(1), n - 1),
        F.lit(0.0),
        lambda acc, i: acc
        + (ring[i - 1]["x"] - o["x"]) * (ring[i]["y"] - o["y"])
        - (ring[i]["x"] - o["x"]) * (ring[i - 1]["y"] - o["y"]),
    )


def polygon_area(poly: Column) -> Column:
    """Outer ring minus holes (absolute ring areas)."""
    areas = F.transform(poly, lambda r: F.abs(ring_signed_area2(r)) * 0.5)
    return F.aggregate(
        F.slice(areas, 2, F.size(areas)), areas[0], lambda acc, a: acc - a
    )


def multi_area(multi: Column) -> Column:
    """L2 kernel: area of a multipolygon in the units of its coordinates squared."""
    return F.aggregate(F.transform(multi, polygon_area), F.lit(0.0), lambda acc, a: acc + a)


def area_km2(multi_wgs84: Column, zone: int = 18) -> Column:
    """L2: area in km² after projecting to UTM (rounded half-even to 4 dp, like pandas)."""
    return F.bround(let(project_multi(multi_wgs84, zone), multi_area) / F.lit(1e6), 4)


def _ring_moments(ring: Column) -> Column:
    """struct(a2, cx6a, cy6a): signed 2A and the first moments of a closed ring."""
    n = F.size(ring)

    def step(acc, i):
        p, q = ring[i - 1], ring[i]
        cross = p["x"] * q["y"] - q["x"] * p["y"]
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["cx"] + (p["x"] + q["x"]) * cross).alias("cx"),
            (acc["cy"] + (p["y"] + q["y"]) * cross).alias("cy"),
        )

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"))
    return F.aggregate(F.sequence(F.lit(1), n - 1), zero, step)


def centroid(multi: Column) -> Column:
    """L3: planar area centroid struct<x, y> of a multipolygon (holes subtract).

    Ring orientation is normalised: outer rings count positive, holes negative.
    """

    def poly_moments(poly):
        ms = F.transform(poly, _ring_moments)
        signed = F.transform(
            ms,
            lambda m, i: F.struct(
                *[
                    (m[f] * F.when(i == 0, F.signum(m["a"])).otherwise(-F.signum(m["a"]))).alias(f)
                    for f in ("a", "cx", "cy")
                ]
            ),
        )
        zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"))
        return F.aggregate(
            signed,
            zero,
            lambda acc, m: F.struct(*[(acc[f] + m[f]).alias(f) for f in ("a", "cx", "cy")]),
        )

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"))
    tot = F.aggregate(
        F.transform(multi, poly_moments),
        zero,
        lambda acc, m: F.struct(*[(acc[f] + m[f]).alias(f) for f in ("a", "cx", "cy")]),
    )
    return let(tot, lambda t: F.struct((t["cx"] / (t["a"] * 3)).alias("x"), (t["cy"] / (t["a"] * 3)).alias("y")))


def _on_segment(px: Column, py: Column, a: Column, b: Column, eps: float = 1e-12) -> Column:
    cross = (b["x"] - a["x"]) * (py - a["y"]) - (b["y"] - a["y"]) * (px - a["x"])
    within_x = (px >= F.least(a["x"], b["x"])) & (px <= F.greatest(a["x"], b["x"]))
    within_y = (py >= F.least(a["y"], b["y"])) & (py <= F.greatest(a["y"], b["y"]))
    return (F.abs(cross) <= F.lit(eps)) & within_x & within_y


def ring_crossings(px: Column, py: Column, ring: Column) -> Column:
    """Number of ring edges crossed by the ray from (px, py) towards +x (even-odd rule)."""
    n = F.size(ring)

    def step(acc, i):
        a, b = ring[i - 1], ring[i]
        straddles = (a["y"] > py) != (b["y"] > py)
        x_at = a["x"] + (py - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"])
        return acc + F.when(straddles & (px < x_at), F.lit(1)).otherwise(F.lit(0))

    return F.aggregate(F.sequence(F.lit(1), n - 1), F.lit(0), step)


def ring_touches(px: Column, py: Column, ring: Column) -> Column:
    n = F.size(ring)
    return F.aggregate(
        F.sequence(F.lit(1), n - 1),
        F.lit(False),
        lambda acc, i: acc | _on_segment(px, py, ring[i - 1], ring[i]),
    )


def crossings(p: Column, edges: Column) -> Column:
    """How many of ``edges`` (x0, y0, x1, y1) the ray from ``p`` towards +x crosses (even-odd rule)."""
    px, py = p["x"], p["y"]

    def step(acc, e):
        straddles = (e["y0"] > py) != (e["y1"] > py)
        x_at = e["x0"] + (py - e["y0"]) * (e["x1"] - e["x0"]) / (e["y1"] - e["y0"])
        return acc + F.when(straddles & (px < x_at), F.lit(1)).otherwise(F.lit(0))

    return F.aggregate(edges, F.lit(0), step)


def touches(p: Column, edges: Column) -> Column:
    """Whether ``p`` lies on one of ``edges``."""
    def ends(e):
        return ({"x": e["x0"], "y": e["y0"]}, {"x": e["x1"], "y": e["y1"]})

    return F.exists(edges, lambda e: _on_segment(p["x"], p["y"], *ends(e)))


def within(p: Column, multi: Column) -> Column:
    """Point strictly inside a multipolygon (boundary points do NOT match).

    Inside = odd total crossings over all rings of a part (holes flip parity)
    and on no edge.
    """
    px, py = p["x"], p["y"]
    inside_part = F.transform(
        multi,
        lambda poly: (
            F.aggregate(poly, F.lit(0), lambda acc, r: acc + ring_crossings(px, py, r)) % 2 == 1
        )
        & ~F.aggregate(poly, F.lit(False), lambda acc, r: acc | ring_touches(px, py, r)),
    )
    return F.exists(inside_part, lambda b: b)


def bbox(multi: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax) of a multipolygon (outer rings suffice)."""

    def of(pts):
        xs = F.transform(pts, lambda p: p["x"])
        ys = F.transform(pts, lambda p: p["y"])
        return F.struct(
            F.array_min(xs).alias("xmin"),
            F.array_min(ys).alias("ymin"),
            F.array_max(xs).alias("xmax"),
            F.array_max(ys).alias("ymax"),
        )

    return let(F.flatten(F.transform(multi, lambda poly: poly[0])), of)


def longest_ring(multi: Column) -> Column:
    """outer ring of the part with the most vertices."""
    best = F.array_max(F.transform(multi, lambda poly: F.struct(F.size(poly[0]).alias("n"), poly[0].alias("ring"))))
    return best["ring"]


def outline(multi: Column) -> Column:
    """(lats, lons) of the longest outer ring."""
    return let(
        longest_ring(multi),
        lambda r: F.struct(
            F.transform(r, lambda p: p["y"]).alias("lats"), F.transform(r, lambda p: p["x"]).alias("lons")
        ),
    )
