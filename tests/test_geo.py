import json
import math
import re

import pytest
from pyspark.sql import functions as F

from spokes.functions import geo
from spokes.operators import spatial

SQUARE = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]]
HOLE = [[1.0, 1.0], [1.0, 3.0], [3.0, 3.0], [3.0, 1.0], [1.0, 1.0]]


def _layer(spark, polys):
    rows = [(zid, [[[{"x": x, "y": y} for x, y in ring] for ring in poly] for poly in multi]) for zid, multi in polys]
    return spark.createDataFrame(rows, "zone string, geometry array<array<array<struct<x:double,y:double>>>>")


def test_area_centroid_with_hole_and_multipolygon(spark):
    layer = _layer(spark, [("sq", [SQUARE]), ("holed", [SQUARE[:1] + [HOLE]]),
                           ("multi", [SQUARE, [[[10.0, 0.0], [12.0, 0.0], [12.0, 2.0], [10.0, 2.0], [10.0, 0.0]]]])])
    out = {r["zone"]: r for r in layer.select("zone", geo.multi_area(F.col("geometry")).alias("a"),
                                               geo.centroid(F.col("geometry")).alias("c")).collect()}
    assert out["sq"]["a"] == 16.0 and out["holed"]["a"] == 12.0 and out["multi"]["a"] == 20.0
    assert out["holed"]["c"]["x"] == pytest.approx(2.0) and out["multi"]["c"]["x"] == pytest.approx((2 * 16 + 11 * 4) / 20)


def test_point_in_polygon_boundary_and_hole(spark):
    layer = _layer(spark, [("holed", [SQUARE[:1] + [HOLE]])])
    pts = spark.createDataFrame([("in", 0.5, 0.5), ("hole", 2.0, 2.0), ("edge", 4.0, 2.0), ("corner", 0.0, 0.0),
                                 ("out", 5.0, 5.0), ("hole_edge", 1.0, 2.0)], "station_id string, lng double, lat double")
    got = {r["station_id"]: r["zone"] for r in spatial.points_in_polygons(pts, layer, how="left", cell=1.0).collect()}
    assert got == {"in": "holed", "hole": None, "edge": None, "corner": None, "out": None, "hole_edge": None}


def test_nearest_exact_and_ties_by_id(spark):
    targets = spark.createDataFrame([("b", 0.0, 10.0), ("a", 0.0, -10.0), ("c", 100.0, 100.0)], "tid string, x double, y double")
    pts = spark.createDataFrame([("p", 0.0, 0.0), ("q", 99.0, 99.0), ("far", 1000.0, 1000.0)], "pid string, x double, y double")
    got = {r["pid"]: r["tid"] for r in spatial.nearest(pts, targets, "pid", "tid").collect()}
    assert got == {"p": "a", "q": "c", "far": "c"}


def test_overlay_exact_l_shape(spark):
    l_shape = [[[0.0, 0.0], [2.0, 0.0], [2.0, 1.0], [1.0, 1.0], [1.0, 2.0], [0.0, 2.0], [0.0, 0.0]]]
    square = [[[0.5, 0.5], [1.5, 0.5], [1.5, 1.5], [0.5, 1.5], [0.5, 0.5]]]
    a, b = _layer(spark, [("L", [l_shape])]), _layer(spark, [("S", [square])]).withColumnRenamed("zone", "tile")
    r = spatial.polygon_overlay(a, b, "zone", "tile", project_utm=None, cell=1.0).first()
    assert r["area"] == pytest.approx(0.75) and r["weight"] == pytest.approx(0.75)


def test_utm_known_point(spark):
    # Washington, DC area point; UTM 18N easting/northing from the published series.
    r = spark.range(1).select(geo.utm(F.lit(-77.0365), F.lit(38.8977)).alias("p")).first()["p"]
    assert r["x"] == pytest.approx(323_394, abs=5) and r["y"] == pytest.approx(4_307_396, abs=5)
    assert math.isfinite(r["x"])


def test_geojson_featurecollection(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    from spokes.sources import geojson

    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"zone": "A"}, "geometry": {"type": "Polygon", "coordinates": SQUARE}},
        {"type": "Feature", "properties": {"zone": "B"}, "geometry": {"type": "Polygon", "coordinates": SQUARE[:1] + [HOLE]}},
        {"type": "Feature", "properties": {"zone": "C"},
         "geometry": {"type": "MultiPolygon", "coordinates": [SQUARE, [[[10, 0], [12, 0], [12, 2], [10, 2], [10, 0]]]]}},
        {"type": "Feature", "properties": {"zone": "P"}, "geometry": {"type": "Point", "coordinates": [1, 1]}},
    ]}
    p = tmp_path / "zones.geojson"
    p.write_text(json.dumps(doc))
    f = geojson.read_features(spark, str(p), _parse_datatype_string("zone string"))
    areas = {r["zone"]: r["a"] for r in f.select("zone", geo.multi_area(F.col("geometry")).alias("a")).collect()}
    assert areas == {"A": 16.0, "B": 12.0, "C": 20.0, "P": None}


def test_census_parsing_and_cleaning(spark, tmp_path):
    from spokes.sources import census

    lines = ['[["NAME","B01003_001E","B11001_001E","B19013_001E","state","county","tract"],',
             '["Tract 14.02","1200","500","-666666666","11","001","001402"],',
             '["Tract 1","n/a","10","52000","11","001","000100"]]']
    p = tmp_path / "acs.json"
    p.write_text("\n".join(lines))
    rows = {r["geoid"]: r for r in census.clean(census.read_census(spark, str(p))).collect()}
    assert rows["11001001402"]["median_household_income"] is None and rows["11001001402"]["population"] == 1200
    assert rows["11001000100"]["population"] is None and rows["11001000100"]["median_household_income"] == 52000.0
    labels = {r["geoid"]: r["tract_label"] for r in census.labels(census.read_census(spark, str(p))).collect()}
    assert labels["11001001402"] == "14.02"


def test_area_weighted_income_denominator_options(spark):
    ov = spark.createDataFrame([("Z", "t1", 0.5), ("Z", "t2", 1.0)], "zone string, tile_id string, weight double")
    src = spark.createDataFrame([("t1", 100, 40, None), ("t2", 100, 40, 50000.0)],
                                "tile_id string, population bigint, households bigint, median_household_income double")
    biased = spatial.area_weighted_population(ov, src, "zone", "tile_id").first()
    fixed = spatial.area_weighted_population(ov, src, "zone", "tile_id", corrected_income=True).first()
    assert biased["population"] == 150 and biased["households"] == 60
    assert biased["median_household_income"] == round(50000 * 100 / 150)
    assert fixed["median_household_income"] == 50000.0


def test_utm_overlay_matches_planar_within_distortion(spark):
    from conftest import SF_SMALL
    from spokes.plans import registry

    utm = {(r["zone"], r["tile_id"]): r["weight"] for r in registry.REGISTRY["polygon_overlay_utm"](spark, SF_SMALL).collect()}
    planar = {(r["zone"], r["tile_id"]): r["weight"] for r in registry.REGISTRY["polygon_overlay"](spark, SF_SMALL).collect()}
    assert set(utm) == set(planar) and len(utm) > 0
    assert max(abs(utm[k] - planar[k]) for k in utm) < 2e-3


def test_open_rings_keep_their_last_vertex(spark):
    """A last vertex near the first one (as seen from UTM coordinates) is a vertex, an equal one closes the ring."""
    x, y = 500_000.0, 4_300_000.0
    whole = [[x, y], [x + 80, y], [x + 80, y + 80], [x + 3, y + 80], [x, y + 40]]
    a = _layer(spark, [("open", [[whole]]), ("closed", [[whole + whole[:1]]]), ("clockwise", [[whole[::-1]]])])
    b = _layer(spark, [("all", [[[[x - 10, y - 10], [x + 100, y - 10], [x + 100, y + 100], [x - 10, y + 100]]]])]).withColumnRenamed("zone", "tile")
    got = {r.zone: r.area for r in spatial.polygon_overlay(a, b, "zone", "tile", project_utm=None, cell=1000.0).collect()}
    want = 80 * 80 - 3 * 40 / 2
    assert got == {k: pytest.approx(want, rel=1e-9) for k in ("open", "closed", "clockwise")}


def test_shared_areas_of_triangles():
    """The batched clipping against areas counted pair by pair."""
    import numpy as np

    from spokes.operators.overlay import shared_areas

    rng = np.random.default_rng(0)
    t = rng.uniform(0, 4, (400, 2, 3, 2))
    t[::7, 1] = t[::7, 0]  # the same triangle
    t[::11, 1, :, 0] += 10  # apart
    turn = (
        (t[:, :, 1, 0] - t[:, :, 0, 0]) * (t[:, :, 2, 1] - t[:, :, 0, 1]) - (t[:, :, 1, 1] - t[:, :, 0, 1]) * (t[:, :, 2, 0] - t[:, :, 0, 0]))
    t[turn < 0] = t[turn < 0][:, ::-1]
    got = shared_areas(t[:, 0], t[:, 1])
    own = np.abs(turn) / 2
    assert np.allclose(got[::7], own[::7, 0] * (np.arange(0, 400, 7) % 11 != 0)) and not got[::11].any()
    grid = np.stack(np.meshgrid(*[np.arange(0.01, 4, 0.02)] * 2), axis=-1).reshape(-1, 2)

    def inside(tri):
        out = np.ones(len(grid), bool)
        for k in range(3):
            p, q = tri[k], tri[(k + 1) % 3]
            out &= (q[0] - p[0]) * (grid[:, 1] - p[1]) - (q[1] - p[1]) * (grid[:, 0] - p[0]) >= 0
        return out

    for i in range(60):
        assert got[i] == pytest.approx((inside(t[i, 0]) & inside(t[i, 1])).sum() * 4e-4, abs=0.08)


def test_nearest_by_leaves_equals_all_pairs(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    targets = np.concatenate([rng.uniform(0, 100, (300, 2)), np.full((200, 2), 50.0), 50 + rng.normal(0, 1e-4, (300, 2)), [[-1e8, 3e7]]])
    points = np.concatenate([rng.uniform(-50, 150, (400, 2)), 50 + rng.normal(0, 1e-3, (200, 2)), [[-1e8, 0.0], [50.0, 50.0]]])
    t = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(targets)] + [(-1, None, 1.0), (-2, 1.0, float("nan"))],
                              "tid long, x double, y double")
    p = spark.createDataFrame([(i, *map(float, q)) for i, q in enumerate(points)] + [(-1, None, 0.0)], "pid long, x double, y double")
    for leaf in (1, 4, 32):
        got = {r.pid: (r.tid, r.distance) for r in spatial.nearest(p, t, "pid", "tid", leaf=leaf).collect()}
        d = np.sqrt(((points[:, None] - targets[None]) ** 2).sum(axis=2))
        assert got == {i: (int(d[i].argmin()), float(d[i].min())) for i in range(len(points))}
    assert {r.tid for r in spatial.nearest(p, t.limit(0), "pid", "tid").collect()} == {None}


def test_covering_equals_ray_casts_over_whole_outlines(spark):
    import random

    from spokes.functions import geo

    rng = random.Random(11)
    star = lambda cx, cy, n, r: [[cx + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * k / n),
                                  cy + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * k / n)] for k in range(n)]
    close = lambda ring: ring + ring[:1]
    layer = _layer(spark, [(f"s{i}", [[close(star(rng.uniform(0, 9), rng.uniform(0, 9), n, 3))] for _ in range(2)])
                           for i, n in enumerate((3, 5, 40, 400))] + [("holed", [SQUARE[:1] + [HOLE]]), ("flat", [SQUARE[:1]])])
    pts = [(i, rng.uniform(-2, 12), rng.uniform(-2, 12)) for i in range(400)]
    pts += [(1000 + 100 * x + y, x / 2, y / 2) for x in range(12) for y in range(12)]  # corners, edges and cell borders
    points = spark.createDataFrame(pts, "station_id long, lng double, lat double")
    whole = points.crossJoin(layer).where(geo.within(geo.point(F.col("lng"), F.col("lat")), F.col("geometry")))
    want = sorted((r.station_id, r.zone) for r in whole.collect())
    for cell in (0.1, 0.5, 1.0, 7.0):
        hit = spatial.points_in_polygons(points, layer, cell=cell)
        assert sorted((r.station_id, r.zone) for r in hit.collect()) == want
        read = re.findall(r"ReadSchema: struct<(.*)", hit._jdf.queryExecution().executedPlan().toString())
        assert read and not any("geometry" in r for r in read)  # no outline in the point join
    left = spatial.points_in_polygons(points, layer, how="left", cell=0.5)
    assert left.where("zone IS NOT NULL").count() == len(want) and left.select("station_id").distinct().count() == len(pts)


def test_points_in_a_long_outline_see_a_cells_edges_only(spark):
    """A comb of 400 teeth: the right customers, and a few edges for each cell, however long the outline is."""
    from spokes.operators import spatial

    n = 400
    ring = [(float(i), float(i % 2)) for i in range(n)] + [(float(n - 1 - i), 8.0 + i % 3) for i in range(n)]
    hole = [(10.0, 3.0), (20.0, 3.5), (20.0, 6.0), (10.0, 5.0)]
    polys = spark.createDataFrame([(1, [[ring, hole]])], "zone int, geometry array<array<array<struct<x:double,y:double>>>>")
    points = [(k, (k * 37 % 4040) / 10 - 2, (k * 101 % 130) / 10 - 1) for k in range(2000)]

    def inside(x, y):
        met = 0
        for r in (ring, hole):
            for (x0, y0), (x1, y1) in zip(r, r[1:] + r[:1]):
                met += (y0 > y) != (y1 > y) and x < x0 + (y - y0) * (x1 - x0) / (y1 - y0)
                if abs((x1 - x0) * (y - y0) - (y1 - y0) * (x - x0)) <= 1e-12 and min(x0, x1) <= x <= max(x0, x1) and min(y0, y1) <= y <= max(y0, y1):
                    return False
        return met % 2 == 1

    df = spark.createDataFrame(points, "k int, lng double, lat double")
    got = [r[0] for r in spatial.points_in_polygons(df, polys, cell=2.0).select("k").collect()]
    assert sorted(got) == [k for k, x, y in points if inside(x, y)]
    numbered = polys.withColumn("_poly", F.lit(0).cast("long"))
    _, met = spatial.covering(numbered, "geometry", 2.0)
    sizes = [len(part["edges"]) for r in met.collect() for part in r["_parts"]]
    assert max(sizes) <= 6


def test_overlay_shuffles_layers_not_pairs(spark, monkeypatch):
    """Small polygons meet in one cell each pair, in blocks; ids that repeat and large outlines go the long way, with the same areas."""
    import random

    from spokes.operators import overlay

    rng = random.Random(7)

    def layer(n, tag, size):
        def box(x, y, w, h, k):
            ring = [[x, y], [x + w, y], [x + w - 0.5, y + h], [x, y + h]][::1 if k % 2 else -1]
            return ring + ring[:1] if k % 3 else ring

        at = [(rng.uniform(-30, 30), rng.uniform(-30, 30), k) for k in range(n)]
        return [(f"{tag}{k}", [[box(x, y, size, size - 1, k), box(x + 1, y + 1, 1, 1, k // 2)]]) for x, y, k in at]

    a, b = (_layer(spark, layer(40, tag, size)) for tag, size in (("a", 8), ("b", 15)))
    b = b.withColumnRenamed("zone", "tile")

    def run(a):
        frame = spatial.polygon_overlay(a, b, "zone", "tile", project_utm=None, cell=10.0)
        return frame, {(r.zone, r.tile): (r.area, r.b_area, r.weight) for r in frame.collect()}

    with monkeypatch.context() as m:
        m.setattr(overlay, "_by_triangles", None)
        m.setattr(overlay, "BLOCK", 3)  # several blocks to a cell
        frame, got = run(a)
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("MapInArrow") < plan.index("Join") and "Aggregate" not in plan[:plan.index("MapInArrow")]
    with monkeypatch.context() as m:
        m.setattr(overlay, "EDGES", -1)
        want = run(a)[1]
    assert len(got) > 50 and got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    twice = run(a.unionByName(a.where("zone = 'a1'")))[1]
    assert twice == {k: pytest.approx((v[0] * 2, v[1], v[2] * 2) if k[0] == "a1" else v, rel=1e-9) for k, v in want.items()}
