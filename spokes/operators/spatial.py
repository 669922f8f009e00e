"""Spatial joins as Spark equi-joins on grid cells.

* Point-in-polygon: polygons are covered by grid cells, those within them and
  those that an edge passes; points get their own cell; an equi-join on the cell
  finds the containing zones, with a ray over a cell's edges where one passes.
* Nearest centroid: ``nearest``, by leaves of equal counts instead of a cross join.
* Overlay: ``overlay``, by pairs of triangles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..session import written
from .dedup import latest_by_key
from .nearest import nearest
from .overlay import polygon_overlay  # noqa: F401  part of this module's interface


def _cells_of_bbox(bbox: Column, cell: float) -> Column:
    def cells(bb):
        xs = F.sequence(F.floor(bb["xmin"] / cell), F.floor(bb["xmax"] / cell))
        ys = F.sequence(F.floor(bb["ymin"] / cell), F.floor(bb["ymax"] / cell))
        return F.flatten(
            F.transform(xs, lambda cx: F.transform(ys, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy"))))
        )

    return geo.let(bbox, cells)


def polygon_cells(polys: DataFrame, geom_col: str = "geometry", cell: float = 0.01) -> DataFrame:
    """One row per (polygon, covering grid cell)."""
    return polys.select("*", F.explode(_cells_of_bbox(geo.bbox(F.col(geom_col)), cell)).alias("_cell")).select(
        "*", F.col("_cell.cx").alias("_cx"), F.col("_cell.cy").alias("_cy")
    ).drop("_cell")


def covering(polys: DataFrame, geom_col: str, cell: float) -> tuple[DataFrame, DataFrame]:
    """Grid cells of polygons (``_poly``), and what a ray meets from within a cell that an edge passes.

    First ``_poly, _cx, _cy, _inside``: cells that an edge passes (not inside)
    and those wholly within a part; then ``_poly, _cx, _cy, _parts``: for every
    part that passes it, the cell's own ``edges``, and what counts the edges
    right of it (of a row of cells, they start in a later column): a ray crosses
    one whose ends lie on either side of it, so the count's parity is that of
    their upper ends.  Two edges that meet right of the cell have such an end in
    common; left are ends beyond the row (``odd``) and the ``ends`` of which
    only one edge starts right of the cell.  So a point sees neither the outline
    nor a row of it.
    """
    parts = polys.select("_poly", F.posexplode(geom_col).alias("_part", "rings"))
    rings = parts.select("_poly", "_part", F.explode("rings").alias("r")).where(F.size("r") >= 3)
    n = F.size("r")

    def at(i):
        return F.get("r", i)

    # each edge with the edge after it; the last one closes the ring
    steps = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        at(i).x.alias("x0"), at(i).y.alias("y0"), at((i + 1) % n).x.alias("x1"), at((i + 1) % n).y.alias("y1"),
        at((i + 2) % n).x.alias("x2"), at((i + 2) % n).y.alias("y2")))
    first = F.floor(F.array_min(F.transform("r", lambda p: p.x)) / cell)
    steps = rings.select("_poly", "_part", first.alias("_first"), F.explode(steps).alias("s"))

    def edge(a, b):
        return {k: F.col(f"s.{k[0]}{a if k[1] == '0' else b}") for k in ("x0", "y0", "x1", "y1")}

    def columns(e, cy):
        """The first and the last column that the edge passes in the row ``cy``; NULL if it has no such place."""
        low, high = F.least(e["y0"], e["y1"]), F.greatest(e["y0"], e["y1"])

        def x_at(y):  # where the edge is at the height y, within its own ends
            x = e["x0"] + (y - e["y0"]) * (e["x1"] - e["x0"]) / F.nullif(e["y1"] - e["y0"], F.lit(0.0))
            return F.greatest(F.least(e["x0"], e["x1"]), F.least(F.greatest(e["x0"], e["x1"]), x))

        ends = [x_at(F.greatest(low, cy * cell)), x_at(F.least(high, (cy + 1) * cell))]
        flat = e["y0"] == e["y1"]
        left = F.when(flat, F.least(e["x0"], e["x1"])).otherwise(F.least(*ends)) / cell - 1e-9
        right = F.when(flat, F.greatest(e["x0"], e["x1"])).otherwise(F.greatest(*ends)) / cell + 1e-9
        known = e["x0"].isNotNull() & e["y0"].isNotNull() & e["x1"].isNotNull() & e["y1"].isNotNull()
        return F.when(known, F.floor(left)), F.when(known, F.floor(right))

    e = edge(0, 1)
    cy = F.col("_cy")
    edges = steps.where(" AND ".join(f"s.{c} IS NOT NULL" for c in ("x0", "y0", "x1", "y1")))
    rows = F.sequence(F.floor(F.least(e["y0"], e["y1"]) / cell), F.floor(F.greatest(e["y0"], e["y1"]) / cell))
    edges = edges.select("_poly", "_part", "s", F.explode(rows).alias("_cy"))
    a, b = columns(e, cy)
    beyond = sum((F.floor(e[k] / cell) > cy).cast("int") for k in ("y0", "y1"))
    edges = edges.select("_poly", "_part", "_cy", F.struct(*(v.alias(k) for k, v in e.items())).alias("e"), a.alias("_a"), b.alias("_b"),
                         beyond.alias("_beyond"))
    edges = written(edges, "polygon-edges")
    key = ["_poly", "_part", "_cy", "_cx"]
    own = edges.select(*key[:3], F.explode(F.sequence("_a", "_b")).alias("_cx"), "e")
    own = own.groupBy(*key).agg(F.collect_list("e").alias("edges"))

    # the ends of an edge and the next one within their row, in the columns between those where the two start
    turn = steps.where("s.x1 IS NOT NULL AND s.y1 IS NOT NULL").withColumn("_cy", F.floor(F.col("s.y1") / cell))
    (before, _), (after, _) = columns(edge(0, 1), cy), columns(edge(1, 2), cy)
    turn = turn.select(*key[:3], F.col("s.y1").alias("y"), "_first", before.alias("u"), after.alias("v"))
    turn = turn.select(*key[:3], "y", F.least(F.coalesce("u", "_first"), F.coalesce("v", "_first")).alias("lo"), F.greatest("u", "v").alias("hi"))
    turn = turn.where("lo < hi").select(*key[:3], F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)).alias("_cx"), "y")
    loose = turn.groupBy(*key).agg(F.collect_list("y").alias("ends"))

    # the number of ends above the row, of the edges that start right of a cell; a run of cells without an edge is alike
    start = edges.groupBy(*key[:3], F.col("_a").alias("_cx")).agg(F.sum("_beyond").alias("_beyond"))
    line = own.join(start, key, "left").join(loose, key, "left")
    row = Window.partitionBy(*key[:3]).orderBy(F.desc("_cx"))
    right = F.coalesce(F.sum("_beyond").over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    line = line.select(*key, "edges", "ends", (right % 2 == 1).alias("odd"), F.lag("_cx").over(row).alias("_next"))
    line = written(line, "polygon-border")
    inner = line.where("odd AND _next > _cx + 1").select("_poly", F.explode(F.sequence(F.col("_cx") + 1, F.col("_next") - 1)).alias("_cx"), "_cy")
    cells = line.select("_poly", "_cx", "_cy", F.lit(False).alias("_inside")).unionByName(inner.withColumn("_inside", F.lit(True)))
    cells = cells.groupBy("_poly", "_cx", "_cy").agg(F.max("_inside").alias("_inside"))
    part = F.struct("edges", F.coalesce("ends", F.array().cast("array<double>")).alias("ends"), "odd")
    return cells, line.groupBy("_poly", "_cx", "_cy").agg(F.collect_list(part).alias("_parts"))


def points_in_polygons(
    points: DataFrame,
    polys: DataFrame,
    x: str = "lng",
    y: str = "lat",
    geom_col: str = "geometry",
    how: str = "inner",
    cell: float = 0.01,
) -> DataFrame:
    """``points`` joined to the polygons that strictly contain them.

    ``how="left"`` keeps unmatched points with NULL polygon columns.  Points
    meet the polygons' cells; in a cell that lies within, that is all.  In one
    that an edge passes, a ray is cast over the edges of that cell; outlines are
    in no join.  Sizes decide whether a join is broadcast.
    """
    polys = polys.withColumn("_poly", F.monotonically_increasing_id())
    numbered = written(polys, "polygons")
    cells, rows = (written(df, "polygon-cover") for df in covering(numbered, geom_col, cell))
    names = [c for c in numbered.columns if c not in ("_poly", geom_col)]
    pts = points.withColumns({"_px": F.floor(F.col(x) / cell), "_py": F.floor(F.col(y) / cell)})
    if how != "inner":
        pts = written(pts.withColumn("_point", F.monotonically_increasing_id()), "points")
    near = pts.join(cells, (pts["_px"] == cells["_cx"]) & (pts["_py"] == cells["_cy"]))
    whole = near.where("_inside").drop("_cx", "_cy", "_inside")
    cast = near.where("NOT _inside").drop("_inside").join(rows, ["_poly", "_cx", "_cy"])
    p = geo.point(F.col(x), F.col(y))

    def within(part):
        above = F.size(F.filter(part.ends, lambda end: end > F.col(y)))
        met = geo.crossings(p, part.edges) + above + part.odd.cast("int")
        return (met % 2 == 1) & ~geo.touches(p, part.edges)

    cast = cast.where(F.exists("_parts", within)).drop("_cx", "_cy", "_parts")
    hit = whole.unionByName(cast)
    attributes = numbered.select("_poly", *names)
    if how == "inner":
        return hit.join(attributes, "_poly").select(*points.columns, *names)
    return pts.join(hit.select("_point", "_poly"), "_point", how).join(attributes, "_poly", "left").select(*points.columns, *names)


def project_points(df: DataFrame, x: str = "lng", y: str = "lat", zone: int = 18) -> DataFrame:
    p = geo.utm(F.col(x), F.col(y), zone)
    return df.withColumns({"ux": p["x"], "uy": p["y"]})


def projected_centroids(polys: DataFrame, id_col: str, geom_col: str = "geometry", zone: int = 18) -> DataFrame:
    """Centroid of each polygon computed in the projected (metric) plane."""
    c = geo.let(geo.project_multi(F.col(geom_col), zone), geo.centroid)
    return polys.select(id_col, c["x"].alias("ux"), c["y"].alias("uy"))


def assign_stations(
    stations: DataFrame,
    zones: DataFrame,
    zone_col: str,
    boundary: DataFrame | None = None,
    station_col: str = "station_id",
    zone_utm: int = 18,
) -> DataFrame:
    """Station -> zone assignment, one row per station, sorted.

    boundary filter (C13) -> point-in-polygon (C14) -> gap stations (C11) ->
    nearest projected centroid (C15) -> union (G4) -> one zone per station,
    the smallest zone id among overlapping matches (D31).
    """
    st = stations.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).select(station_col, "lat", "lng")
    if boundary is not None:
        st = points_in_polygons(st, boundary.select("geometry"), how="inner").select(station_col, "lat", "lng")
    pip = points_in_polygons(st, zones.select(zone_col, "geometry"), how="left")
    assigned = pip.where(F.col(zone_col).isNotNull()).select(station_col, zone_col)
    gap_ids = pip.where(F.col(zone_col).isNull()).select(station_col)
    gaps = st.join(gap_ids, station_col, "left_semi")
    fallback = nearest(
        project_points(gaps), projected_centroids(zones, zone_col, zone=zone_utm), station_col, zone_col,
        "ux", "uy", "ux", "uy",
    ).select(station_col, zone_col)
    both = assigned.unionByName(fallback)
    return latest_by_key(both, [station_col], [zone_col]).orderBy(station_col)


def area_weighted_population(overlay: DataFrame, source: DataFrame, zone_col: str, src_col: str,
                             corrected_income: bool = False) -> DataFrame:
    """Interpolate source-unit counts onto zones by area share.

    population/households = bround(Σ value · weight); income = bround(Σ income ·
    w_pop / Σ w_pop).  By default the denominator includes the population of
    units whose income is suppressed (the reference's bias);
    ``corrected_income=True`` restricts it to units with an income.
    """
    j = overlay.join(source, src_col, "left")
    w = F.col("weight")
    wpop = F.col("population") * w
    inc_pop = F.when(F.col("median_household_income").isNotNull(), wpop) if corrected_income else wpop
    agg = j.groupBy(zone_col).agg(
        # the sum of a group without any value is 0, not NULL
        F.coalesce(F.sum(wpop), F.lit(0.0)).alias("_p"),
        F.coalesce(F.sum(F.col("households") * w), F.lit(0.0)).alias("_h"),
        F.coalesce(F.sum(F.col("median_household_income") * wpop), F.lit(0.0)).alias("_num"),
        F.sum(inc_pop).alias("_den"),
    )
    return agg.select(
        zone_col,
        F.bround(F.col("_p"), 0).cast("bigint").alias("population"),
        F.bround(F.col("_h"), 0).cast("bigint").alias("households"),
        F.bround(F.try_divide(F.col("_num"), F.col("_den")), 0).alias("median_household_income"),
    )
