"""Point-in-polygon join on plain DataFrames (no geometry library, no UDF).

Polygons come as GeoJSON MultiPolygon coordinates:
``array<array<array<array<double>>>>`` = parts -> rings -> [x, y] vertices,
x = longitude, y = latitude; the first ring of a part is its shell, the rest
are holes. Semantics follow ``within``: a point on a boundary is outside; a
point inside several areas gives several rows; a point in none keeps its row
with null area columns.

Plan (all equi-joins, nothing quadratic):

1. areas -> edges; every edge is listed once per horizontal *band* (row of
   grid cells of height ``cell_size``) its y-range touches;
2. areas -> a quadtree cover of each: cells that an edge touches are split down to ``cell_size``, others
   stay large and are wholly inside or left out;
3. distinct point positions -> their cell of every level; an equi-join on the cell gives
   the (position, area) pairs: those in inside cells are decided;
4. the others join the edges of their area in their band; the even-odd rule
   counts edges crossed by a ray to the +x side, and an exact on-edge test
   marks boundary points; one aggregate per (position, area) decides;
5. the decisions are joined back to all points by position.

Working on distinct positions keeps repeated positions (many trips at one
dock) from repeating the geometry work. Area ids must not repeat, which is
checked while areas are read. The cover starts from the boxes of parts, so an area of far
apart parts does not cover the cells between them. Points without a valid
position never enter a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.geo import valid_point
from tripflow.operators.joins import one_row_each

LEVELS = 6  # of the cover: its largest cells are 2**6 cell sizes wide


def _closed(ring: Column) -> Column:
    first, last = ring[0], F.element_at(ring, -1)
    return F.when((first[0] == last[0]) & (first[1] == last[1]), ring).otherwise(F.concat(ring, F.array(first)))


def _ring_edges(ring: Column) -> Column:
    """The edges of a closed ring."""
    n = F.size(ring) - 1
    return F.zip_with(
        F.slice(ring, 1, n),
        F.slice(ring, 2, n),
        lambda a, b: F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")),
    )


def _no_edges() -> Column:
    return F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")


def area_edges(areas: DataFrame, cell_size: float) -> DataFrame:
    """(area_id, band, x1, y1, x2, y2): one row per edge and band it touches."""
    rings = (
        areas.select("area_id", F.explode("geometry").alias("poly"))
        .select("area_id", F.explode("poly").alias("ring"))
        .where(F.size("ring") >= 3)
        .select("area_id", _closed(F.col("ring")).alias("ring"))
    )
    edges = rings.select("area_id", F.inline(_ring_edges(F.col("ring"))))
    lo = F.floor(F.least("y1", "y2") / F.lit(cell_size)).cast("long")
    hi = F.floor(F.greatest("y1", "y2") / F.lit(cell_size)).cast("long")
    return edges.withColumn("band", F.explode(F.sequence(lo, hi)))


def area_cells(areas: DataFrame, cell_size: float, levels: int = LEVELS, tolerance: float = 0.0) -> DataFrame:
    """(area_id, level, cx, cy, inside): cells that cover each area, large ones where they can be.

    A cell of a level is ``cell_size * 2**level`` wide. Cells of the top level that an area's box touches are split
    in four, level by level, as long as an edge of the area touches them. So small cells follow the outline, and their
    number grows with its length and not with the area. A cell that no edge touches lies inside the area or outside
    as a whole, which its centre tells: ``inside`` is true or the cell is left out. In the cells that
    edges touch at level 0 it is false: there points have to be tested.
    """
    top = float(cell_size * 2**levels)
    shells = areas.select("area_id", "geometry", F.explode("geometry").alias("poly")).select("area_id", "geometry", F.col("poly")[0].alias("shell"))
    cells_along = lambda axis: F.sequence(
        *(F.floor((pick(F.transform("shell", lambda v: v[axis])) + F.lit(by)) / F.lit(top)).cast("long") for pick, by in ((F.array_min, -tolerance), (F.array_max, tolerance)))
    )
    roots = shells.select("area_id", "geometry", F.explode(cells_along(0)).alias("cx"), cells_along(1).alias("ys"))
    roots = roots.select("area_id", "geometry", "cx", F.explode("ys").alias("cy")).dropDuplicates(["area_id", "cx", "cy"])
    edges = F.flatten(F.transform(F.flatten("geometry"), lambda ring: F.when(F.size(ring) >= 3, _ring_edges(_closed(ring))).otherwise(_no_edges())))

    def touching(edges: Column, level: Column, cx: Column, cy: Column) -> Column:
        size = F.lit(float(cell_size)) * F.pow(F.lit(2.0), level)
        x0, y0, x1, y1 = cx * size - tolerance, cy * size - tolerance, (cx + 1) * size + tolerance, (cy + 1) * size + tolerance

        def touches(e: Column) -> Column:
            boxes = (F.greatest(e["x1"], e["x2"]) >= x0) & (F.least(e["x1"], e["x2"]) <= x1) & (F.greatest(e["y1"], e["y2"]) >= y0) & (F.least(e["y1"], e["y2"]) <= y1)
            side = lambda x, y: (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
            corners = [side(x, y) for x in (x0, x1) for y in (y0, y1)]
            return boxes & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)

        return F.filter(edges, touches)

    def cell(edges: Column, level: Column, cx: Column, cy: Column) -> Column:
        return F.struct(level.alias("level"), cx.alias("cx"), cy.alias("cy"), touching(edges, level, cx, cy).alias("edges"))

    def split(c: Column, level: Column) -> Column:
        whole = (F.size(c["edges"]) == 0) | (c["level"] != level)
        fours = F.transform(
            F.array(*(F.struct(F.lit(x).cast("long").alias("x"), F.lit(y).cast("long").alias("y")) for x in (0, 1) for y in (0, 1))),
            lambda o: cell(c["edges"], c["level"] - 1, c["cx"] * 2 + o["x"], c["cy"] * 2 + o["y"]),
        )
        return F.when(whole, F.array(c)).otherwise(fours)

    start = F.array(cell(edges, F.lit(levels), F.col("cx"), F.col("cy")))
    down = F.sequence(F.lit(levels), F.lit(1), F.lit(-1)) if levels else F.array().cast("array<int>")
    cells = F.aggregate(down, start, lambda found, level: F.flatten(F.transform(found, lambda c: split(c, level))))
    found = roots.select("area_id", F.inline(F.transform(cells, lambda c: F.struct(c["level"], c["cx"], c["cy"], (F.size(c["edges"]) > 0).alias("edged")))))
    edged = found.where("edged").select("area_id", "level", "cx", "cy", F.lit(False).alias("inside"))
    size = F.lit(float(cell_size)) * F.pow(F.lit(2.0), F.col("level"))
    empty = found.where("NOT edged").select("area_id", "level", "cx", "cy", ((F.col("cx") + 0.5) * size).alias("x"), ((F.col("cy") + 0.5) * size).alias("y"))
    centres = empty.withColumn("band", F.floor(F.col("y") / F.lit(cell_size)).cast("long"))
    within = _strictly_inside(centres, areas, cell_size, ["level", "cx", "cy"], 0.0)
    return edged.unionByName(within.select("area_id", "level", "cx", "cy", F.lit(True).alias("inside")))


def _strictly_inside(candidates: DataFrame, areas: DataFrame, cell_size: float, keep: list[str], tolerance: float) -> DataFrame:
    """Those (x, y, area_id, ``keep``) of ``candidates`` (with the point's ``band``) whose point lies inside the area."""
    edges = area_edges(areas, cell_size)
    e = candidates.join(edges, ["area_id", "band"]).where(
        F.col("y").between(F.least("y1", "y2") - F.lit(tolerance), F.greatest("y1", "y2") + F.lit(tolerance))
    )
    x, y, x1, y1, x2, y2 = (F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2"))
    straddles = (y1 > y) != (y2 > y)
    x_cross = x1 + F.try_divide((y - y1) * (x2 - x1), y2 - y1)
    crossing = straddles & (x < x_cross)
    cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
    on_line = F.abs(cross) <= F.lit(tolerance) * F.greatest(F.abs(x2 - x1), F.abs(y2 - y1))
    on_edge = on_line & x.between(F.least(x1, x2), F.greatest(x1, x2)) & y.between(F.least(y1, y2), F.greatest(y1, y2))
    decided = e.groupBy("x", "y", "area_id", *keep).agg(
        F.sum(F.when(crossing, 1).otherwise(0)).alias("_crossings"),
        F.max(on_edge.cast("int")).alias("_on_edge"),
    )
    return decided.where((F.col("_crossings") % 2 == 1) & (F.col("_on_edge") == 0)).select("x", "y", "area_id", *keep)


def containing_areas(
    positions: DataFrame, areas: DataFrame, cell_size: float, tolerance: float = 0.0
) -> DataFrame:
    """(x, y, area_id) for every position strictly inside an area.

    ``positions`` has distinct ``x``, ``y`` (non-null). ``tolerance`` widens
    the on-edge test (points that close to a boundary count as outside).
    """
    cells = area_cells(areas, cell_size, tolerance=tolerance)
    at = lambda c, level: F.floor(F.col(c) / F.lit(float(cell_size * 2**level))).cast("long")
    homes = F.array(*(F.struct(F.lit(n).alias("level"), at("x", n).alias("cx"), at("y", n).alias("cy")) for n in range(LEVELS + 1)))
    pts = positions.select("x", "y", F.inline(homes))
    # a position lies in one cell of each level, and in one cell of an area's cover at most from each of its parts
    cand = pts.join(cells, ["level", "cx", "cy"])
    sure = cand.where("inside").select("x", "y", "area_id")
    open_ = cand.where("NOT inside").select("x", "y", "area_id", F.floor(F.col("y") / F.lit(cell_size)).cast("long").alias("band")).distinct()
    return sure.unionByName(_strictly_inside(open_, areas, cell_size, [], tolerance)).distinct()


def points_in_areas(
    points: DataFrame,
    areas: DataFrame,
    cell_size: float,
    attributes: list[str] | None = None,
    lat: str = "latitude",
    lon: str = "longitude",
    tolerance: float = 0.0,
) -> DataFrame:
    """Left spatial join: every point row, plus ``area_id`` and ``attributes``
    of each area containing it (nulls when none; invalid coordinates match none)."""
    attributes = attributes if attributes is not None else [c for c in areas.columns if c not in ("area_id", "geometry")]
    positions = (
        points.where(valid_point(lat, lon))
        .select(F.col(lon).cast("double").alias("x"), F.col(lat).cast("double").alias("y"))
        .distinct()
    )
    areas = one_row_each(areas.select("area_id", *attributes, "geometry"), "area_id")
    hits = containing_areas(positions, areas, cell_size, tolerance)
    hits = hits.join(areas.select("area_id", *attributes), "area_id").withColumnRenamed("x", "_hx").withColumnRenamed("y", "_hy")
    placed = points.where(valid_point(lat, lon)).join(
        hits, (F.col(lon).cast("double") == F.col("_hx")) & (F.col(lat).cast("double") == F.col("_hy")), "left"
    )
    rest = points.where(~F.coalesce(valid_point(lat, lon), F.lit(False)))
    return placed.drop("_hx", "_hy").unionByName(rest, allowMissingColumns=True)
