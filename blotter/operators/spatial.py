"""Point-in-polygon join (Q7; J3).

``locate(points, areas)`` keeps each point that lies strictly inside an area
(``within``: a point on an edge or vertex does not match), one row per
(point, area), so a point in two overlapping areas gives two rows and a
point in none is dropped.  Polygons may have holes and several parts.

Plan, all built-in expressions (no Python per row):

1. Areas are exploded to their edges ``(area, x1, y1, x2, y2)``.
2. Cells: every area's bounding box is cut into square cells, their side a
   power of two by that area's own size, so one large area does not coarsen
   the cells of small ones.  A cell an edge passes through (traced column by column, with a one-cell
   margin) is a boundary cell; any other cell is wholly inside or wholly
   outside its area, decided once from its centre.
   The cell table keeps boundary and inside cells only.
3. Strips: each edge is listed under every horizontal strip its y-range
   touches, gathered per (area, strip).  An edge that can cross a point's
   rightward ray, or contain the point, has the point's y in its y-range, so
   it is in the point's strip.  A strip that holds too many edges is split into
   thinner ones until each holds few, or only edges that truly share its y; a
   strip's key is its height and number, and an area has a few heights in use.
4. Points join the cell table by equality on their cell of each side in use
   (no range predicate, so no nested-loop join).  A point in an inside cell matches with no edge
   test; a point in a boundary cell joins its strip and takes the exact test:
   ray crossings counted over all rings and parts (even-odd: holes and
   multipart areas work) and no edge containing the point, on the given
   doubles.  Strips of up to ``UNROLL_MAX`` edges are tested by unrolled
   expressions compiled into the stage; longer ones by higher-order functions.

Both lookup tables grow with the polygons, never with the points.
:func:`index_areas` materialises them once (a reliable checkpoint into the
shared checkpoint folder, which also keeps later plans short); they are
broadcast when their measured bytes are within the bound and joined as Spark
decides otherwise; there the points are counted by cell first, and the rows of a
cell or strip with many points are copied, its points dealt over the copies.
Cell and strip sizes change only the speed, never the result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.session import cut_lineage

POLYGON = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
MULTIPOLYGON = T.ArrayType(POLYGON)


def multipolygon(geom_type: Column, coordinates: Column) -> Column:
    """GeoJSON ``coordinates`` (as JSON text) to a MultiPolygon array.

    A Polygon has one nesting level fewer and is wrapped as a one-part
    MultiPolygon; other geometry types give NULL.
    """
    return (F.when(geom_type == "MultiPolygon", F.from_json(coordinates, MULTIPOLYGON))
            .when(geom_type == "Polygon", F.array(F.from_json(coordinates, POLYGON))))


def polygon_edges(areas: DataFrame, area_col: str = "area", geom_col: str = "geometry") -> DataFrame:
    """Edges of every ring of every part: ``(area, x1, y1, x2, y2)``.

    A ring whose last position differs from its first is closed.  Rings with
    fewer than three positions are ignored.
    """
    parts = areas.select(area_col, F.explode(geom_col).alias("_poly"))
    rings = parts.select(area_col, F.explode("_poly").alias("_ring")).where(F.size("_ring") >= 3)
    first, last = F.element_at("_ring", 1), F.element_at("_ring", -1)
    closed = F.when((first[0] == last[0]) & (first[1] == last[1]), F.col("_ring")) \
        .otherwise(F.concat(F.col("_ring"), F.array(first)))
    rings = rings.select(area_col, closed.alias("_ring"))
    pts = F.col("_ring")
    segs = F.transform(
        F.sequence(F.lit(1), F.size(pts) - 1),
        lambda i: F.struct(F.element_at(pts, i)[0].alias("x1"), F.element_at(pts, i)[1].alias("y1"),
                           F.element_at(pts, i + 1)[0].alias("x2"),
                           F.element_at(pts, i + 1)[1].alias("y2")))
    return rings.select(area_col, F.inline(segs))


# Cells of an area's bounding box are at most about this many, whatever the other areas.
CELLS_PER_AREA = 4096
# A lookup table is broadcast if its measured bytes are within this bound.
BROADCAST_BYTES = 64 << 20


def area_cell_sizes(edges: DataFrame, cell_size: float | None, area_col: str = "area") -> DataFrame:
    """``(area, r)``: the side of each area's cells.

    A power of two by the area's own box (at most ``CELLS_PER_AREA`` cells, and no
    side of the box over 4096 cells), so that the cells of a small area do not
    grow with a large one.  ``cell_size`` sets one side for all instead.
    """
    w = F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2"))
    h = F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2"))
    boxes = edges.groupBy(area_col).agg(w.alias("_w"), h.alias("_h"))
    side = F.greatest(F.sqrt(F.col("_w") * F.col("_h") / CELLS_PER_AREA), F.greatest("_w", "_h") / 4096)
    own = F.when(side > 0, F.pow(F.lit(2.0), F.ceil(F.log2(side)))).otherwise(F.lit(1.0))
    return boxes.select(area_col, (own if cell_size is None else F.lit(float(cell_size))).alias("r"))


# A strip of more edges than this is split into SPLIT thinner ones, as long as that can help.
STRIP_EDGES = 32
SPLIT = 16
# Rounds of splitting at most: strips a millionth as high as the first.
ROUNDS = 5


def _strips_of(edges: DataFrame, area_col: str) -> DataFrame:
    """``(area, r, h, sy)`` with the edges ``_e`` touching that strip of height ``h``."""
    lo, hi = F.floor(F.least("y1", "y2") / F.col("h")), F.floor(F.greatest("y1", "y2") / F.col("h"))
    return edges.select(area_col, "r", "h", F.explode(F.sequence(lo, hi)).alias("sy"),
                        F.struct("x1", "y1", "x2", "y2").alias("_e"))


def _crowded(pieces: DataFrame, area_col: str) -> DataFrame:
    """Keys of the strips that are worth splitting: more than ``STRIP_EDGES`` edges, over half
    of that many of them ending inside the strip, and not all at one y."""
    y1, y2 = F.col("_e.y1"), F.col("_e.y2")
    ends = [F.when((F.floor(y / F.col("h")) == F.col("sy")) & (y1 != y2), y) for y in (y1, y2)]
    return (pieces.groupBy(area_col, "r", "h", "sy")
            .agg(F.count(F.lit(1)).alias("_n"), F.count(F.coalesce(*ends)).alias("_ending"),
                 F.min(F.least(*ends)).alias("_low"), F.max(F.greatest(*ends)).alias("_high"))
            .where((F.col("_n") > STRIP_EDGES) & (F.col("_ending") > STRIP_EDGES // 2) & (F.col("_low") < F.col("_high")))
            .select(area_col, "r", "h", "sy"))


def strip_edges(edges: DataFrame, area_col: str = "area", split: bool = True) -> DataFrame:
    """``(area, r, h, sy, _edges)``: edges gathered per strip of height ``h`` their y-range touches.

    With ``split``, crowded strips are cut into ``SPLIT`` thinner ones, and those again, each round
    over the crowded strips' edges alone, in at most ``ROUNDS`` rounds.  Splitting ends where a strip
    holds at most ``STRIP_EDGES`` edges, or few that end inside it (the others span it and would be
    in every part), or all ends there share one y.
    """
    keys = [area_col, "r", "h", "sy"]
    pieces, done = _strips_of(edges, area_col), []
    for _ in range(ROUNDS if split else 0):
        crowded = _crowded(pieces, area_col)
        if crowded.isEmpty():
            break
        crowded = cut_lineage(crowded)
        done.append(pieces.join(crowded, keys, "left_anti"))
        h = F.col("h") / SPLIT
        first, last = F.col("sy") * SPLIT, F.col("sy") * SPLIT + (SPLIT - 1)
        lo = F.greatest(F.floor(F.least("_e.y1", "_e.y2") / h), first)
        hi = F.least(F.floor(F.greatest("_e.y1", "_e.y2") / h), last)
        pieces = cut_lineage(pieces.join(crowded, keys).where(lo <= hi)
                             .select(area_col, "r", h.alias("h"), F.explode(F.sequence(lo, hi)).alias("sy"), "_e"))
    return union_all([*done, pieces]).groupBy(*keys).agg(F.collect_list("_e").alias("_edges"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def _crossing(px: Column, py: Column, e: Column) -> Column:
    """The rightward ray from (px, py) crosses edge ``e`` (half-open in y)."""
    x1, y1, x2, y2 = e["x1"], e["y1"], e["x2"], e["y2"]
    straddles = (y1 > py) != (y2 > py)
    return F.when(straddles, px < x1 + (py - y1) * (x2 - x1) / (y2 - y1)).otherwise(F.lit(False))


def _on_edge(px: Column, py: Column, e: Column) -> Column:
    """(px, py) lies on edge ``e``: zero cross product and inside its box."""
    x1, y1, x2, y2 = e["x1"], e["y1"], e["x2"], e["y2"]
    return (((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) == 0)
            & px.between(F.least(x1, x2), F.greatest(x1, x2))
            & py.between(F.least(y1, y2), F.greatest(y1, y2)))


# Strips with at most this many edges take the unrolled (compiled) test.
UNROLL_MAX = 32


def strictly_inside(px: Column, py: Column, edges: Column, unroll: int = 0,
                    slots: list[Column] | None = None) -> Column:
    """Odd number of ray crossings and on no edge: the exact test.

    With ``unroll`` = k > 0, arrays of at most k edges are tested by k fixed
    slots (plain expressions, compiled into the stage's generated code);
    longer arrays, and every array when k = 0, by higher-order functions.
    ``slots``: the k edges already taken out of the array as columns.
    """
    crossings = F.aggregate(edges, F.lit(0),
                            lambda n, e: n + F.when(_crossing(px, py, e), F.lit(1)).otherwise(F.lit(0)))
    looped = (crossings % 2 == 1) & ~F.exists(edges, lambda e: _on_edge(px, py, e))
    if unroll <= 0:
        return looped
    if slots is None:
        slots = [F.try_element_at(edges, F.lit(i + 1)) for i in range(unroll)]
    count = None
    on = None
    for e in slots:
        c = F.when(e.isNotNull() & _crossing(px, py, e), F.lit(1)).otherwise(F.lit(0))
        o = F.coalesce(e.isNotNull() & _on_edge(px, py, e), F.lit(False))
        count = c if count is None else count + c
        on = o if on is None else on | o
    unrolled = (count % 2 == 1) & ~on
    return F.when(F.size(edges) <= unroll, unrolled).otherwise(looped)


CELL_IN, CELL_EDGE = "in", "edge"


def area_cells(edges: DataFrame, strips: DataFrame, area_col: str = "area") -> DataFrame:
    """Cells ``(r, cx, cy, area, hs, status)`` of side ``r`` of each area's bounding box that can hold
    inside points; ``hs`` are the heights of the area's strips.

    ``edge``: an edge passes through or next to the cell, so points there
    need the exact test.  No edge comes near any other cell, so each is
    wholly inside or wholly outside the area: its centre decides, by the
    exact test, once per cell.  Outside cells are left out, so their points
    meet no candidate.
    """
    r = F.col("r")
    boxes = edges.groupBy(area_col, "r").agg(
        F.floor(F.min(F.least("x1", "x2")) / r).alias("_x0"),
        F.floor(F.max(F.greatest("x1", "x2")) / r).alias("_x1"),
        F.floor(F.min(F.least("y1", "y2")) / r).alias("_y0"),
        F.floor(F.max(F.greatest("y1", "y2")) / r).alias("_y1"))
    every = (boxes
             .select(area_col, "r", "_y0", "_y1", F.explode(F.sequence("_x0", "_x1")).alias("cx"))
             .select(area_col, "r", "cx", F.explode(F.sequence("_y0", "_y1")).alias("cy")))
    # cells an edge reaches.  A point's cell is floor(coord / r), monotone in
    # the coordinate, so a point on an edge falls in a column of the edge's
    # [floor(min x / r), floor(max x / r)] range.  Within each column the
    # segment spans the y-range between its ends in that column; the cells of
    # that range, one more on each side (covering rounding), clipped to the
    # edge's own row range, are marked.  For axis-aligned or short edges this
    # is the edge's bounding box; a long diagonal marks about three cells per
    # column instead of its whole box.
    x1, y1, x2, y2 = F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")
    cols = edges.select(
        area_col, "r", "x1", "y1", "x2", "y2",
        F.floor(F.least(y1, y2) / r).alias("_r0"), F.floor(F.greatest(y1, y2) / r).alias("_r1"),
        F.least(x1, x2).alias("_xa"), F.greatest(x1, x2).alias("_xb"),
        F.explode(F.sequence(F.floor(F.least(x1, x2) / r),
                             F.floor(F.greatest(x1, x2) / r))).alias("cx"))
    lo = F.greatest(F.col("_xa"), F.col("cx") * r)
    hi = F.least(F.col("_xb"), (F.col("cx") + F.lit(1)) * r)

    def y_at(x):
        return y1 + (x - x1) * (y2 - y1) / (x2 - x1)
    upright = x1 == x2
    first = F.when(upright, F.col("_r0")).otherwise(
        F.greatest(F.floor(F.least(y_at(lo), y_at(hi)) / r) - 1, F.col("_r0")))
    last = F.when(upright, F.col("_r1")).otherwise(
        F.least(F.floor(F.greatest(y_at(lo), y_at(hi)) / r) + 1, F.col("_r1")))
    touched = (cols.select(area_col, "r", "cx", first.alias("_c0"), last.alias("_c1"))
               .select(area_col, "r", "cx",
                       F.explode(F.sequence(F.least("_c0", "_c1"), F.greatest("_c0", "_c1"))).alias("cy")))
    # every touched cell lies in its area's box, so one grouping tells both kinds apart
    flagged = (every.withColumn("_edge", F.lit(0)).unionByName(touched.withColumn("_edge", F.lit(1)))
               .groupBy(area_col, "r", "cx", "cy").agg(F.max("_edge").alias("_edge")))
    heights = strips.groupBy(area_col).agg(F.array_sort(F.collect_set("h")).alias("hs"))
    flagged = flagged.join(heights, area_col)
    kept = [area_col, "r", "cx", "cy", "hs"]
    edge_cells = flagged.where("_edge = 1").select(*kept, F.lit(CELL_EDGE).alias("status"))
    cx_mid = (F.col("cx") + F.lit(0.5)) * r
    cy_mid = (F.col("cy") + F.lit(0.5)) * r
    centred = (flagged.where("_edge = 0").select(*kept, F.explode("hs").alias("h"))
               .withColumn("sy", F.floor(cy_mid / F.col("h"))))
    inside = (centred.join(strips.drop("r"), [area_col, "h", "sy"], "inner")
              .where(strictly_inside(cx_mid, cy_mid, F.col("_edges")))
              .select(*kept, F.lit(CELL_IN).alias("status")))
    return edge_cells.unionByName(inside)


@dataclass(frozen=True)
class AreaIndex:
    """Polygons prepared for :func:`locate`: built once, reused for any number
    of point tables (complaints and shootings against the same areas)."""

    cells: DataFrame
    strips: DataFrame
    area_col: str
    sizes: tuple[float, ...]
    cell_bytes: int
    strip_bytes: int
    max_strip_edges: int
    heights: int  # of one area's strips, at most


def index_areas(areas: DataFrame, area_col: str = "area", geom_col: str = "geometry",
                cell_size: float | None = None, strip_height: float | None = None) -> AreaIndex:
    """Cell and strip tables of the areas, materialised and measured once.

    Both are checkpointed into the shared folder: short lineage, and they
    survive a lost executor.  What comes to the driver is their sizes in bytes
    and the distinct cell sides (powers of two).  ``strip_height`` sets one
    height for all strips, and none is split.
    """
    # the edge table is an intermediate: cached while the two lookup tables
    # are built from it, then released
    edges = polygon_edges(areas, area_col, geom_col)
    height = F.col("r") / 8 if strip_height is None else F.lit(float(strip_height))
    edges = (edges.join(area_cell_sizes(edges, cell_size, area_col), area_col)
             .withColumn("h", height).persist())
    try:
        strips = cut_lineage(strip_edges(edges, area_col, split=strip_height is None))
        cells = cut_lineage(area_cells(edges, strips, area_col))
    finally:
        edges.unpersist()
    width = F.length(F.col(area_col).cast("string")) + 48
    measures = (strips.select((width + 32 * F.size("_edges")).alias("_s"), F.size("_edges").alias("_e"),
                              F.lit(0).alias("_c"), F.lit(None).cast("double").alias("_r"), F.lit(0).alias("_hs"))
                .unionAll(cells.select(F.lit(0), F.lit(0), width + 8 * F.size("hs"), "r", F.size("hs"))))
    strip_bytes, most, cell_bytes, sizes, heights = measures.agg(
        F.sum("_s"), F.max("_e"), F.sum("_c"), F.collect_set("_r"), F.max("_hs")).first()
    return AreaIndex(cells, strips, area_col, tuple(sorted(sizes)), cell_bytes or 0, strip_bytes or 0, most or 0,
                     heights or 1)


def _bounded(df: DataFrame, size: int, bound: int) -> DataFrame:
    """Broadcast a table whose bytes were measured, if within the bound; else Spark decides."""
    return F.broadcast(df) if size <= bound else df


class _Hot:
    """Keys with many points, and over how many copies each is dealt.

    A key is hot if it has over a ``parts``-th of all points, so there are at most ``parts`` of them
    whatever the input; a copy gets about a quarter of such a part.
    """

    def __init__(self, counts: DataFrame, keys: list[str], total: int, parts: int):
        key = F.xxhash64(*keys)
        rows = (counts.groupBy(key.alias("k")).agg(F.sum("n").alias("n")).where(F.col("n") * parts > total)
                .orderBy(F.desc("n")).collect())
        self.copies = {row.k: -(-row.n * 4 * parts // total) for row in rows}

    def number(self, *key: Column) -> Column:
        """Copies of the row's key (1 unless hot)."""
        k = F.xxhash64(*key)
        if not self.copies:
            return F.lit(1).cast("long")
        found = F.create_map(*[F.lit(v) for kv in self.copies.items() for v in kv])
        return F.when(k.isin(*self.copies), F.try_element_at(found, k).cast("long")).otherwise(F.lit(1).cast("long"))

    def dealt(self, *key: Column) -> Column:
        """The copy a point goes to: by turns within its partition."""
        return F.pmod(F.monotonically_increasing_id(), self.number(*key))

    def copied(self, df: DataFrame, name: str, *key: Column) -> DataFrame:
        return df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), self.number(*key) - 1)))


def hot_cells(points: DataFrame, cells: DataFrame, parts: int, area_col: str) -> tuple[_Hot, _Hot]:
    """Hot cells, and hot (area, row of cells): the points of a strip are among those of its row.

    ``points`` have ``_r, _cx, _cy``; they are counted once, with map-side partial sums, and the
    counts written."""
    cell = ["_r", "_cx", "_cy"]
    counts = cut_lineage(points.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 1
    rows = counts.join(cells.where(F.col("_status") == CELL_EDGE), cell).select(area_col, "_cy", "n")
    return _Hot(counts, cell, total, parts), _Hot(rows, [area_col, "_cy"], total, parts)


def locate(points: DataFrame, areas: DataFrame | AreaIndex, x: str = "longitude",
           y: str = "latitude", area_col: str = "area", geom_col: str = "geometry",
           cell_size: float | None = None, strip_height: float | None = None,
           max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Q7: points strictly inside areas; the point's columns plus the area column.

    ``areas`` is an :class:`AreaIndex` or a DataFrame with one row per area
    and a MultiPolygon array in ``geom_col`` (see :func:`multipolygon`),
    indexed on the fly.  Coordinates of points and areas must be in the same
    system; nothing is reprojected.  Points with a NULL or NaN coordinate
    match nothing.  The points must not already have a column named like the
    area column.
    """
    idx = areas if isinstance(areas, AreaIndex) else index_areas(
        areas, area_col, geom_col, cell_size, strip_height)
    area_col = idx.area_col
    px, py = F.col(x), F.col(y)
    # NULL or NaN coordinates match nothing (floor(NaN) would land in cell 0)
    valid = px.isNotNull() & py.isNotNull() & ~F.isnan(px) & ~F.isnan(py)
    # a point meets the cells of each size in use (a handful of powers of two)
    side = F.explode(F.array(*[F.lit(r) for r in idx.sizes])) if len(idx.sizes) > 1 else F.lit(
        idx.sizes[0] if idx.sizes else 1.0)
    keyed = points.where(valid).withColumn("_r", side).withColumns({
        "_cx": F.floor(px / F.col("_r")), "_cy": F.floor(py / F.col("_r"))})
    cells = idx.cells.select(F.col("r").alias("_r"), F.col("cx").alias("_cx"), F.col("cy").alias("_cy"),
                             area_col, F.col("hs").alias("_hs"), F.col("status").alias("_status"))
    strips = idx.strips.select(F.col(area_col).alias("_ja"), F.col("h").alias("_jh"), F.col("sy").alias("_js"),
                               F.floor(F.col("sy") * (F.col("h") / F.col("r"))).alias("_cy"), "_edges")
    on_cell, on_strip = ["_r", "_cx", "_cy"], ["_ja", "_jh", "_js"]
    small_cells, small_strips = (size <= max_broadcast_bytes for size in (idx.cell_bytes, idx.strip_bytes))
    salted = not (small_cells and small_strips)
    if salted:
        # a table too large to broadcast is joined by a shuffle: spread its hot keys
        parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        cell_hot, row_hot = hot_cells(keyed, cells, parts, area_col)
    if not small_cells:
        keyed = keyed.withColumn("_copy", cell_hot.dealt(*on_cell))
        cells = cell_hot.copied(cells, "_copy", *on_cell)
        on_cell = [*on_cell, "_copy"]
    cand = keyed.join(_bounded(cells, idx.cell_bytes, max_broadcast_bytes), on_cell, "inner")
    # only points in boundary cells look up edges, once for each height in use in
    # their area (they meet one strip at most).  The others probe with a
    # NULL area, which never matches, and a hashed strip value, so that on the
    # shuffle path they spread over partitions instead of all hashing to the
    # partition of a NULL key
    edge = F.col("_status") == CELL_EDGE
    if idx.heights > 1:
        cand = cand.withColumn("_jh", F.explode(F.when(edge, F.col("_hs")).otherwise(F.slice("_hs", 1, 1))))
    else:
        cand = cand.withColumn("_jh", F.col("_hs")[0])
    cand = cand.withColumns({
        "_ja": F.when(edge, F.col(area_col)),
        "_js": F.when(edge, F.floor(py / F.col("_jh"))).otherwise(F.xxhash64(px, py))})
    if not small_strips:
        # both sides take the row of cells from the strip's number
        cand = cand.withColumn("_dealt", row_hot.dealt(
            F.col("_ja"), F.when(edge, F.floor(F.col("_js") * (F.col("_jh") / F.col("_r"))))))
        strips = row_hot.copied(strips, "_dealt", F.col("_ja"), F.col("_cy"))
        on_strip = [*on_strip, "_dealt"]
    tested = cand.join(_bounded(strips.drop("_cy"), idx.strip_bytes, max_broadcast_bytes), on_strip, "left")
    # the first k edges of the strip as plain columns, read by the unrolled test
    k = min(idx.max_strip_edges, UNROLL_MAX)
    tested = tested.withColumns({f"_e{i}": F.try_element_at("_edges", F.lit(i + 1)) for i in range(k)})
    keep = (F.col("_status") == CELL_IN) | (
        F.col("_edges").isNotNull()
        & strictly_inside(px, py, F.col("_edges"), k, [F.col(f"_e{i}") for i in range(k)]))
    return tested.where(keep).select(*points.columns, area_col)
