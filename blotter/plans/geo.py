"""Spatial and lookup queries on the driver tables (Q7-Q9, and Q7→Q8→Q10).

Areas are derived from ``nation``: nation ``k`` owns a 2 × 1.5 tile at
((k mod 5)·2, (k div 5)·1.5) shaped by ``k mod 4`` — a square reaching into
its right neighbour (overlaps), a square with a hole, a concave U with a
diagonal corner, or two separate parts (one ring left unclosed).  They are
written as GeoJSON features (Polygon or MultiPolygon, coordinates as JSON
text) and read back through the GeoJSON path.  Points come from every
``lineitem`` row on a 0.01 grid, so many fall exactly on edges and vertices.
The income lookup is derived from ``nation`` too, with ``-1`` and NULL values.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.categorical import INCOME_BANDS
from blotter.operators.enrich import enrich_area
from blotter.operators.spatial import AreaIndex, index_areas, locate
from blotter.operators.trend import band_trend, monthly_counts
from blotter.plans.catalog import register, rounded, table
from blotter.sources.geojson import area_dimension, areas_from_features

TILE_W, TILE_H = 2.0, 1.5


def tile_shape(kind: int, x0, y0):
    """Rings of tile ``kind`` at (x0, y0); works on floats and on Columns.

    Returns ``(geojson_type, coordinates)``: Polygon coordinates are a list
    of rings, MultiPolygon coordinates a list of polygons.
    """
    def p(dx, dy):
        return [x0 + dx, y0 + dy]
    if kind == 0:
        return "Polygon", [[p(0, 0), p(2.25, 0), p(2.25, 1.5), p(0, 1.5), p(0, 0)]]
    if kind == 1:
        return "Polygon", [[p(0, 0), p(2, 0), p(2, 1.5), p(0, 1.5), p(0, 0)],
                           [p(0.5, 0.5), p(0.5, 1.0), p(1.5, 1.0), p(1.5, 0.5), p(0.5, 0.5)]]
    if kind == 2:
        return "Polygon", [[p(0, 0.5), p(0.5, 0), p(2, 0), p(2, 1.5), p(1.5, 1.5), p(1.5, 0.5),
                            p(0.5, 0.5), p(0.5, 1.5), p(0, 1.5), p(0, 0.5)]]
    return "MultiPolygon", [[[p(0, 0), p(0.75, 0), p(0.75, 1.5), p(0, 1.5), p(0, 0)]],
                            [[p(1.25, 0), p(2, 0), p(2, 1.5), p(1.25, 1.5)]]]


def area_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON-shaped features (properties, geometry{type, coordinates text}) per nation.

    Each shape is a literal template of offsets, moved to the nation's tile
    origin by ``transform``: a short expression whatever the vertex count.
    """
    nation = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    x0 = (k % 5).cast("double") * F.lit(TILE_W)
    y0 = F.floor(k / 5).cast("double") * F.lit(TILE_H)
    kind = k % 4

    def moved(ring):
        return F.transform(ring, lambda p: F.array(p[0] + x0, p[1] + y0))

    gtype, coords = None, None
    for i in range(4):
        t, template = tile_shape(i, 0.0, 0.0)
        if t == "Polygon":
            parsed = F.from_json(F.lit(json.dumps(template)), "array<array<array<double>>>")
            js = F.to_json(F.transform(parsed, moved))
        else:
            parsed = F.from_json(F.lit(json.dumps(template)), "array<array<array<array<double>>>>")
            js = F.to_json(F.transform(parsed, lambda poly: F.transform(poly, moved)))
        gtype = F.when(kind == i, F.lit(t)) if gtype is None else gtype.when(kind == i, F.lit(t))
        coords = F.when(kind == i, js) if coords is None else coords.when(kind == i, js)
    return nation.select(
        F.struct(k.cast("string").alias("ntacode"), F.col("n_name").alias("ntaname")).alias("properties"),
        F.struct(gtype.alias("type"), coords.alias("coordinates")).alias("geometry"))


def income_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ntacode, ntaname, income) with -1 (not residential) and NULL entries."""
    k = F.col("n_nationkey")
    income = (F.when(k % 7 == 3, F.lit(-1)).when(k % 11 == 5, F.lit(None).cast("int"))
              .otherwise(F.lit(20000) + k * 6000))
    return table(spark, sf_dir, "nation").select(
        k.cast("string").alias("ntacode"), F.col("n_name").alias("ntaname"), income.alias("income"))


def line_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"),
        ((F.col("l_partkey") % 1000) / 100).alias("x"),
        (((F.col("l_suppkey") * 7 + F.col("l_quantity")) % 800) / 100).alias("y"))


def area_index(spark: SparkSession, sf_dir: str) -> AreaIndex:
    """The nation areas indexed; several point tables can share one index."""
    areas = areas_from_features(area_features(spark, sf_dir), ["ntacode"])
    return index_areas(areas, area_col="ntacode")


def located_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locate(line_points(spark, sf_dir), area_index(spark, sf_dir), x="x", y="y")


def _edges_sql() -> str:
    rows = []
    for k in range(25):
        x0, y0 = (k % 5) * TILE_W, (k // 5) * TILE_H
        t, coords = tile_shape(k % 4, x0, y0)
        polys = [coords] if t == "Polygon" else coords
        for poly in polys:
            for ring in poly:
                if ring[0] != ring[-1]:
                    ring = ring + [ring[0]]
                for (a, b), (c, d) in zip(ring, ring[1:]):
                    rows.append(f"('{k}', {a!r}, {b!r}, {c!r}, {d!r})")
    return ",\n    ".join(rows)


LOCATED_SQL = f"""
WITH pts AS (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate,
         (l_partkey % 1000) / 100 AS x, ((l_suppkey * 7 + l_quantity) % 800) / 100 AS y
  FROM lineitem
), edges(ntacode, x1, y1, x2, y2) AS (VALUES
    {_edges_sql()}
), t AS (
  SELECT p.l_orderkey, p.l_linenumber, p.l_shipdate, p.x, p.y, e.ntacode,
         sum(CASE WHEN (e.y1 > p.y) <> (e.y2 > p.y)
                       AND p.x < e.x1 + (p.y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
                  THEN 1 ELSE 0 END) AS n,
         bool_or(((e.x2 - e.x1) * (p.y - e.y1) - (e.y2 - e.y1) * (p.x - e.x1) = 0)
                 AND p.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                 AND p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)) AS on_edge
  FROM pts p, edges e
  GROUP BY p.l_orderkey, p.l_linenumber, p.l_shipdate, p.x, p.y, e.ntacode
), located AS (
  SELECT l_orderkey, l_linenumber, l_shipdate, x, y, ntacode FROM t WHERE n % 2 = 1 AND NOT on_edge
)
"""


@register("locate", LOCATED_SQL + """
SELECT l_orderkey, l_linenumber, l_shipdate, round(x, 6) AS x, round(y, 6) AS y, ntacode FROM located
""")
def q_locate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: every lineitem point placed in the areas that strictly contain it."""
    return rounded(located_points(spark, sf_dir))


@register("locate_mixed", LOCATED_SQL + """
, box AS (
  SELECT l_orderkey, l_linenumber, x, y, 'R' || CAST(r_regionkey AS VARCHAR) AS ntacode
  FROM pts CROSS JOIN region WHERE x > -1 AND x < 11 AND y > -1 AND y < 9 + r_regionkey
)
SELECT l_orderkey, l_linenumber, round(x, 6) AS x, round(y, 6) AS y, ntacode FROM located
UNION ALL SELECT l_orderkey, l_linenumber, round(x, 6), round(y, 6), ntacode FROM box
""")
def q_locate_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7 with areas of very different sizes: the nation tiles, and for each region one
    rectangle over all of them."""
    key = F.col("r_regionkey")

    def corner(x, y):
        return F.array(F.lit(float(x)), y)
    low, high = F.lit(-1.0), F.lit(9.0) + key
    ring = F.array(corner(-1, low), corner(11, low), corner(11, high), corner(-1, high), corner(-1, low))
    boxes = table(spark, sf_dir, "region").select(
        F.concat(F.lit("R"), key.cast("string")).alias("ntacode"), F.array(F.array(ring)).alias("geometry"))
    tiles = areas_from_features(area_features(spark, sf_dir), ["ntacode"]).select("ntacode", "geometry")
    points = line_points(spark, sf_dir).drop("l_shipdate")
    return rounded(locate(points, tiles.unionByName(boxes), x="x", y="y", area_col="ntacode"))


@register("all_vs_located_trend", LOCATED_SQL + """
, inside AS (SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate FROM located)
, n AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS cnt
  FROM pts WHERE l_shipdate IS NOT NULL GROUP BY 1
), i AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS located
  FROM inside WHERE l_shipdate IS NOT NULL GROUP BY 1
)
SELECT n.month, n.cnt, coalesce(i.located, 0) AS located FROM n LEFT JOIN i USING (month)
""")
def q_all_vs_located_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly counts of all points and of those in some area (each once)."""
    points = line_points(spark, sf_dir)
    inside = located_points(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_shipdate").distinct()
    every = monthly_counts(points, "l_shipdate")
    some = monthly_counts(inside, "l_shipdate", count_col="located")
    return every.join(some, "month", "left").withColumn("located", F.coalesce("located", F.lit(0)))


@register("located_named", LOCATED_SQL + """
SELECT l.ntacode, n.n_name AS neighborhood, n.n_name AS ntaname,
       20000 + n.n_nationkey * 6000 AS income, count(*) AS cnt
FROM located l JOIN nation n ON l.ntacode = CAST(n.n_nationkey AS VARCHAR)
WHERE n.n_nationkey % 7 <> 3 AND n.n_nationkey % 11 <> 5
GROUP BY 1, 2, 3, 4
""")
def q_located_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: the located pipeline with the areas' own names attached as ``neighborhood``."""
    from blotter.plans.shootings import locate_with_income
    points = line_points(spark, sf_dir).withColumnsRenamed({"x": "longitude", "y": "latitude"})
    located = locate_with_income(points, area_index(spark, sf_dir), income_lookup(spark, sf_dir),
                                 area_names=area_dimension(area_features(spark, sf_dir)))
    return (located.groupBy("ntacode", "neighborhood", "ntaname", "income")
            .agg(F.count(F.lit(1)).alias("cnt")))


@register("feature_collection", """
SELECT CAST(n_nationkey AS VARCHAR) AS ntacode, n_name AS ntaname,
       CASE n_nationkey % 4 WHEN 3 THEN 2 ELSE 1 END AS parts,
       CASE n_nationkey % 4 WHEN 0 THEN 5 WHEN 1 THEN 10 WHEN 2 THEN 10 ELSE 9 END AS positions
FROM nation
""")
def q_feature_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features written as one FeatureCollection text a row and parsed again."""
    from blotter.sources.geojson import features_from_text
    features = area_features(spark, sf_dir)
    text = F.concat(F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","properties":'),
                    F.to_json("properties"), F.lit(',"geometry":{"type":"'), F.col("geometry.type"),
                    F.lit('","coordinates":'), F.col("geometry.coordinates"), F.lit("}}]}"))
    parsed = features_from_text(features.select(text.alias("value")), "value", ["ntacode", "ntaname"])
    areas = areas_from_features(parsed, ["ntacode", "ntaname"])
    rings = F.flatten("geometry")
    return areas.select("ntacode", "ntaname", F.size("geometry").alias("parts"),
                        F.size(F.flatten(rings)).alias("positions"))


LOOKUP_SQL = """
, lookup AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS ntacode, n_name AS ntaname,
         CASE WHEN n_nationkey % 7 = 3 THEN -1 WHEN n_nationkey % 11 = 5 THEN NULL
              ELSE 20000 + n_nationkey * 6000 END AS income
  FROM nation
)
"""


@register("enrich_area", "WITH x AS (SELECT 1)" + LOOKUP_SQL + """
SELECT c.c_custkey, c.c_nationkey, l.ntaname, l.income
FROM customer c JOIN lookup l ON CAST(c.c_nationkey AS VARCHAR) = l.ntacode
WHERE l.income IS NOT NULL AND l.income <> -1
""")
def q_enrich_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8: customers joined to the area lookup; -1 and NULL incomes dropped."""
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", F.col("c_nationkey").cast("string").alias("ntacode"))
    out = enrich_area(cust, income_lookup(spark, sf_dir), "ntacode", value_col="income")
    return out.select("c_custkey", "c_nationkey", "ntaname", "income")


@register("area_dimension", """
SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS ntacode, n_name AS ntaname FROM nation
""")
def q_area_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9: distinct (code, name) pairs of the area features."""
    return area_dimension(area_features(spark, sf_dir))


@register("located_income_trend", LOCATED_SQL + LOOKUP_SQL + """
, banded AS (
  SELECT p.l_shipdate,
         CASE WHEN l.income BETWEEN 0 AND 41000 THEN 'Low Income'
              WHEN l.income BETWEEN 41001 AND 72000 THEN 'Mid Income'
              WHEN l.income BETWEEN 72001 AND 123000 THEN 'Mid-High Income'
              WHEN l.income > 123001 THEN 'High Income' END AS band
  FROM located p JOIN lookup l ON p.ntacode = l.ntacode
  WHERE l.income IS NOT NULL AND l.income <> -1
), m AS (
  SELECT band, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS cnt
  FROM banded WHERE band IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY 1, 2
)
SELECT band, month, cnt,
       round(CASE WHEN count(cnt) OVER w = 12 THEN avg(cnt) OVER w END, 6) AS ma12
FROM m WINDOW w AS (PARTITION BY band ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)
""")
def q_located_income_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7 → Q8 → Q10: locate points, attach area income, monthly trend per income band."""
    located = located_points(spark, sf_dir)
    enriched = enrich_area(located, income_lookup(spark, sf_dir), "ntacode", value_col="income")
    return rounded(band_trend(enriched, "l_shipdate", "income", INCOME_BANDS))


@register("located_change_by_month", LOCATED_SQL + LOOKUP_SQL + """
, banded AS (
  SELECT p.l_shipdate,
         CASE WHEN l.income BETWEEN 0 AND 41000 THEN 'Low Income'
              WHEN l.income BETWEEN 41001 AND 72000 THEN 'Mid Income'
              WHEN l.income BETWEEN 72001 AND 123000 THEN 'Mid-High Income'
              WHEN l.income > 123001 THEN 'High Income' END AS band
  FROM located p JOIN lookup l ON p.ntacode = l.ntacode
  WHERE l.income IS NOT NULL AND l.income <> -1
), m AS (
  SELECT band, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS cnt
  FROM banded WHERE band IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY 1, 2
), labels AS (
  SELECT * FROM (VALUES ('Low Income'), ('Mid Income'), ('Mid-High Income'), ('High Income')) v(band)
), a AS (
  SELECT band, CAST(month(month) AS INTEGER) AS month_no,
         avg(CASE WHEN month < DATE '1996-04-01' THEN cnt END) AS b,
         avg(CASE WHEN month >= DATE '1996-04-01' THEN cnt END) AS af
  FROM m GROUP BY 1, 2
), g AS (
  SELECT CAST(r.month_no AS INTEGER) AS month_no, l.band,
         coalesce(a.b, 0.0) AS before_avg, coalesce(a.af, 0.0) AS after_avg
  FROM labels l CROSS JOIN range(1, 13) r(month_no)
  LEFT JOIN a ON a.band = l.band AND a.month_no = r.month_no
)
SELECT month_no, strftime(make_date(2000, month_no, 1), '%b') AS month_name, band,
       round(before_avg, 6) AS before_avg, round(after_avg, 6) AS after_avg,
       round(CASE WHEN before_avg <> 0 THEN (after_avg - before_avg) / before_avg * 100 ELSE 0.0 END, 6)
         AS change_pct
FROM g
""")
def q_located_change_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7 → Q8 → Q10 → Q12: the whole located pipeline ending in the month × band change."""
    from datetime import date
    from blotter.operators.compare import before_after_by_month
    located = located_points(spark, sf_dir)
    enriched = enrich_area(located, income_lookup(spark, sf_dir), "ntacode", value_col="income")
    bands = band_trend(enriched, "l_shipdate", "income", INCOME_BANDS)
    return rounded(before_after_by_month(bands, date(1996, 4, 1),
                                         labels=[b.label for b in INCOME_BANDS]))
