"""Trend queries on the driver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators.trend import (
    category_group_trend, group_share, level_endpoints, level_trend, level_wide,
    monthly_counts, monthly_trend, with_place)
from blotter.plans.catalog import register, rounded, table


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` read as incidents: only the columns the trend queries use."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("o_orderdate"))


MONTHLY_SQL = """
WITH m AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS cnt
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1
), s AS (
  SELECT month, cnt,
         CASE WHEN count(cnt) OVER w12 = 12 THEN avg(cnt) OVER w12 END AS ma12,
         lag(cnt, 12) OVER w AS prev12
  FROM m
  WINDOW w AS (ORDER BY month),
         w12 AS (ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)
), g AS (
  SELECT *, (cnt - prev12) / nullif(prev12, 0) * 100 AS growth_pct FROM s
)
SELECT month, cnt, round(ma12, 6) AS ma12, prev12, round(growth_pct, 6) AS growth_pct,
       CASE WHEN growth_pct IS NULL THEN NULL
            WHEN growth_pct >= {b} THEN 'surge'
            WHEN growth_pct <= -{b} THEN 'drop'
            WHEN abs(growth_pct) >= {a} THEN 'moderate'
            ELSE 'steady' END AS class,
       month BETWEEN DATE '{p0}' AND DATE '{p1}' AS in_period
FROM g
"""


@register("monthly_trend", MONTHLY_SQL.format(a=10.0, b=20.0, p0="2020-03-01", p1="2022-12-01"))
def q_monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 with the reference defaults (thresholds 10/20, period 2020-03…2022-12)."""
    return rounded(monthly_trend(incidents(spark, sf_dir), "o_orderdate"))


@register("growth_class", """
WITH t AS ({inner})
SELECT month, growth_pct, class, in_period FROM t
""".format(inner=MONTHLY_SQL.format(a=10.0, b=20.0, p0="1998-03-01", p1="2000-12-01")))
def q_growth_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5/W6 with thresholds 10/20 and a period that falls inside the data."""
    t = monthly_trend(incidents(spark, sf_dir), "o_orderdate", moderate=10.0, surge=20.0,
                      period=(date(1998, 3, 1), date(2000, 12, 1)))
    return rounded(t.select("month", "growth_pct", "class", "in_period"))


@register("monthly_trend_by", """
WITH m AS (
  SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS cnt
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2
), s AS (
  SELECT o_orderpriority, month, cnt,
         CASE WHEN count(cnt) OVER w12 = 12 THEN avg(cnt) OVER w12 END AS ma12,
         lag(cnt, 12) OVER w AS prev12
  FROM m
  WINDOW w AS (PARTITION BY o_orderpriority ORDER BY month),
         w12 AS (PARTITION BY o_orderpriority ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)
), g AS (SELECT *, (cnt - prev12) / nullif(prev12, 0) * 100 AS growth_pct FROM s)
SELECT o_orderpriority, month, cnt, round(ma12, 6) AS ma12, prev12,
       round(growth_pct, 6) AS growth_pct,
       CASE WHEN growth_pct IS NULL THEN NULL WHEN growth_pct >= 20.0 THEN 'surge'
            WHEN growth_pct <= -20.0 THEN 'drop' WHEN abs(growth_pct) >= 10.0 THEN 'moderate'
            ELSE 'steady' END AS class,
       month BETWEEN DATE '2020-03-01' AND DATE '2022-12-01' AS in_period
FROM g
""")
def q_monthly_trend_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 with ``by``: one series per priority, computed in one pass."""
    return rounded(monthly_trend(incidents(spark, sf_dir), "o_orderdate", by=["o_orderpriority"]))


LEVEL_BASE_SQL = """
WITH base AS (
  SELECT CAST(o_orderdate AS DATE) AS d, o_orderstatus AS level FROM orders
), counts AS (
  SELECT CAST(date_trunc('month', d) AS DATE) AS month, level, count(*) AS cnt
  FROM base WHERE d IS NOT NULL AND level IS NOT NULL GROUP BY 1, 2
), grid AS (
  SELECT m.month, l.level, c.cnt
  FROM (SELECT DISTINCT month FROM counts) m
  CROSS JOIN (SELECT DISTINCT level FROM counts) l
  LEFT JOIN counts c ON c.month = m.month AND c.level = l.level
), trend AS (
  SELECT month, level, cnt,
         CASE WHEN count(cnt) OVER w = 12 THEN avg(cnt) OVER w END AS ma12
  FROM grid
  WINDOW w AS (PARTITION BY level ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)
)
"""


@register("level_trend", LEVEL_BASE_SQL + "SELECT month, level, cnt, round(ma12, 6) AS ma12 FROM trend")
def q_level_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: dense month × level grid."""
    return rounded(level_trend(incidents(spark, sf_dir), "o_orderdate", "o_orderstatus"))


@register("level_wide", LEVEL_BASE_SQL + """
SELECT month,
       max(CASE WHEN level = 'F' THEN cnt END) AS "F",
       max(CASE WHEN level = 'O' THEN cnt END) AS "O",
       max(CASE WHEN level = 'P' THEN cnt END) AS "P"
FROM grid GROUP BY month
""")
def q_level_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same grid, one column per level."""
    return level_wide(incidents(spark, sf_dir), "o_orderdate", "o_orderstatus",
                      levels=["F", "O", "P"])


@register("level_subset", LEVEL_BASE_SQL + "SELECT month, level, cnt, round(ma12, 6) AS ma12 FROM trend WHERE level = 'F'")
def q_level_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 for one listed level: its months are still those of all levels."""
    return rounded(level_trend(incidents(spark, sf_dir), "o_orderdate", "o_orderstatus", levels=["F"]))


@register("ordered_counts", """
WITH c AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS category, count(*) AS cnt
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2
)
SELECT month, category, cnt, row_number() OVER (ORDER BY month, category NULLS FIRST) AS place,
       row_number() OVER (ORDER BY cnt DESC, month, category NULLS FIRST) AS place_by_count FROM c
""")
def q_ordered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1, O2: counts by month and category with their place in calendar order and by falling count."""
    counts = monthly_counts(incidents(spark, sf_dir), "o_orderdate", by=["o_orderpriority"])
    counts = counts.withColumnRenamed("o_orderpriority", "category").select("month", "category", "cnt")
    return with_place(with_place(counts, "place", "month", "category"),
                      "place_by_count", F.desc("cnt"), "month", "category")


@register("level_endpoints", LEVEL_BASE_SQL + """
, ranked AS (
  SELECT level, ma12,
         row_number() OVER (PARTITION BY level ORDER BY month) AS rn,
         row_number() OVER (PARTITION BY level ORDER BY month DESC) AS rd
  FROM trend
)
SELECT level, round(max(CASE WHEN rn = 12 THEN ma12 END), 6) AS ma_row12,
       round(max(CASE WHEN rd = 1 THEN ma12 END), 6) AS ma_last
FROM ranked GROUP BY level
""")
def q_level_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: first complete and last moving average per level, by position."""
    t = level_trend(incidents(spark, sf_dir), "o_orderdate", "o_orderstatus",
                    levels=["F", "O", "P"])
    return rounded(level_endpoints(t))


# Category groups over the order priorities (the reference groups offence types).
PRIORITY_GROUPS = {
    "urgent": ["1-URGENT", "2-HIGH"],
    "medium": ["3-MEDIUM"],
    "low": ["4-NOT SPECIFIED", "5-LOW"],
}


@register("category_group_trend", """
WITH t AS (
  SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'urgent'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'medium'
              WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 'low' END AS grp,
         CAST(o_orderdate AS DATE) AS d
  FROM orders
  WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ('(null)', 'UNKNOWN')
), m AS (
  SELECT grp, CAST(date_trunc('month', d) AS DATE) AS month, count(*) AS cnt
  FROM t WHERE grp IS NOT NULL AND d IS NOT NULL GROUP BY 1, 2
), s AS (
  SELECT grp, month, cnt,
         CASE WHEN count(cnt) OVER w12 = 12 THEN avg(cnt) OVER w12 END AS ma12,
         lag(cnt, 12) OVER w AS prev12
  FROM m
  WINDOW w AS (PARTITION BY grp ORDER BY month),
         w12 AS (PARTITION BY grp ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)
), g AS (SELECT *, (cnt - prev12) / nullif(prev12, 0) * 100 AS growth_pct FROM s)
SELECT grp, month, cnt, round(ma12, 6) AS ma12, prev12, round(growth_pct, 6) AS growth_pct,
       CASE WHEN growth_pct IS NULL THEN NULL WHEN growth_pct >= 20.0 THEN 'surge'
            WHEN growth_pct <= -20.0 THEN 'drop' WHEN abs(growth_pct) >= 10.0 THEN 'moderate'
            ELSE 'steady' END AS class,
       month BETWEEN DATE '2020-03-01' AND DATE '2022-12-01' AS in_period
FROM g
""")
def q_category_group_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: priorities rolled into three groups, one trend per group, one pass."""
    return rounded(category_group_trend(incidents(spark, sf_dir), "o_orderdate",
                                        "o_orderpriority", PRIORITY_GROUPS))


def segment_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents with a victim-group-like column: the customer's segment, where
    AUTOMOBILE reads as NULL and HOUSEHOLD as the text ``(null)``."""
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None).cast("string"))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("(null)"))
        .otherwise(F.col("c_mktsegment")).alias("segment"))
    return incidents(spark, sf_dir).join(cust, F.col("o_custkey") == F.col("c_custkey"), "inner")


@register("group_share", """
WITH j AS (
  SELECT CAST(o.o_orderdate AS DATE) AS d,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN NULL WHEN 'HOUSEHOLD' THEN '(null)'
              ELSE c.c_mktsegment END AS segment
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
), m AS (
  SELECT CAST(date_trunc('month', d) AS DATE) AS month,
         count(*) FILTER (WHERE segment = 'BUILDING') AS part, count(*) AS total
  FROM j WHERE d IS NOT NULL AND segment IS NOT NULL AND segment NOT IN ('(null)', 'UNKNOWN')
  GROUP BY 1
), p AS (SELECT *, part / nullif(total, 0) * 100 AS percent FROM m WHERE part > 0)
SELECT month, part, total, round(percent, 6) AS percent,
       round(CASE WHEN count(percent) OVER w = 12 THEN avg(percent) OVER w END, 6) AS ma12
FROM p WINDOW w AS (ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)
""")
def q_group_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: monthly share of BUILDING among known segments, with its 12-month mean."""
    return rounded(group_share(segment_incidents(spark, sf_dir), "o_orderdate", "segment",
                               "BUILDING"))


@register("monthly_labels", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       strftime(CAST(date_trunc('month', o_orderdate) AS DATE), '%Y-%m') AS label_padded,
       CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(month(o_orderdate) AS VARCHAR) AS label_unpadded,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_again, count(*) AS cnt
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2, 3, 4
""")
def q_monthly_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 with C4/C7/C8/C9: month key with its padded and unpadded text labels, and the key
    read back from the unpadded one."""
    from blotter.functions.dates import month_from_label, month_label
    from blotter.operators.trend import monthly_counts
    m = monthly_counts(incidents(spark, sf_dir), "o_orderdate")
    return m.select("month", month_label("month", True).alias("label_padded"),
                    month_label("month", False).alias("label_unpadded"),
                    month_from_label(month_label("month", False)).alias("month_again"), "cnt")


@register("category_group_table", """
WITH g AS (
  SELECT DISTINCT o_orderpriority,
         CASE WHEN o_orderpriority < '3' THEN 'urgent' ELSE 'routine' END AS grp
  FROM orders WHERE o_orderpriority IS NOT NULL
), t AS (
  SELECT g.grp, CAST(o.o_orderdate AS DATE) AS d
  FROM orders o JOIN g ON o.o_orderpriority = g.o_orderpriority
  WHERE o.o_orderpriority NOT IN ('(null)', 'UNKNOWN')
), m AS (
  SELECT grp, CAST(date_trunc('month', d) AS DATE) AS month, count(*) AS cnt
  FROM t WHERE d IS NOT NULL GROUP BY 1, 2
), s AS (
  SELECT grp, month, cnt,
         CASE WHEN count(cnt) OVER w12 = 12 THEN avg(cnt) OVER w12 END AS ma12,
         lag(cnt, 12) OVER w AS prev12
  FROM m
  WINDOW w AS (PARTITION BY grp ORDER BY month),
         w12 AS (PARTITION BY grp ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)
), g2 AS (SELECT *, (cnt - prev12) / nullif(prev12, 0) * 100 AS growth_pct FROM s)
SELECT grp, month, cnt, round(ma12, 6) AS ma12, prev12, round(growth_pct, 6) AS growth_pct,
       CASE WHEN growth_pct IS NULL THEN NULL WHEN growth_pct >= 20.0 THEN 'surge'
            WHEN growth_pct <= -20.0 THEN 'drop' WHEN abs(growth_pct) >= 10.0 THEN 'moderate'
            ELSE 'steady' END AS class,
       month BETWEEN DATE '2020-03-01' AND DATE '2022-12-01' AS in_period
FROM g2
""")
def q_category_group_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 with the mapping given as a table derived from the data (joined)."""
    inc = incidents(spark, sf_dir)
    mapping = (inc.select("o_orderpriority").where(F.col("o_orderpriority").isNotNull()).distinct()
               .withColumn("grp", F.when(F.col("o_orderpriority") < "3", "urgent")
                           .otherwise("routine")))
    return rounded(category_group_trend(inc, "o_orderdate", "o_orderpriority", mapping))


@register("weighted_trend", MONTHLY_SQL.format(a=10.0, b=20.0, p0="2020-03-01", p1="2022-12-01"))
def q_weighted_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: the monthly trend of an already counted table (rows per day), by its count column."""
    days = incidents(spark, sf_dir).groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("n"))
    return rounded(monthly_trend(days, "o_orderdate", weight="n"))
