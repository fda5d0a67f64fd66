"""Band and before/after queries on the driver tables (Q10-Q12).

Incidents are orders; the band value is the customer's account balance,
banded like incomes are: closed ranges 0-2000, 2001-5000, 5001-8000 and
strictly above 8001, so negative balances, fractional values between bands
and 8001 itself land in no band.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.categorical import Band
from blotter.operators.compare import before_after, before_after_by_month, change_matrix
from blotter.operators.trend import band_trend
from blotter.plans.catalog import register, rounded, table
from blotter.plans.trends import incidents

BALANCE_BANDS = (
    Band("low", 0, 2000),
    Band("mid", 2001, 5000),
    Band("mid_high", 5001, 8000),
    Band("high", 8001, None, low_inclusive=False),
)
LABELS = [b.label for b in BALANCE_BANDS]
SPLIT = date(1998, 4, 1)


def balance_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return incidents(spark, sf_dir).join(cust, F.col("o_custkey") == F.col("c_custkey"), "inner")


def balance_band_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return band_trend(balance_incidents(spark, sf_dir), "o_orderdate", "c_acctbal", BALANCE_BANDS)


BAND_SQL = """
WITH j AS (
  SELECT CAST(o.o_orderdate AS DATE) AS d,
         CASE WHEN c.c_acctbal BETWEEN 0 AND 2000 THEN 'low'
              WHEN c.c_acctbal BETWEEN 2001 AND 5000 THEN 'mid'
              WHEN c.c_acctbal BETWEEN 5001 AND 8000 THEN 'mid_high'
              WHEN c.c_acctbal > 8001 THEN 'high' END AS band
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
), m AS (
  SELECT band, CAST(date_trunc('month', d) AS DATE) AS month, count(*) AS cnt
  FROM j WHERE band IS NOT NULL AND d IS NOT NULL GROUP BY 1, 2
)
"""


@register("band_trend", BAND_SQL + """
SELECT band, month, cnt,
       round(CASE WHEN count(cnt) OVER w = 12 THEN avg(cnt) OVER w END, 6) AS ma12
FROM m WINDOW w AS (PARTITION BY band ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)
""")
def q_band_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10: monthly counts and 12-month mean per balance band, one pass for all bands."""
    return rounded(balance_band_trend(spark, sf_dir))


@register("before_after", BAND_SQL + """
, labels AS (SELECT * FROM (VALUES ('low'), ('mid'), ('mid_high'), ('high')) v(band))
, a AS (
  SELECT band, avg(CASE WHEN month < DATE '1998-04-01' THEN cnt END) AS before_avg,
         avg(CASE WHEN month >= DATE '1998-04-01' THEN cnt END) AS after_avg
  FROM m GROUP BY band
)
SELECT l.band, round(a.before_avg, 6) AS before_avg, round(a.after_avg, 6) AS after_avg,
       round((a.after_avg - a.before_avg) / nullif(a.before_avg, 0) * 100, 6) AS change_pct
FROM labels l LEFT JOIN a ON a.band = l.band
""")
def q_before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11: mean monthly count per band before and after the split, and the change."""
    return rounded(before_after(balance_band_trend(spark, sf_dir), SPLIT, labels=LABELS))


BY_MONTH_SQL = BAND_SQL + """
, labels AS (SELECT * FROM (VALUES ('low'), ('mid'), ('mid_high'), ('high')) v(band))
, moy AS (SELECT * FROM range(1, 13) r(month_no))
, a AS (
  SELECT band, CAST(month(month) AS INTEGER) AS month_no,
         avg(CASE WHEN month < DATE '1998-04-01' THEN cnt END) AS b,
         avg(CASE WHEN month >= DATE '1998-04-01' THEN cnt END) AS af
  FROM m GROUP BY 1, 2
), g AS (
  SELECT CAST(moy.month_no AS INTEGER) AS month_no, l.band,
         coalesce(a.b, 0.0) AS before_avg, coalesce(a.af, 0.0) AS after_avg
  FROM labels l CROSS JOIN moy
  LEFT JOIN a ON a.band = l.band AND a.month_no = moy.month_no
), c AS (
  SELECT month_no, strftime(make_date(2000, month_no, 1), '%b') AS month_name, band,
         before_avg, after_avg,
         CASE WHEN before_avg <> 0 THEN (after_avg - before_avg) / before_avg * 100 ELSE 0.0 END
           AS change_pct
  FROM g
)
"""


@register("before_after_by_month", BY_MONTH_SQL + """
SELECT month_no, month_name, band, round(before_avg, 6) AS before_avg,
       round(after_avg, 6) AS after_avg, round(change_pct, 6) AS change_pct
FROM c
""")
def q_before_after_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12: 12 months × 4 bands; missing means are 0 and a zero base gives 0 %."""
    return rounded(before_after_by_month(balance_band_trend(spark, sf_dir), SPLIT,
                                         labels=LABELS))


@register("change_matrix_wide", BY_MONTH_SQL + """
SELECT month_no, month_name,
       round(max(CASE WHEN band = 'low' THEN change_pct END), 6) AS low,
       round(max(CASE WHEN band = 'mid' THEN change_pct END), 6) AS mid,
       round(max(CASE WHEN band = 'mid_high' THEN change_pct END), 6) AS mid_high
FROM c GROUP BY month_no, month_name
""")
def q_change_matrix_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month × band matrix of changes, high band left out, Jan … Dec."""
    return rounded(change_matrix(balance_band_trend(spark, sf_dir), ["low", "mid", "mid_high"], SPLIT))


@register("change_matrix_long", BY_MONTH_SQL + """
SELECT month_no, month_name, band, round(change_pct, 6) AS change_pct FROM c WHERE band <> 'high'
""")
def q_change_matrix_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: the wide matrix melted back to (month, band, change)."""
    from blotter.operators.compare import unpivot_matrix
    wide = change_matrix(balance_band_trend(spark, sf_dir), ["low", "mid", "mid_high"], SPLIT)
    return rounded(unpivot_matrix(wide, ["month_no", "month_name"]))
