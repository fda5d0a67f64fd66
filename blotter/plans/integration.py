"""Integration and profile queries on the driver tables.

Two incident sources are cut from ``orders`` so that they overlap: the
historic one holds orders before 2000-01-01, the current one orders from
1999-07-01 with dates moved one day later, so which duplicate survives is
visible.  Dates are rendered as ``M/d/yyyy`` text; the start date is NULL for
one key in 50 and the text ``null`` for another one in 50, so the end-date
fallback is exercised on both.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators.integrate import (
    IncidentSource, IntegrateSpec, dedup_first, integrate_incidents, union_before_dedup)
from blotter.functions.categorical import UNKNOWN_TEXTS, yes_no_flag
from blotter.operators.profile import (
    date_range, distinct_values, duplicate_keys, null_code_pairs, null_counts)
from blotter.plans.catalog import register, table

SPLIT_HISTORIC = date(2000, 1, 1)
CURRENT_FROM = date(1999, 7, 1)
CUT = date(1996, 1, 1)


def _as_text_source(orders: DataFrame, shift_days: int) -> DataFrame:
    d = F.date_add(F.col("o_orderdate").cast("date"), shift_days)
    start = (F.when(F.col("o_orderkey") % 50 == 0, F.lit(None).cast("string"))
             .when(F.col("o_orderkey") % 50 == 25, F.lit("null"))
             .otherwise(F.date_format(d, "M/d/yyyy")))
    return orders.select(
        "o_orderkey",
        start.alias("start_txt"),
        F.date_format(F.date_add(d, 2), "M/d/yyyy").alias("end_txt"),
        "o_orderstatus", "o_orderpriority", "o_custkey")


def text_sources(spark: SparkSession, sf_dir: str) -> list[IncidentSource]:
    orders = table(spark, sf_dir, "orders")
    hist = orders.where(F.col("o_orderdate") < F.lit(SPLIT_HISTORIC))
    curr = orders.where(F.col("o_orderdate") >= F.lit(CURRENT_FROM))
    return [IncidentSource(_as_text_source(hist, 0), "historic", priority=0),
            IncidentSource(_as_text_source(curr, 1), "current", priority=1)]


SPEC = IntegrateSpec(
    key="o_orderkey", start_date="start_txt", end_date="end_txt", date_pattern="M/d/yyyy",
    columns=["o_orderstatus", "o_orderpriority", "o_custkey"],
    date_col="incident_date", min_date=CUT, label_col="year_month", label_padded=False)

TEXT_SOURCES_SQL = """
WITH h AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 50 = 25 THEN 'null'
              ELSE strftime(CAST(o_orderdate AS DATE), '%-m/%-d/%Y') END AS start_txt,
         strftime(CAST(o_orderdate AS DATE) + 2, '%-m/%-d/%Y') AS end_txt,
         o_orderstatus, o_orderpriority, o_custkey, 0 AS prio, 'historic' AS source
  FROM orders WHERE o_orderdate < DATE '2000-01-01'
), c AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 50 = 25 THEN 'null'
              ELSE strftime(CAST(o_orderdate AS DATE) + 1, '%-m/%-d/%Y') END AS start_txt,
         strftime(CAST(o_orderdate AS DATE) + 3, '%-m/%-d/%Y') AS end_txt,
         o_orderstatus, o_orderpriority, o_custkey, 1 AS prio, 'current' AS source
  FROM orders WHERE o_orderdate >= DATE '1999-07-01'
), u AS (
  SELECT *, coalesce(
           CAST(try_strptime(CASE WHEN trim(start_txt) IN ('null', '') THEN NULL ELSE start_txt END,
                             '%m/%d/%Y') AS DATE),
           CAST(try_strptime(CASE WHEN trim(end_txt) IN ('null', '') THEN NULL ELSE end_txt END,
                             '%m/%d/%Y') AS DATE)) AS incident_date
  FROM (SELECT * FROM h UNION ALL SELECT * FROM c)
)
"""


@register("integrate", TEXT_SOURCES_SQL + """
, r AS (
  SELECT *, row_number() OVER (
      PARTITION BY o_orderkey
      ORDER BY prio, incident_date NULLS FIRST, start_txt NULLS FIRST, end_txt NULLS FIRST,
               o_orderstatus NULLS FIRST, o_orderpriority NULLS FIRST, o_custkey NULLS FIRST,
               source NULLS FIRST) AS rn
  FROM u
)
SELECT o_orderkey, start_txt, end_txt, o_orderstatus, o_orderpriority, o_custkey,
       incident_date, source,
       CAST(year(incident_date) AS VARCHAR) || '-' || CAST(month(incident_date) AS VARCHAR) AS year_month
FROM r WHERE rn = 1 AND incident_date IS NOT NULL AND incident_date >= DATE '1996-01-01'
""")
def q_integrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: union, dedup (historic first), date fallback, cut at 1996-01-01."""
    return integrate_incidents(text_sources(spark, sf_dir), SPEC)


def _bounded_sources(spark: SparkSession, sf_dir: str) -> list[IncidentSource]:
    """Second shape of Q1: upper-case names in one source, a Y/N flag in one and
    a boolean in the other, a per-source bound on the historic source only,
    and the current source winning ties."""
    orders = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    hist = orders.where(F.col("o_orderdate") < F.lit(SPLIT_HISTORIC)).select(
        "o_orderkey", F.date_format(d, "M/d/yyyy").alias("occur_txt"),
        F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
        .alias("flag"),
        "o_orderpriority", F.lit(0.0).alias("x_coord"))
    curr = orders.where(F.col("o_orderdate") >= F.lit(CURRENT_FROM)).select(
        F.col("o_orderkey").alias("O_ORDERKEY"),
        F.date_format(F.date_add(d, 1), "M/d/yyyy").alias("OCCUR_TXT"),
        F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", "N")
        .otherwise(F.col("o_orderstatus")).alias("FLAG"),
        F.col("o_orderpriority").alias("O_ORDERPRIORITY"),
        F.lit("x").alias("LOC_DESC")).withColumnRenamed("FLAG", "STATUS_FLAG")
    return [
        IncidentSource(curr, "current", priority=0, lower_names=True, drop=["loc_desc"],
                       rename={"status_flag": "flag"}, yes_no=["flag"]),
        IncidentSource(hist, "historic", priority=1, drop=["x_coord"],
                       date_bound=(date(1996, 1, 1), date(1999, 12, 31))),
    ]


BOUNDED_SPEC = IntegrateSpec(key="o_orderkey", start_date="occur_txt", date_pattern="M/d/yyyy",
                             date_col="occur_date")


@register("integrate_bounded", """
WITH c AS (
  SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + 1, '%-m/%-d/%Y') AS occur_txt,
         CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS flag,
         o_orderpriority, 0 AS prio, 'current' AS source
  FROM orders WHERE o_orderdate >= DATE '1999-07-01'
), h AS (
  SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%-m/%-d/%Y') AS occur_txt,
         CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS flag,
         o_orderpriority, 1 AS prio, 'historic' AS source
  FROM orders WHERE o_orderdate < DATE '2000-01-01'
), u AS (
  SELECT *, CAST(try_strptime(occur_txt, '%m/%d/%Y') AS DATE) AS occur_date FROM c
  UNION ALL
  SELECT * FROM (SELECT *, CAST(try_strptime(occur_txt, '%m/%d/%Y') AS DATE) AS occur_date FROM h)
  WHERE occur_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
), r AS (
  SELECT *, row_number() OVER (
      PARTITION BY o_orderkey
      ORDER BY prio, occur_date NULLS FIRST, occur_txt NULLS FIRST, flag NULLS FIRST,
               o_orderpriority NULLS FIRST, source NULLS FIRST) AS rn
  FROM u
)
SELECT o_orderkey, occur_txt, flag, o_orderpriority, occur_date, source
FROM r WHERE rn = 1 AND occur_date IS NOT NULL
""")
def q_integrate_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1, second shape: name conforming, Y/N flags, a per-source bound before union."""
    return integrate_incidents(_bounded_sources(spark, sf_dir), BOUNDED_SPEC)


@register("flag_clean", """
SELECT l_orderkey, l_linenumber,
       CASE (CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'N' ELSE l_returnflag END)
            WHEN 'Y' THEN true WHEN 'N' THEN false END AS returned,
       CASE (CASE l_linestatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' ELSE '?' END)
            WHEN 'Y' THEN true WHEN 'N' THEN false END AS closed
FROM lineitem
""")
def q_flag_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Y/N text to boolean, any other text NULL.  Return flags R → Y,
    A → N, N kept (so false); line status F → Y, O → N, else ``?`` (NULL)."""
    li = table(spark, sf_dir, "lineitem")
    rf = (F.when(F.col("l_returnflag") == "R", "Y").when(F.col("l_returnflag") == "A", "N")
          .otherwise(F.col("l_returnflag")))
    ls = (F.when(F.col("l_linestatus") == "F", "Y").when(F.col("l_linestatus") == "O", "N")
          .otherwise(F.lit("?")))
    return li.select("l_orderkey", "l_linenumber", yes_no_flag(rf).alias("returned"),
                     yes_no_flag(ls).alias("closed"))


def _union_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_before_dedup(text_sources(spark, sf_dir), SPEC)


UNION_SQL = TEXT_SOURCES_SQL + " SELECT * EXCLUDE (prio) FROM u "


@register("null_profile", f"""
WITH t AS ({UNION_SQL})
SELECT column_name AS "column", null_count, row_count FROM (
  SELECT 'o_orderkey' AS column_name, count(*) FILTER (WHERE o_orderkey IS NULL) AS null_count, count(*) AS row_count FROM t
  UNION ALL SELECT 'start_txt', count(*) FILTER (WHERE start_txt IS NULL), count(*) FROM t
  UNION ALL SELECT 'end_txt', count(*) FILTER (WHERE end_txt IS NULL), count(*) FROM t
  UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL), count(*) FROM t
  UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL), count(*) FROM t
  UNION ALL SELECT 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL), count(*) FROM t
  UNION ALL SELECT 'incident_date', count(*) FILTER (WHERE incident_date IS NULL), count(*) FROM t
  UNION ALL SELECT 'source', count(*) FILTER (WHERE source IS NULL), count(*) FROM t
)
""")
def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: NULLs per column of the union before dedup."""
    return null_counts(_union_input(spark, sf_dir))


@register("dup_keys", f"""
WITH t AS ({UNION_SQL})
SELECT o_orderkey, count(*) AS n FROM t GROUP BY o_orderkey HAVING count(*) > 1
""")
def q_dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate keys of the union and their counts."""
    return duplicate_keys(_union_input(spark, sf_dir), "o_orderkey")


@register("dup_keys_after", f"""
WITH t AS ({UNION_SQL})
SELECT count(*) AS rows_before, count(DISTINCT o_orderkey) + max(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END)
         AS rows_after, 0 AS duplicates_left
FROM t
""")
def q_dup_keys_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 around dedup: rows before, rows after (one per key), and duplicate keys left."""
    union = _union_input(spark, sf_dir)
    kept = dedup_first(union, "o_orderkey", ["incident_date"]).groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n"))
    after = kept.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_after"),
                     F.count_if(F.col("n") > 1).cast("int").alias("duplicates_left"))
    return after.withColumn("rows_before", union.agg(F.count(F.lit(1))).scalar())


@register("distinct_values", f"""
WITH t AS ({UNION_SQL})
SELECT "column", value, count(*) AS n FROM (
  SELECT 'o_orderstatus' AS "column", o_orderstatus AS value FROM t
  UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM t
  UNION ALL SELECT 'source', source FROM t
) GROUP BY 1, 2
""")
def q_distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values (with counts) of the categorical columns."""
    return distinct_values(_union_input(spark, sf_dir),
                           ["o_orderstatus", "o_orderpriority", "source"])


@register("date_range", f"""
WITH t AS ({UNION_SQL})
SELECT min(incident_date) AS min_date, max(incident_date) AS max_date,
       count(*) FILTER (WHERE incident_date IS NULL) AS null_dates, count(*) AS row_count
FROM t
""")
def q_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: smallest and largest incident date and NULL dates of the union."""
    return date_range(_union_input(spark, sf_dir), "incident_date")


@register("null_code_pairs", f"""
WITH t AS ({UNION_SQL})
SELECT DISTINCT o_orderpriority, start_txt FROM t WHERE start_txt IS NULL OR start_txt IN ('(null)', 'UNKNOWN')
""")
def q_null_code_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (code, text) pairs where the text is missing."""
    return null_code_pairs(_union_input(spark, sf_dir), "o_orderpriority", "start_txt", UNKNOWN_TEXTS)


@register("top_dup_keys", f"""
WITH t AS ({UNION_SQL})
SELECT o_orderkey, count(*) AS n FROM t GROUP BY o_orderkey HAVING count(*) > 1
ORDER BY n DESC, o_orderkey ASC LIMIT 20
""")
def q_top_dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2/O3: the 20 most duplicated keys (a preview: the limit is the feature)."""
    return duplicate_keys(_union_input(spark, sf_dir), "o_orderkey", top=20)



@register("integrated_trend", TEXT_SOURCES_SQL + """
, r AS (
  SELECT *, row_number() OVER (
      PARTITION BY o_orderkey
      ORDER BY prio, incident_date NULLS FIRST, start_txt NULLS FIRST, end_txt NULLS FIRST,
               o_orderstatus NULLS FIRST, o_orderpriority NULLS FIRST, o_custkey NULLS FIRST,
               source NULLS FIRST) AS rn
  FROM u
), cur AS (
  SELECT * FROM r WHERE rn = 1 AND incident_date IS NOT NULL AND incident_date >= DATE '1996-01-01'
), m AS (
  SELECT CAST(date_trunc('month', incident_date) AS DATE) AS month,
         CAST(year(incident_date) AS VARCHAR) || '-' || CAST(month(incident_date) AS VARCHAR) AS year_month,
         count(*) AS cnt
  FROM cur GROUP BY 1, 2
)
SELECT month, year_month, cnt,
       round(CASE WHEN count(cnt) OVER w12 = 12 THEN avg(cnt) OVER w12 END, 6) AS ma12,
       lag(cnt, 12) OVER w AS prev12
FROM m
WINDOW w AS (ORDER BY month), w12 AS (ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)
""")
def q_integrated_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 → Q2: the curated table feeds the monthly trend (month key, text label kept)."""
    from blotter.functions.dates import month_label
    from blotter.operators.trend import monthly_trend
    from blotter.plans.catalog import rounded
    cur = integrate_incidents(text_sources(spark, sf_dir), SPEC)
    t = monthly_trend(cur, "incident_date")
    return rounded(t.select("month", month_label("month", padded=False).alias("year_month"),
                            "cnt", "ma12", "prev12"))


@register("numeric_profile", """
SELECT 'o_totalprice' AS "column", count(o_totalprice) AS n, count(*) - count(o_totalprice) AS nulls,
       round(min(o_totalprice), 6) AS min, round(max(o_totalprice), 6) AS max,
       1000.0::DOUBLE AS low_fence, 400000.0::DOUBLE AS high_fence,
       count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000) AS beyond
FROM orders
""")
def q_numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 numeric check: exact range, NULLs and values beyond given fences, one scan."""
    from blotter.operators.profile import numeric_range
    from blotter.plans.catalog import rounded
    return rounded(numeric_range(table(spark, sf_dir, "orders"), {"o_totalprice": (1000.0, 400000.0)}))


@register("numeric_outliers", """
WITH v AS (
  SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS "column",
         unnest([l_quantity::DOUBLE, l_extendedprice::DOUBLE, l_discount::DOUBLE]) AS x FROM lineitem
), q AS (
  SELECT "column", count(x) AS n, count(*) - count(x) AS nulls, min(x) AS min, max(x) AS max,
         quantile_disc(x, 0.25) AS q1, quantile_disc(x, 0.5) AS median, quantile_disc(x, 0.75) AS q3
  FROM v GROUP BY 1
), f AS (SELECT *, q1 - 0.5 * (q3 - q1) AS low_fence, q3 + 0.5 * (q3 - q1) AS high_fence FROM q)
SELECT f."column", n, nulls, round(min, 6) AS min, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(max, 6) AS max, round(low_fence, 6) AS low_fence, round(high_fence, 6) AS high_fence,
       count(*) FILTER (WHERE x < low_fence OR x > high_fence) AS beyond
FROM f JOIN v ON v."column" = f."column" GROUP BY ALL
""")
def q_numeric_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 (D27): exact quartiles, fences half their distance beyond, values outside."""
    from blotter.operators.profile import numeric_outliers
    from blotter.plans.catalog import rounded
    return rounded(numeric_outliers(table(spark, sf_dir, "lineitem"),
                                    ["l_quantity", "l_extendedprice", "l_discount"], reach=0.5))


@register("iso_dates", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
""")
def q_iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO date text back to a date."""
    from blotter.functions.dates import as_date
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select("o_orderkey", as_date(text).alias("day"))


@register("dedup_hot_key", """
WITH t AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS k,
         CAST(l_shipdate AS DATE) AS ship, l_linenumber, l_partkey, l_quantity, l_returnflag
  FROM lineitem
), r AS (
  SELECT *, row_number() OVER (
      PARTITION BY k ORDER BY ship NULLS FIRST, l_linenumber NULLS FIRST, l_partkey NULLS FIRST,
                              l_quantity NULLS FIRST, l_returnflag NULLS FIRST) AS rn
  FROM t
)
SELECT k, ship, l_linenumber, l_partkey, l_quantity, l_returnflag FROM r WHERE rn = 1
""")
def q_dedup_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 under skew: every line item kept in the input, a third of them sharing
    one key; the first per key by ship date, then every other column.  Each
    task reduces the hot key to one row before the shuffle."""
    li = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("l_orderkey")).alias("k"),
        F.col("l_shipdate").cast("date").alias("ship"),
        "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    return dedup_first(li, "k", ["ship"])
