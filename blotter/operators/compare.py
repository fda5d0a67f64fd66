"""Before/after comparisons of monthly series (Q11, Q12; A7-A8, F11-F12, C12-C15, R1-R4, O4).

Inputs are monthly tables ``(series, month, cnt)`` such as
:func:`blotter.operators.trend.band_trend` or ``monthly_counts`` returns:
already reduced to a few hundred rows, so every step here is cheap.  Means
are over observed months only (no zero fill).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.dates import month_name
from blotter.functions.numeric import pct_change, pct_change_zero_guarded

# Fixed value: the split month of the reference comparison.
SPLIT_DEFAULT = date(2020, 4, 1)


def _with_labels(agg: DataFrame, series: str, labels: Sequence[str] | None) -> DataFrame:
    """Report exactly the labelled series, one without rows with NULL values.

    Filtered to the labels, the aggregate has at most ``len(labels)`` rows,
    so broadcasting it is bounded.
    """
    if labels is None:
        return agg
    spark = agg.sparkSession
    names = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in labels])).alias(series))
    known = agg.where(F.col(series).isin(*labels))
    return names.join(F.broadcast(known), series, "left")


def before_after(monthly: DataFrame, split: date = SPLIT_DEFAULT, series: str = "band",
                 value: str = "cnt", labels: Sequence[str] | None = None) -> DataFrame:
    """Q11: mean monthly value before ``split`` (``<``) and from it on (``>=``).

    With ``labels``, exactly those series are reported.

    ``change_pct`` = (after - before) / before * 100, NULL where a side has no
    months or the base is 0.
    """
    before = F.col("month") < F.lit(split)
    agg = monthly.groupBy(series).agg(
        F.avg(F.when(before, F.col(value))).alias("before_avg"),
        F.avg(F.when(~before, F.col(value))).alias("after_avg"))
    return (_with_labels(agg, series, labels)
            .withColumn("change_pct", pct_change("after_avg", "before_avg")))


def before_after_by_month(monthly: DataFrame, split: date = SPLIT_DEFAULT,
                          series: str = "band", value: str = "cnt",
                          labels: Sequence[str] | None = None) -> DataFrame:
    """Q12: the same comparison per month of year, as a long 12 × series table.

    Every series gets all 12 months.  A missing mean counts as 0, and the
    change is 0 where the base is 0, so a month seen before and never after
    gives -100 %.  One aggregation with a conditional mean per (month of
    year, side), then unpivoted; no grid join.
    """
    before = F.col("month") < F.lit(split)
    moy = F.month("month")
    aggs = []
    for k in range(1, 13):
        aggs.append(F.avg(F.when(before & (moy == k), F.col(value))).alias(f"_b{k}"))
        aggs.append(F.avg(F.when(~before & (moy == k), F.col(value))).alias(f"_a{k}"))
    wide = _with_labels(monthly.groupBy(series).agg(*aggs), series, labels)
    cells = F.array(*[F.struct(F.lit(k).alias("month_no"), F.col(f"_b{k}").alias("_b"),
                               F.col(f"_a{k}").alias("_a")) for k in range(1, 13)])
    long = wide.select(series, F.inline(cells))
    return long.select(
        "month_no", month_name("month_no").alias("month_name"), series,
        F.coalesce(F.col("_b"), F.lit(0.0)).alias("before_avg"),
        F.coalesce(F.col("_a"), F.lit(0.0)).alias("after_avg"),
        pct_change_zero_guarded("_a", "_b").alias("change_pct"))


def change_matrix(monthly: DataFrame, columns: Sequence[str], split: date = SPLIT_DEFAULT,
                  series: str = "band", value: str = "cnt") -> DataFrame:
    """Month of year (Jan … Dec) × one column of changes per listed series.

    The values are those of :func:`before_after_by_month`, straight from the
    monthly table: one aggregation by month of year with two conditional means
    per listed series.  Series not listed are left out.  Rows are in no order;
    a report sorts them by ``month_no``.
    """
    before = F.col("month") < F.lit(split)
    of = {c: F.col(series) == c for c in columns}
    means = [F.avg(F.when(of[c] & side, F.col(value))).alias(f"_{k}{i}")
             for i, c in enumerate(columns) for k, side in (("b", before), ("a", ~before))]
    found = (monthly.where(F.col(series).isin(*columns))
             .groupBy(F.month("month").alias("month_no")).agg(*means))
    months = monthly.sparkSession.range(1, 13, 1, 1).select(F.col("id").cast("int").alias("month_no"))
    cells = [pct_change_zero_guarded(f"_a{i}", f"_b{i}").alias(c) for i, c in enumerate(columns)]
    # at most twelve rows, so broadcasting them is bounded
    return (months.join(F.broadcast(found), "month_no", "left")
            .select("month_no", month_name("month_no").alias("month_name"), *cells))


def unpivot_matrix(wide: DataFrame, ids: Sequence[str], series: str = "band",
                   value: str = "change_pct") -> DataFrame:
    """R2: wide → long again."""
    cols = [c for c in wide.columns if c not in ids]
    return wide.unpivot(list(ids), cols, series, value)
