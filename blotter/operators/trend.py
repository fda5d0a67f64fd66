"""Monthly trend operators (Q2-Q5, Q10; A1-A5, A10, W1-W6, R1).

Shape of every operator: one aggregation over the incident table (partial
aggregation map-side, so the shuffle carries one row per key per task even
when a single month or category holds a third of the rows), then window
functions over the reduced monthly table, partitioned by series.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.functions.categorical import (
    INCOME_BANDS, UNKNOWN_TEXTS, Band, band_of, groups_of, is_known)
from blotter.functions.dates import month_start
from blotter.functions.numeric import share_pct
from blotter.functions.series import (
    MA_WINDOW, MODERATE_PCT, PERIOD_END, PERIOD_START, SURGE_PCT, growth_class, in_period,
    lag_rows, pct_growth, series_window, strict_moving_avg)


def _tally(weight: str | None):
    """Row count, or the sum of a count column when the input is pre-aggregated."""
    return F.count(F.lit(1)) if weight is None else F.sum(F.col(weight)).cast("long")


def _part(cond, weight: str | None):
    """Rows (or summed counts) meeting ``cond``; 0 when none."""
    if weight is None:
        return F.count(F.when(cond, F.lit(1)))
    return F.coalesce(F.sum(F.when(cond, F.col(weight))), F.lit(0)).cast("long")


def monthly_counts(df: DataFrame, date_col: str, by: Sequence[str] = (),
                   month_col: str = "month", count_col: str = "cnt",
                   weight: str | None = None) -> DataFrame:
    """Rows per (series keys, month).  Rows with a NULL date are dropped first.

    Months without rows are absent, not zero.  ``weight``: a count column of
    an already aggregated input (e.g. a month × category count table), summed
    instead of counting rows; every trend operator accepts it.
    """
    return (df.where(F.col(date_col).isNotNull())
            .groupBy(*[F.col(c) for c in by], month_start(date_col).alias(month_col))
            .agg(_tally(weight).alias(count_col)))


def add_trend_metrics(monthly: DataFrame, value: str = "cnt", by: Sequence[str] = (),
                      month_col: str = "month", window: int = MA_WINDOW,
                      moderate: float = MODERATE_PCT, surge: float = SURGE_PCT,
                      period: tuple[date, date] = (PERIOD_START, PERIOD_END)) -> DataFrame:
    """Moving average, value ``window`` rows back, growth %, class, period flag."""
    w = series_window(month_col, by)
    ma, prev = f"ma{window}", f"prev{window}"
    return (monthly
            .select(*by, month_col, value,
                    strict_moving_avg(value, w, window).alias(ma),
                    lag_rows(value, w, window).alias(prev))
            .withColumn("growth_pct", pct_growth(value, prev))
            .withColumn("class", growth_class("growth_pct", moderate, surge))
            .withColumn("in_period", in_period(month_col, *period)))


def monthly_trend(df: DataFrame, date_col: str, by: Sequence[str] = (),
                  window: int = MA_WINDOW, moderate: float = MODERATE_PCT,
                  surge: float = SURGE_PCT,
                  period: tuple[date, date] = (PERIOD_START, PERIOD_END),
                  weight: str | None = None) -> DataFrame:
    """Q2: monthly count, strict 12-row mean, YoY growth and its class.

    With ``by`` the same series is computed for every value of the keys at
    once (one scan, one shuffle), each series by row: months absent from a
    series are skipped, not filled.
    """
    counts = monthly_counts(df, date_col, by, weight=weight)
    return add_trend_metrics(counts, "cnt", by, window=window, moderate=moderate,
                             surge=surge, period=period)


def _level_grid(df: DataFrame, date_col: str, level_col: str,
                levels: Sequence[str],
                weight: str | None = None) -> tuple[DataFrame, list[str]]:
    """Month × level counts in wide form: NULL where a level has no row that month.

    One aggregation with a conditional sum per level; months are those where
    any level occurs, listed or not.
    """
    levels = list(levels)
    one = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    aggs = [F.sum(F.when(F.col(level_col) == v, one)).alias(f"_lvl{i}")
            for i, v in enumerate(levels)]
    wide = (df.where(F.col(date_col).isNotNull() & F.col(level_col).isNotNull())
            .groupBy(month_start(date_col).alias("month"))
            .agg(*aggs))
    return wide, levels


def _dense_grid(df: DataFrame, date_col: str, level_col: str,
                weight: str | None = None) -> DataFrame:
    """(month, level, cnt) on the dense grid of observed months × observed levels.

    One aggregation of the input to (level, month) counts; everything after
    works on that table and stays partitioned by level: a map month → count
    per level (one entry a month), and the observed months, a one-row scalar
    subquery, exploded for each level, the count looked up (NULL if absent).
    """
    counts = monthly_counts(df.where(F.col(level_col).isNotNull()), date_col, by=[level_col],
                            weight=weight)
    months = counts.agg(F.array_sort(F.collect_set("month")))
    per_level = counts.groupBy(F.col(level_col).alias("level")).agg(
        F.map_from_entries(F.collect_list(F.struct("month", "cnt"))).alias("_m"))
    return (per_level.select("level", "_m", F.explode(months.scalar()).alias("month"))
            .select("month", "level", F.try_element_at("_m", F.col("month")).alias("cnt")))


def level_wide(df: DataFrame, date_col: str, level_col: str,
               levels: Sequence[str], weight: str | None = None) -> DataFrame:
    """One row per month, one count column per listed level (NULL where absent).

    The columns of a result must be known when it is planned, so ``levels`` is
    required; :func:`level_trend` is the general, long form.  Months are those of
    all levels, so a subset of the levels has the same rows as all of them.
    """
    wide, levels = _level_grid(df, date_col, level_col, levels, weight)
    return wide.select("month", *[F.col(f"_lvl{i}").alias(v) for i, v in enumerate(levels)])


def level_trend(df: DataFrame, date_col: str, level_col: str,
                levels: Sequence[str] | None = None, window: int = MA_WINDOW,
                weight: str | None = None) -> DataFrame:
    """Q3: per-level counts on the dense month × level grid, strict 12-row mean.

    A month missing for one level is a NULL cell (not a skipped row), so it
    blanks that level's next ``window`` means: the pivoted-table behaviour,
    unlike the single-series :func:`monthly_trend`.  ``levels`` picks series of that
    grid; its months stay those in which any level occurs.
    """
    if levels is None:
        long = _dense_grid(df, date_col, level_col, weight)
    else:
        wide, levels = _level_grid(df, date_col, level_col, levels, weight)
        cells = F.array(*[F.struct(F.lit(v).alias("level"), F.col(f"_lvl{i}").alias("cnt"))
                          for i, v in enumerate(levels)])
        long = wide.select("month", F.inline(cells))
    w = series_window("month", ["level"])
    return long.select("month", "level", "cnt",
                       strict_moving_avg("cnt", w, window).alias(f"ma{window}"))


def with_place(counts: DataFrame, name: str, *order) -> DataFrame:
    """O1-O2: the row's place (from 1) in an order of the whole table, as a column, so that the order
    survives being written.  For report tables: one task numbers all their rows."""
    return counts.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))


def level_endpoints(trend: DataFrame, series: str = "level", value: str = "ma12",
                    row: int = MA_WINDOW, positional: bool = True) -> DataFrame:
    """A10: the ``row``-th and the last value of each series, by position.

    Positional like ``iloc[11]`` / ``iloc[-1]``: NULL if that row's value is
    NULL or the series is shorter than ``row``.  With ``positional=False``:
    the first and last non-NULL values instead (a different answer where the
    grid has holes), as ``ma_first`` / ``ma_last``.
    """
    if not positional:
        present = trend.where(F.col(value).isNotNull())
        return present.groupBy(series).agg(
            F.min_by(value, "month").alias("ma_first"), F.max_by(value, "month").alias("ma_last"))
    asc = Window.partitionBy(series).orderBy(F.col("month").asc())
    desc = Window.partitionBy(series).orderBy(F.col("month").desc())
    ranked = trend.select(series, value, F.row_number().over(asc).alias("_rn"),
                          F.row_number().over(desc).alias("_rd"))
    return ranked.groupBy(series).agg(
        F.max(F.when(F.col("_rn") == row, F.col(value))).alias(f"ma_row{row}"),
        F.max(F.when(F.col("_rd") == 1, F.col(value))).alias("ma_last"))


def category_group_trend(df: DataFrame, date_col: str, category_col: str,
                         groups: Mapping[str, Sequence[str]] | DataFrame,
                         group_col: str = "grp", sentinels: Sequence[str] = UNKNOWN_TEXTS,
                         weight: str | None = None, **trend_kw) -> DataFrame:
    """Q4: roll raw categories up into named groups, then a trend per group.

    ``groups`` is either ``{group: [category, ...]}`` (compiled to a literal
    map lookup, no join) or a DataFrame ``(category_col, group_col)`` (joined).
    Each group counts the rows of its categories, as separate filters would: a
    category listed in two groups counts in both.  Categories in no group, NULL
    and ``sentinels`` are left out.  Rows are counted by (month, category) first;
    only those counts meet the groups.
    """
    counts = monthly_counts(df.where(is_known(category_col, sentinels)), date_col, by=[category_col],
                            weight=weight)
    if isinstance(groups, DataFrame):
        mapping = groups.select(category_col, group_col).where(F.col(group_col).isNotNull()).distinct()
        tagged = counts.join(mapping, category_col, "inner")
    else:
        tagged = counts.withColumn(group_col, F.explode(groups_of(category_col, groups)))
    return monthly_trend(tagged, "month", by=[group_col], weight="cnt", **trend_kw)


def group_share(df: DataFrame, date_col: str, group_col: str, value: str,
                sentinels: Sequence[str] = UNKNOWN_TEXTS, window: int = MA_WINDOW,
                weight: str | None = None) -> DataFrame:
    """Q5: monthly share of one group among rows whose group is known.

    The denominator counts rows with a known group (not NULL, not a
    sentinel).  Months where the group does not occur are absent (the share
    is taken only where it has rows).  One aggregation pass.
    """
    known = df.where(F.col(date_col).isNotNull() & is_known(group_col, sentinels))
    monthly = (known.groupBy(month_start(date_col).alias("month"))
               .agg(_part(F.col(group_col) == value, weight).alias("part"),
                    _tally(weight).alias("total"))
               .where(F.col("part") > 0)
               .withColumn("percent", share_pct("part", "total")))
    w = series_window("month")
    return monthly.select("month", "part", "total", "percent",
                          strict_moving_avg("percent", w, window).alias(f"ma{window}"))


def band_trend(df: DataFrame, date_col: str, value_col: str,
               bands: Sequence[Band] = INCOME_BANDS, band_col: str = "band",
               window: int = MA_WINDOW, weight: str | None = None) -> DataFrame:
    """Q10: monthly counts and strict 12-row mean per numeric band.

    Rows outside every band (NULL, negative, fractional gaps, the excluded
    bound) are dropped.  Each band is its own series by row.
    """
    banded = df.withColumn(band_col, band_of(value_col, bands)).where(F.col(band_col).isNotNull())
    counts = monthly_counts(banded, date_col, by=[band_col], weight=weight)
    w = series_window("month", [band_col])
    return counts.select(band_col, "month", "cnt",
                         strict_moving_avg("cnt", w, window).alias(f"ma{window}"))
