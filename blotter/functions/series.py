"""Ordered-series expressions over monthly tables.

All windows here run after monthly aggregation, so a series holds tens to a
few hundred rows; they are partitioned by the series key where there is one.
Frames are by row, not by calendar (a month missing from a series is skipped,
not zero-filled), which is how a 12-row rolling mean and a 12-row shift behave.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

# Fixed values of the reference analysis: window length and growth thresholds.
MA_WINDOW = 12
MODERATE_PCT = 10.0
SURGE_PCT = 20.0
# Shaded period of the trend charts.
PERIOD_START = date(2020, 3, 1)
PERIOD_END = date(2022, 12, 1)

# Growth class labels.
CLASS_STEADY = "steady"
CLASS_MODERATE = "moderate"
CLASS_SURGE = "surge"
CLASS_DROP = "drop"


def series_window(order: str = "month", by: Sequence[str] = ()) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(F.col(order).asc())


def strict_moving_avg(value: str, w: WindowSpec, n: int = MA_WINDOW) -> Column:
    """Trailing mean of the last ``n`` rows, NULL unless all ``n`` are present.

    NULL for the first ``n - 1`` rows and whenever a NULL value falls inside
    the frame, as a pandas ``rolling(n).mean()`` gives.
    """
    frame = w.rowsBetween(-(n - 1), Window.currentRow)
    return F.when(F.count(value).over(frame) == n, F.avg(value).over(frame))


def lag_rows(value: str, w: WindowSpec, n: int = MA_WINDOW) -> Column:
    """Value ``n`` rows back in the series."""
    return F.lag(value, n).over(w)


def pct_growth(current: Column | str, previous: Column | str) -> Column:
    """(current - previous) / previous * 100; NULL where previous is NULL or 0."""
    cur = F.col(current) if isinstance(current, str) else current
    prev = F.col(previous) if isinstance(previous, str) else previous
    return F.try_divide(cur - prev, prev) * F.lit(100)


def growth_class(growth: Column | str, moderate: float = MODERATE_PCT,
                 surge: float = SURGE_PCT) -> Column:
    """Class of a growth percent with thresholds ``moderate < surge``.

    surge: g >= surge; drop: g <= -surge; moderate: moderate <= |g| < surge;
    steady: |g| < moderate; NULL where growth is undefined (the first 12
    rows of a series, or a zero base).
    """
    if not moderate < surge:
        raise ValueError("thresholds must satisfy moderate < surge")
    g = F.col(growth) if isinstance(growth, str) else growth
    return (F.when(g.isNull(), F.lit(None).cast("string"))
            .when(g >= surge, F.lit(CLASS_SURGE))
            .when(g <= -surge, F.lit(CLASS_DROP))
            .when(F.abs(g) >= moderate, F.lit(CLASS_MODERATE))
            .otherwise(F.lit(CLASS_STEADY)))


def in_period(month: Column | str, start: date = PERIOD_START,
              end: date = PERIOD_END) -> Column:
    """True for months inside the closed period [start, end]."""
    m = F.col(month) if isinstance(month, str) else month
    return m.between(F.lit(start), F.lit(end))
