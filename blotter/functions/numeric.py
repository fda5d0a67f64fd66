"""Ratios and percent changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def share_pct(part: Column | str, total: Column | str) -> Column:
    """part / total * 100; NULL where total is 0 or NULL."""
    return F.try_divide(_col(part), _col(total)) * F.lit(100)


def pct_change(after: Column | str, before: Column | str) -> Column:
    """(after - before) / before * 100; NULL where before is 0 or NULL."""
    a, b = _col(after), _col(before)
    return F.try_divide(a - b, b) * F.lit(100)


def pct_change_zero_guarded(after: Column | str, before: Column | str) -> Column:
    """Percent change over values whose missing means count as 0.

    Missing → 0 on both sides first; a zero base gives 0 %, so a month seen
    before and never after gives -100 %.
    """
    a = F.coalesce(_col(after).cast("double"), F.lit(0.0))
    b = F.coalesce(_col(before).cast("double"), F.lit(0.0))
    return F.when(b != 0, (a - b) / b * F.lit(100)).otherwise(F.lit(0.0))
