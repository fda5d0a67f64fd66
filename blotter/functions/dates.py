"""Date parsing, month keys and month labels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Text values that mean "no date" in the source files.
NULL_DATE_TEXTS = ("null", "")


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_text(c: ColumnOrName, texts: Iterable[str] = NULL_DATE_TEXTS) -> Column:
    """NULL where the value (trimmed) is one of ``texts``; the value otherwise."""
    c = _col(c)
    return F.when(~F.trim(c).isin(*texts), c)


def parse_date(c: ColumnOrName, pattern: str = "M/d/yyyy") -> Column:
    """Text to date; unparsable text becomes NULL instead of failing the job.

    ``M/d/yyyy`` rejects two-digit years such as ``1/2/15`` where ``M/d/y``
    would read year 15.  For a column already typed as a date or timestamp,
    use :func:`as_date` (see :func:`typed_date`).
    """
    c = _col(c)
    return F.try_to_date(null_if_text(c.cast("string")), pattern)


def as_date(c: ColumnOrName) -> Column:
    """Cast text in ISO form, timestamp or date to date (NULL when bad)."""
    return F.try_to_date(_col(c).cast("string"))


def typed_date(df, name: str, pattern: str = "M/d/yyyy") -> Column:
    """Date from column ``name`` of ``df``: cast if already a date or timestamp,
    parsed with ``pattern`` if text."""
    from pyspark.sql import types as T
    if isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return parse_date(name, pattern)


def date_with_fallback(start: ColumnOrName, end: ColumnOrName | None,
                       pattern: str = "M/d/yyyy", df=None) -> Column:
    """Start date, else end date: both parsed, both sentinel-aware.

    With ``df`` given, columns already typed as dates are cast, not parsed.
    """
    def one(c):
        if df is not None and isinstance(c, str):
            return typed_date(df, c, pattern)
        return parse_date(c, pattern)
    first = one(start)
    if end is None:
        return first
    return F.coalesce(first, one(end))


def month_start(c: ColumnOrName) -> Column:
    """The first day of the month as a date: the series key for monthly work."""
    return F.trunc(_col(c).cast("date"), "month")


def month_label(month: ColumnOrName, padded: bool = True) -> Column:
    """Label of a month key: ``2020-02`` padded or ``2020-2`` unpadded.

    Labels are for display only; ordering always uses the date key because
    unpadded text sorts ``2020-11`` before ``2020-2``.
    """
    m = _col(month)
    if padded:
        return F.date_format(m, "yyyy-MM")
    return F.concat(F.year(m).cast("string"), F.lit("-"), F.month(m).cast("string"))


def month_name(month_no: ColumnOrName) -> Column:
    """Short English month name (``Jan`` … ``Dec``) from a month number 1-12."""
    return F.date_format(F.make_date(F.lit(2000), _col(month_no), F.lit(1)), "MMM")


def month_from_label(label: ColumnOrName) -> Column:
    """Month key from a ``yyyy-M`` or ``yyyy-MM`` label (``2020-2``, ``2020-02``); NULL if bad."""
    return F.try_to_date(_col(label).cast("string"), "yyyy-M")
