"""Table profile (Q6; A6, A9, F2, U2-U3, O2-O3).

Each check is one aggregation pass that returns a small DataFrame; only exact
quantiles take several, and read a bounded number of values to the driver.  Run them on a persisted or written table so
the source is not rescanned once per check.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and NULL count per column, as a long table ``(column, null_count, row_count)``."""
    cols = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("null_count"))
                      for i, c in enumerate(cols)])
    return wide.select(F.inline(cells), F.col("_rows").alias("row_count"))


def duplicate_keys(df: DataFrame, key: str, top: int | None = None) -> DataFrame:
    """Keys occurring more than once with their counts, in no order.

    ``top`` keeps, most frequent first, the ``top`` most frequent (ties by key): a preview, as a
    ``show()`` after ``orderBy(count desc)`` gives.
    """
    dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    if top is not None:
        dup = dup.orderBy(F.col("n").desc(), F.col(key).asc()).limit(top)
    return dup


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of several columns with their counts, ``(column, value, n)``.

    One scan for all columns: each row is exploded to one (column, value)
    pair per column, then counted with map-side partial aggregation.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.inline(pairs))
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def date_range(df: DataFrame, date_col: str) -> DataFrame:
    """Smallest and largest date, NULL dates and rows: one row."""
    d = F.col(date_col)
    return df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"),
                  F.count_if(d.isNull()).alias("null_dates"),
                  F.count(F.lit(1)).alias("row_count"))


def null_code_pairs(df: DataFrame, code_col: str, desc_col: str,
                    sentinels: Sequence[str] = ()) -> DataFrame:
    """Distinct (code, description) where the description is NULL (or one of ``sentinels``)."""
    d = F.col(desc_col)
    return (df.where(d.isNull() | (d.isin(*sentinels) if sentinels else F.lit(False)))
            .select(code_col, desc_col).distinct())


def profile(df: DataFrame, key: str | None = None, date_col: str | None = None,
            categorical: Sequence[str] = (),
            numeric: Mapping[str, tuple[float | None, float | None]] | None = None,
            code_pairs: tuple[str, str] | None = None) -> dict[str, DataFrame]:
    """All checks at once, as named DataFrames.

    ``numeric`` maps columns to their fences, ``code_pairs`` names a (code,
    description) pair whose missing descriptions are listed.
    """
    out = {"null_counts": null_counts(df)}
    if numeric:
        out["numeric_range"] = numeric_range(df, numeric)
    if key:
        out["duplicate_keys"] = duplicate_keys(df, key)
    if date_col:
        out["date_range"] = date_range(df, date_col)
    if categorical:
        out["distinct_values"] = distinct_values(df, categorical)
    if code_pairs:
        out["null_code_pairs"] = null_code_pairs(df, *code_pairs)
    return out


def _number(column: str):
    """The column as a double, NaN as NULL."""
    x = F.col(column).cast("double")
    return F.when(~F.isnan(x), x)


def numeric_range(df: DataFrame,
                  fences: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Exact range per numeric column, and its values beyond given fences.

    ``(column, n, nulls, min, max, low_fence, high_fence, beyond)`` in one scan.
    NaN counts as NULL; a fence of ``None`` is open.  Flags values such as one
    income far above every other.
    """
    aggs, cells = [], []
    for i, (c, (lo, hi)) in enumerate(fences.items()):
        x = _number(c)
        low, high = F.lit(lo).cast("double"), F.lit(hi).cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("column"), F.count(x).alias("n"), F.count_if(x.isNull()).alias("nulls"),
            F.min(x).alias("min"), F.max(x).alias("max"), low.alias("low_fence"),
            high.alias("high_fence"), F.count_if((x < low) | (x > high)).alias("beyond")).alias(f"_s{i}"))
        cells.append(F.col(f"_s{i}"))
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def numeric_quartiles(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """Approximate quartiles per column (``percentile_approx``: bounded memory), as a guide
    for choosing fences; no count depends on them."""
    q = [F.percentile_approx(_number(c), [0.25, 0.5, 0.75], accuracy).alias(f"_q{i}")
         for i, c in enumerate(columns)]
    cells = [F.struct(F.lit(c).alias("column"), *[F.col(f"_q{i}")[k].alias(n) for k, n in
                                                  enumerate(("q1", "median", "q3"))])
             for i, c in enumerate(columns)]
    return df.agg(*q).select(F.inline(F.array(*cells)))


#: An interval of at most so many rows is read to the driver as (value, count) pairs.
LEAF = 10_000


@dataclass
class _Sought:
    """One quantile while its interval ``[low, high]`` narrows: the value of rank ``rank`` is in it,
    ``below`` rows lie under it and ``inside`` rows in it."""

    column: str
    rank: int
    low: float
    high: float
    below: int
    inside: int

    @property
    def open(self) -> bool:
        return self.low < self.high and self.inside > LEAF


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float] = (0.25, 0.5, 0.75),
                    accuracy: int = 10_000) -> dict[str, list[float | None]]:
    """The exact quantiles of each column: the smallest value that at least that share of the
    values do not exceed.  NULL and NaN do not count; a column without values has None.

    Selection by narrowing: a sketch of bounded size names two values close around the rank sought, an
    exact count checks them, and the next round looks only between them, so that each round leaves a few
    thousandths of the rows, whatever their distribution.  All columns and shares narrow together, two
    aggregations a round; no sort, and what comes to the driver is bounded (``LEAF`` pairs a quantile).
    """
    numbers = df.select(*[_number(c).alias(f"x{i}") for i, c in enumerate(columns)])
    xs = [f"x{i}" for i in range(len(columns))]
    ends = numbers.agg(*[F.struct(F.count(x), F.min(x), F.max(x)) for x in xs]).first()
    sought = [[_Sought(x, max(1, n - math.floor(n - n * share)), low, high, 0, n) for share in shares] if n else None
              for x, (n, low, high) in zip(xs, ends)]
    every = [s for column in sought if column for s in column]
    while opened := [s for s in every if s.open]:
        _narrow(numbers, opened, accuracy)
    values = _leaves(numbers, [s for s in every if s.low < s.high])
    return {name: [None] * len(shares) if column is None else
            [s.low if s.low == s.high else values[id(s)] for s in column]
            for name, column in zip(columns, sought)}


def _narrow(numbers: DataFrame, sought: list[_Sought], accuracy: int) -> None:
    sketches = []
    for s in sought:
        inner = F.when(F.col(s.column).between(s.low, s.high), F.col(s.column))
        share = (s.rank - s.below) / s.inside
        around = [max(0.0, share - 2 / accuracy), min(1.0, share + 2 / accuracy)]
        sketches.append(F.percentile_approx(inner, around, accuracy))
    pairs = numbers.agg(*[p.alias(f"p{i}") for i, p in enumerate(sketches)]).first()
    counts = []
    for s, (a, b) in zip(sought, pairs):
        x = F.col(s.column)
        counts.append(F.struct(F.count_if(x < a), F.count_if(x == a), F.min(F.when(x > a, x)),
                               F.count_if(x < b), F.count_if(x == b), F.max(F.when(x < b, x))))
    found = numbers.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first()
    for s, (a, b), (under_a, at_a, after_a, under_b, at_b, before_b) in zip(sought, pairs, found):
        top = s.below + s.inside
        for value, under, at in ((a, under_a, at_a), (b, under_b, at_b)):
            if under < s.rank <= under + at:
                s.low = s.high = value
        if s.low == s.high:
            continue
        # each side moves past the value that was counted there, so every round makes progress
        for value, under, at, after in ((b, under_b, at_b, None), (a, under_a, at_a, after_a)):
            if s.rank > under + at and after is not None:
                s.low, s.below = after, under + at
        if s.rank <= under_b:
            s.high, top = before_b, under_b
        elif s.rank <= under_a:
            s.high, top = a, under_a + at_a
        s.inside = top - s.below


def _leaves(numbers: DataFrame, sought: list[_Sought]) -> dict[int, float]:
    """Values of the quantiles whose intervals hold few rows, read once for all."""
    if not sought:
        return {}
    inside = [F.when(F.col(s.column).between(s.low, s.high), F.struct(F.lit(i).alias("i"), F.col(s.column).alias("x")))
              for i, s in enumerate(sought)]
    pairs = (numbers.select(F.explode(F.array_compact(F.array(*inside))).alias("p"))
             .groupBy("p.i", "p.x").agg(F.count(F.lit(1)).alias("n")).collect())
    out, seen = {}, {}
    for r in sorted(pairs, key=lambda r: (r.i, r.x)):
        s = sought[r.i]
        seen[r.i] = seen.get(r.i, s.below) + r.n
        if seen[r.i] >= s.rank:
            out.setdefault(id(s), r.x)
    return out


def quartile_fences(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> dict[str, tuple]:
    """``(q1, median, q3, low fence, high fence)`` of each column: exact quartiles, and fences
    ``reach`` times their distance beyond them (None for a column without values)."""
    out = {}
    for column, (q1, median, q3) in exact_quantiles(df, columns).items():
        out[column] = (None,) * 5 if q1 is None else (q1, median, q3, q1 - reach * (q3 - q1), q3 + reach * (q3 - q1))
    return out


def numeric_outliers(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Per column its range, exact quartiles, fences and the number of values beyond them."""
    found = quartile_fences(df, columns, reach)
    ranges = numeric_range(df, {c: v[3:] for c, v in found.items()})
    pick = lambda i: F.coalesce(*[F.when(F.col("column") == c, F.lit(v[i]).cast("double"))
                                  for c, v in found.items()])
    return ranges.select("column", "n", "nulls", "min", pick(0).alias("q1"), pick(1).alias("median"),
                         pick(2).alias("q3"), "max", "low_fence", "high_fence", "beyond")


def outlier_rows(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """The rows whose value lies beyond its column's fences, such as an income far above all others."""
    *_, low, high = quartile_fences(df, [column], reach)[column]
    if low is None:
        return df.where(F.lit(False))
    x = _number(column)
    return df.where((x < low) | (x > high))
