"""Integrate incident sources into one table (Q1; P1-P8, T1-T2, U1, C1, C5-C6, F1-F4).

Order of work, which decides results:
  per source: rename → drop → flags → parse date → per-source date bound
  then: union by name → dedup on key → drop NULL dates → global date cut.

A key whose surviving row falls outside the global cut disappears even if a
duplicate was inside it; a per-source bound, in contrast, applies before the
union and dedup.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.functions.categorical import yes_no_flag
from blotter.functions.dates import date_with_fallback, month_label

PRIORITY_COL = "_priority"


@dataclass(frozen=True)
class IncidentSource:
    """One input table and how to conform it.

    ``priority``: lower wins when a key occurs in several sources.
    ``date_bound``: closed range applied to this source only, before union.
    ``yes_no``: text columns holding ``Y``/``N`` to turn into booleans.
    """

    df: DataFrame
    name: str
    priority: int = 0
    lower_names: bool = False
    drop: Sequence[str] = ()
    rename: Mapping[str, str] = field(default_factory=dict)
    yes_no: Sequence[str] = ()
    date_bound: tuple[date, date] | None = None


@dataclass(frozen=True)
class IntegrateSpec:
    """How to build the integrated table.

    ``columns``: the projection kept from every source (missing ones are
    NULL); ``schema`` gives their canonical types (text is cast with
    ``try_cast``, so a bad value is NULL, not a failed job).  The incident
    date is the start date, else the end date, parsed with ``date_pattern``;
    ``end_date=None`` keeps a start-date-only rule (rows without a start
    date then drop out, as they do where the fallback never fires).
    """

    key: str
    start_date: str
    end_date: str | None = None
    date_pattern: str = "M/d/yyyy"
    columns: Sequence[str] | None = None
    schema: T.StructType | None = None
    date_col: str = "incident_date"
    min_date: date | None = None
    max_date: date | None = None
    label_col: str | None = None
    label_padded: bool = False
    source_col: str | None = "source"


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def conform(df: DataFrame, columns: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Select ``columns`` by name in order, NULL where missing, cast to ``schema``."""
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    have = set(df.columns)
    out = []
    for c in columns:
        dtype = types.get(c)
        if c in have:
            e = F.col(c)
            if dtype is not None and df.schema[c].dataType != dtype:
                e = e.try_cast(dtype)
        else:
            e = F.lit(None).cast(dtype or T.StringType())
        out.append(e.alias(c))
    return df.select(*out)


def _prepare(src: IncidentSource, spec: IntegrateSpec) -> DataFrame:
    df = src.df
    if src.lower_names:
        df = lower_names(df)
    if src.rename:
        df = df.withColumnsRenamed(dict(src.rename))
    if src.drop:
        df = df.drop(*src.drop)
    if src.yes_no:
        df = df.withColumns({c: yes_no_flag(c) for c in src.yes_no if c in df.columns})
    if spec.columns is not None:
        keep = list(dict.fromkeys([spec.key, spec.start_date]
                                  + ([spec.end_date] if spec.end_date else [])
                                  + list(spec.columns)))
        df = conform(df, keep, spec.schema)
    df = df.withColumn(spec.date_col,
                       date_with_fallback(spec.start_date, spec.end_date, spec.date_pattern, df))
    if src.date_bound is not None:
        lo, hi = src.date_bound
        df = df.where(F.col(spec.date_col).between(F.lit(lo), F.lit(hi)))
    cols = {PRIORITY_COL: F.lit(src.priority)}
    if spec.source_col:
        cols[spec.source_col] = F.lit(src.name)
    return df.withColumns(cols)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing from one side is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedup_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order`` then by every other column.

    A min over a struct led by the order columns: deterministic whatever the
    partitioning, and an aggregate, so each task reduces its rows per key
    before the shuffle (a key holding a third of the table sends one row per
    task, not all its rows to one task).  NULLs sort first.  A NULL key is a
    key like any other: its rows collapse to one.  Every column takes part in
    the ordering, so all must be orderable (no map columns).
    """
    rest = [c for c in df.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c) for c in [*order, *rest]])
    return (df.groupBy(key).agg(F.min(packed).alias("_first"))
            .select(key, *[F.col(f"_first.{c}").alias(c) for c in [*order, *rest]])
            .select(*df.columns))


def integrate_incidents(sources: Sequence[IncidentSource], spec: IntegrateSpec) -> DataFrame:
    """Q1: conform, union, dedup, date rule and date cut, in that order."""
    frames = [_prepare(s, spec) for s in sources]
    merged = union_sources(frames)
    kept = dedup_first(merged, spec.key, [PRIORITY_COL, spec.date_col]).drop(PRIORITY_COL)
    kept = kept.where(F.col(spec.date_col).isNotNull())
    if spec.min_date is not None:
        kept = kept.where(F.col(spec.date_col) >= F.lit(spec.min_date))
    if spec.max_date is not None:
        kept = kept.where(F.col(spec.date_col) <= F.lit(spec.max_date))
    if spec.label_col:
        kept = kept.withColumn(spec.label_col, month_label(spec.date_col, spec.label_padded))
    return kept


def union_before_dedup(sources: Sequence[IncidentSource], spec: IntegrateSpec) -> DataFrame:
    """The conformed union as it stands before dedup: input of the profile checks."""
    return union_sources([_prepare(s, spec) for s in sources]).drop(PRIORITY_COL)
