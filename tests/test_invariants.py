"""Invariants on the driver tables and agreement with pandas series semantics."""

import os

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blotter.operators.integrate import dedup_first, integrate_incidents, union_before_dedup
from blotter.operators.spatial import locate
from blotter.operators.trend import level_trend, monthly_trend
from blotter.plans import geo, integration
from blotter.plans.trends import PRIORITY_GROUPS, incidents
from blotter.operators.trend import category_group_trend, group_share

from conftest import rows

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@needs_data
def test_union_and_dedup_invariants(spark):
    srcs = integration.text_sources(spark, SF)
    u = union_before_dedup(srcs, integration.SPEC)
    assert u.count() == sum(s.df.count() for s in srcs)
    d = dedup_first(u, "o_orderkey", ["incident_date"])
    assert d.count() == d.select("o_orderkey").distinct().count() == u.select("o_orderkey").distinct().count()
    cur = integrate_incidents(srcs, integration.SPEC)
    ident = ["o_orderkey", "source", "incident_date"]
    assert cur.join(u, ident, "left_anti").count() == 0     # survivors are input rows


@needs_data
def test_group_sums_equal_totals(spark):
    inc = incidents(spark, SF)
    total = monthly_trend(inc, "o_orderdate").select("month", "cnt")
    groups = category_group_trend(inc, "o_orderdate", "o_orderpriority", PRIORITY_GROUPS)
    summed = groups.groupBy("month").agg(F.sum("cnt").alias("cnt"))
    assert rows(summed) == rows(total)
    lv = level_trend(inc, "o_orderdate", "o_orderstatus")
    assert rows(lv.groupBy("month").agg(F.sum("cnt").alias("cnt"))) == rows(total)


@needs_data
def test_shares_of_all_groups_sum_to_100(spark):
    inc = incidents(spark, SF)
    cust = spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey", "c_mktsegment")
    j = inc.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    segs = [r[0] for r in cust.select("c_mktsegment").distinct().collect()]
    parts = [group_share(j, "o_orderdate", "c_mktsegment", s).select("month", "percent") for s in segs]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    for r in u.groupBy("month").agg(F.sum("percent").alias("s")).collect():
        assert r["s"] == pytest.approx(100.0)


@needs_data
def test_locate_independent_of_cell_size_on_driver_points(spark):
    areas = geo.areas_from_features(geo.area_features(spark, SF), ["ntacode"])
    pts = geo.line_points(spark, SF)
    a = rows(locate(pts, areas, x="x", y="y", area_col="ntacode"))
    b = rows(locate(pts, areas, x="x", y="y", area_col="ntacode", cell_size=0.7, strip_height=0.3))
    assert a == b and len(a) > 0


def _pandas_trend(counts):
    s = pd.Series(counts, dtype="float64")
    ma = s.rolling(12).mean()
    prev = s.shift(12)
    return ma, prev


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=0, max_value=6), min_size=1, max_size=30))
def test_monthly_trend_matches_pandas(spark, counts):
    # a month with 0 incidents has no row: pandas sees only the observed months (row mode)
    months = pd.date_range("2015-01-01", periods=len(counts), freq="MS").date
    data = [(m, 1) for m, c in zip(months, counts) for _ in range(c)]
    observed = [c for c in counts if c > 0]
    if not observed:
        return
    df = spark.createDataFrame(data, "d date, one int")
    got = monthly_trend(df, "d").orderBy("month").collect()
    ma, prev = _pandas_trend(observed)
    assert [r["cnt"] for r in got] == observed
    for r, m, p in zip(got, ma, prev):
        assert (r["ma12"] is None) == bool(np.isnan(m))
        if r["ma12"] is not None:
            assert r["ma12"] == pytest.approx(m)
        assert (r["prev12"] is None) == bool(np.isnan(p))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=12, max_size=26))
def test_level_grid_matches_pandas_pivot(spark, cells):
    months = pd.date_range("2016-01-01", periods=len(cells), freq="MS").date
    data = []
    for m, (a, b) in zip(months, cells):
        data += [(m, "A")] * a + [(m, "B")] * b
    if not data:
        return
    df = spark.createDataFrame(data, "d date, level string")
    long = pd.DataFrame(data, columns=["d", "level"]).groupby(["d", "level"]).size().reset_index(name="count")
    pivot = long.pivot(index="d", columns="level", values="count")
    ma = pivot.rolling(window=12).mean()
    got = {(r["month"], r["level"]): r["ma12"] for r in level_trend(df, "d", "level").collect()}
    for d in ma.index:
        for lv in ma.columns:
            v = ma.loc[d, lv]
            g = got[(d, lv)]
            assert (g is None) == bool(np.isnan(v)), (d, lv, g, v)
            if g is not None:
                assert g == pytest.approx(v)
    assert len(got) == ma.size


@needs_data
def test_trends_from_count_cube_equal_trends_from_rows(spark):
    from blotter.operators.trend import band_trend, level_wide
    from blotter.functions.categorical import Band
    inc = incidents(spark, SF).withColumn("bal", (F.col("o_custkey") % 7).cast("double"))
    cube = (inc.groupBy(F.trunc("o_orderdate", "month").alias("m"), "o_orderstatus",
                        "o_orderpriority", "bal").agg(F.count(F.lit(1)).alias("n")))
    pairs = [
        (monthly_trend(inc, "o_orderdate"), monthly_trend(cube, "m", weight="n")),
        (monthly_trend(inc, "o_orderdate", by=["o_orderstatus"]),
         monthly_trend(cube, "m", by=["o_orderstatus"], weight="n")),
        (level_trend(inc, "o_orderdate", "o_orderstatus"),
         level_trend(cube, "m", "o_orderstatus", weight="n")),
        (level_trend(inc, "o_orderdate", "o_orderstatus", levels=["F", "O", "P"]),
         level_trend(cube, "m", "o_orderstatus", levels=["F", "O", "P"], weight="n")),
        (level_wide(inc, "o_orderdate", "o_orderstatus", levels=["F", "O"]),
         level_wide(cube, "m", "o_orderstatus", levels=["F", "O"], weight="n")),
        (category_group_trend(inc, "o_orderdate", "o_orderpriority", PRIORITY_GROUPS),
         category_group_trend(cube, "m", "o_orderpriority", PRIORITY_GROUPS, weight="n")),
        (group_share(inc, "o_orderdate", "o_orderpriority", "1-URGENT"),
         group_share(cube, "m", "o_orderpriority", "1-URGENT", weight="n")),
        (band_trend(inc, "o_orderdate", "bal", [Band("lo", 0, 2), Band("hi", 3, 6)]),
         band_trend(cube, "m", "bal", [Band("lo", 0, 2), Band("hi", 3, 6)], weight="n")),
    ]
    for raw, cubed in pairs:
        assert raw.dtypes == cubed.dtypes
        assert rows(raw) == rows(cubed)
