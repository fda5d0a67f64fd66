"""Before/after rules (D19-D22) and the month × band matrix."""

from datetime import date

import pytest

from blotter.operators.compare import (
    before_after, before_after_by_month, change_matrix, unpivot_matrix)

from conftest import rows

SPLIT = date(2020, 4, 1)


def _monthly(spark):
    data = [
        ("low", date(2019, 3, 1), 10), ("low", date(2020, 3, 1), 20),   # last month before
        ("low", date(2020, 4, 1), 30),                                   # split month is after
        ("low", date(2021, 3, 1), 45),
        ("mid", date(2019, 1, 1), 8), ("mid", date(2019, 2, 1), 4),      # no months after
        ("high", date(2021, 5, 1), 7),                                   # nothing before
    ]
    return spark.createDataFrame(data, "band string, month date, cnt long")


def test_before_after(spark):
    got = {r["band"]: (r["before_avg"], r["after_avg"], r["change_pct"])
           for r in before_after(_monthly(spark), SPLIT, labels=["low", "mid", "high", "none"]).collect()}
    assert got["low"] == (15.0, 37.5, 150.0)
    assert got["mid"] == (6.0, None, None)
    assert got["high"] == (None, 7.0, None)
    assert got["none"] == (None, None, None)


def test_before_after_by_month(spark):
    t = before_after_by_month(_monthly(spark), SPLIT, labels=["low", "mid", "high"])
    assert t.count() == 36
    cell = {(r["band"], r["month_no"]): (r["before_avg"], r["after_avg"], r["change_pct"], r["month_name"])
            for r in t.collect()}
    assert cell[("low", 3)] == (15.0, 45.0, 200.0, "Mar")
    assert cell[("low", 4)] == (0.0, 30.0, 0.0, "Apr")          # base 0 → 0 %
    assert cell[("mid", 1)] == (8.0, 0.0, -100.0, "Jan")        # seen before, absent after
    assert cell[("high", 5)] == (0.0, 7.0, 0.0, "May")
    assert cell[("mid", 12)] == (0.0, 0.0, 0.0, "Dec")


def test_change_matrix_wide_roundtrip(spark):
    wide = change_matrix(_monthly(spark), ["low", "mid"], SPLIT)
    assert wide.columns == ["month_no", "month_name", "low", "mid"]
    got = wide.orderBy("month_no").collect()
    assert [r["month_name"] for r in got][:3] == ["Jan", "Feb", "Mar"]
    assert got[2]["low"] == pytest.approx(200.0)
    back = unpivot_matrix(wide, ["month_no", "month_name"])
    assert back.count() == 24
    assert rows(back.where("band = 'mid' AND month_no = 1"), "change_pct") == [(-100.0,)]


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["low", "mid", "high"]), st.integers(0, 47),
                          st.integers(0, 30)), min_size=1, max_size=60, unique_by=lambda t: (t[0], t[1])))
def test_month_matrix_matches_a_direct_statement(spark, cells):
    import numpy as np
    import pandas as pd
    labels = ["low", "mid", "high", "none"]
    months = pd.date_range("2019-01-01", periods=48, freq="MS").date
    data = [(b, months[i], c) for b, i, c in cells]
    df = spark.createDataFrame(data, "band string, month date, cnt long")
    got = {(r["band"], r["month_no"]): (r["before_avg"], r["after_avg"], r["change_pct"])
           for r in before_after_by_month(df, SPLIT, labels=labels).collect()}
    pdf = pd.DataFrame(data, columns=["band", "month", "cnt"])
    pdf["m"] = [d.month for d in pdf["month"]]
    for b in labels:
        sub = pdf[pdf["band"] == b]
        for m in range(1, 13):
            before = sub[(sub["month"] < SPLIT) & (sub["m"] == m)]["cnt"].mean()
            after = sub[(sub["month"] >= SPLIT) & (sub["m"] == m)]["cnt"].mean()
            before, after = np.nan_to_num(before), np.nan_to_num(after)
            change = (after - before) / before * 100 if before != 0 else 0.0
            gb, ga, gc = got[(b, m)]
            assert (gb, ga) == pytest.approx((before, after)) and gc == pytest.approx(change)
