"""The feed ingests every row once; the counts do not depend on triggers or date order."""

import csv
from datetime import date

import pytest

from blotter.streaming.feed import ingest_feed, landed_monthly_counts, read_feed

from conftest import rows

COLUMNS = ["id", "fr", "to", "lvl"]


def _drop(path, data, header=COLUMNS):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(data)


def _ingest(spark, feed_dir, home, **kw):
    query = ingest_feed(read_feed(spark, str(feed_dir), COLUMNS, **kw), str(home / "table"), home.name,
                        checkpoint=str(home / "state"), available_now=True)
    assert query.awaitTermination(120)
    return spark.read.parquet(str(home / "table"))


def test_feed_monthly_counts(spark, tmp_path):
    feed_dir = tmp_path / "feed"
    feed_dir.mkdir()
    _drop(feed_dir / "a.csv", [["1", "1/5/2023", "", "F"], ["2", "", "1/9/2023", "M"],
                               ["3", "2/1/2023", "", "F"], ["4", "", "", "F"]])
    _drop(feed_dir / "b.csv", [["1", "1/5/2023", "", "F"], ["5", "2/7/2023", "", "M"]])
    landed = _ingest(spark, feed_dir, tmp_path / "x", max_files_per_trigger=1)
    assert landed.count() == 6
    assert rows(landed_monthly_counts(landed, "id", "fr", "to"), "month", "cnt") == [
        (date(2023, 1, 1), 2), (date(2023, 2, 1), 2)]


@pytest.mark.parametrize("per_trigger", [None, 1])
def test_late_rows_are_counted(spark, tmp_path, per_trigger):
    feed_dir = tmp_path / "feed"
    feed_dir.mkdir()
    for name, year in (("a", 2023), ("b", 2021), ("c", 2020)):
        _drop(feed_dir / f"{name}.csv", [[f"{name}1", f"1/5/{year}", "", "F"], [f"{name}2", f"3/5/{year}", "", "F"]])
    landed = _ingest(spark, feed_dir, tmp_path / f"x{per_trigger}", max_files_per_trigger=per_trigger)
    got = rows(landed_monthly_counts(landed, "id", "fr", "to"), "month", "cnt")
    assert got == [(date(y, m, 1), 1) for y in (2020, 2021, 2023) for m in (1, 3)]


def test_feed_with_another_header_fails(spark, tmp_path):
    feed_dir = tmp_path / "feed"
    feed_dir.mkdir()
    _drop(feed_dir / "a.csv", [["1", "F", "1/5/2023", ""]], header=["id", "lvl", "fr", "to"])
    with pytest.raises(Exception, match="header"):
        _ingest(spark, feed_dir, tmp_path / "x")
