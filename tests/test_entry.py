"""The driver contract: entry() runs, and every registered query equals its
DuckDB oracle on the smallest driver tables."""

import math
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from blotter.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return repr(v)


def _bag(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in data)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["month", "cnt", "ma12", "prev12", "growth_pct", "class", "in_period"]


def test_every_query_has_oracle():
    assert set(registry.oracle_sql()) == set(registry.queries())
    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cur = duck.execute(registry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, df.collect()) == _bag(dcols, cur.fetchall())


@pytest.mark.parametrize("left_over", [False, True])
def test_entry_without_the_training_data_subpackage(tmp_path, left_over):
    """Also where an empty folder is left of it, which Python takes for a namespace package."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(os.path.join(root, "blotter"), tmp_path / "blotter", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    if left_over:
        (tmp_path / "blotter" / "llm" / "__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True).stdout.split()
    assert out == [str(len(registry.queries())), str(len(registry.oracle_sql()))]
