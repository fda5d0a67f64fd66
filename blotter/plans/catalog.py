"""Registered queries over the driver tables, each with its DuckDB oracle SQL.

The driver tables stand in for the incident data (SURVEY §7.3): ``orders``
is the incident table (id ``o_orderkey``, date ``o_orderdate``, level
``o_orderstatus``, type ``o_orderpriority``), ``customer`` gives a group
(``c_mktsegment``) and a band value (``c_acctbal``), ``nation`` is the area
dimension and ``lineitem`` supplies points for the spatial join.  Every query
runs over whole tables.  Doubles are rounded to 6 places on both sides so the
value hashes compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

PLACES = 6


def register(name: str, sql: str | None):
    """Register a query and, where SQL can express it, its oracle."""
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Round every double column (for comparison with the oracle)."""
    return df.select(*[
        F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name)
        for f in df.schema.fields])
