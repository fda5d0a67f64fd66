"""Connected components by alternating large-star and small-star (Kiveris et al. 2014).

Both steps hang the neighbours of a vertex on the smallest vertex they know: large-star the
larger neighbours, small-star the smaller ones and the vertex itself.  When nothing changes
any more, every vertex of a component hangs on its smallest vertex.  A step is a partial
minimum per vertex and an equi-join, so a vertex with very many neighbours is reduced before
the shuffle and its join partition can be split; no neighbourhood is ever collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import Scratch, measured, number_of_rows


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _checksum() -> Column:
    return F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("checksum")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(u, v)`` with ``v`` the smallest vertex of ``u``'s component, for every vertex ``u`` that
    is not itself the smallest.

    Edges are rows of two longs, in any direction and number; loops and nulls are dropped.  An
    empty table gives an empty one.  Each round is written to the shared folder, which cuts the
    lineage; only a count and a checksum, taken while it is written, come to the driver.
    """
    now = scratch.write(edges.where("u != v").select("u", "v"))
    if not number_of_rows(now):
        return now
    state = None
    while True:
        step = scratch.write(small_star(large_star(now)), _checksum())
        scratch.drop(now)
        now, before, state = step, state, measured(step)
        if state == before or not state["rows"]:
            return now
