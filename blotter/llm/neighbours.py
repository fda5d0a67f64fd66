"""Approximate nearest neighbours by randomly rotated one-bit codes (Gao and Long, 2024).

A vector x becomes c + |x - c| o with a common centre c and a unit vector o.  Its code is the
signs of the rotated o, packed into 64-bit words; its correction scalars are |x - c| and
f = <o', o>, o' being the unit vector of the signs.  For a query q, <q, o> is estimated by
<q, o'> / f: the query's rotated components are rounded to four bits, and their bit planes meet
the codes by AND and popcount.  The error is at most EPSILON deviations of
|q| sqrt((1 - f^2) / f^2 / (D - 1)) (and of the rounding) but for a vanishing share of pairs.
Only vectors whose upper bound reaches the k-th best lower bound are reranked by the exact inner
product of the original vectors.

Queries and vectors meet in a grid of blocks of bounded size, one task a cell: each cell returns
its best for each query, the cells of a query are merged by rank.  Of equal vectors only the
k + 1 smallest ids can be among anybody's k nearest, so the others stay out of the grid, and equal
queries are searched once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import Scratch, map_batches, table

EPSILON = 4.0
CENTRE_ROWS = 4096       # bound of the sample that gives the centre
VECTOR_BLOCK, QUERY_BLOCK = 8192, 8192
QUERY_BITS = 4
SEED = 20240521


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix over ``dim`` filled up to a multiple of 64."""
    wide = -(-dim // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((wide, wide)))
    return (q * np.sign(np.diag(r)))[:dim]


def codes_of(x: np.ndarray, centre: np.ndarray, rotate: np.ndarray):
    """Packed codes (one row of 64-bit words a vector), distances to the centre and f."""
    rest = x - centre
    norm = np.sqrt((rest * rest).sum(axis=1))
    turned = (rest / np.maximum(norm, 1e-300)[:, None]) @ rotate
    bits = np.packbits(turned > 0, axis=1, bitorder="little").view(np.uint64)
    factor = np.abs(turned).sum(axis=1) / math.sqrt(rotate.shape[1])
    return bits, norm, np.maximum(factor, 1e-9)


def estimates(q: np.ndarray, bits, norm, factor, centre, rotate, epsilon: float = EPSILON):
    """Estimated inner products of queries (rows) and coded vectors (columns), and error bounds."""
    wide = rotate.shape[1]
    y = q @ rotate
    low = y.min(axis=1)
    step = np.maximum((y.max(axis=1) - low) / ((1 << QUERY_BITS) - 1), 1e-300)
    level = np.rint((y - low[:, None]) / step[:, None]).astype(np.uint8)
    met = np.zeros((len(q), len(bits)), np.float32)
    for j in range(QUERY_BITS):
        plane = np.packbits(level >> j & 1, axis=1, bitorder="little").view(np.uint64)
        for w in range(wide // 64):
            met += np.float32(1 << j) * np.bitwise_count(plane[:, w, None] & bits[None, :, w])
    ones = np.bitwise_count(bits).sum(axis=1)
    with_code = (2 * (low[:, None] * ones + step[:, None] * met) - y.sum(axis=1)[:, None]) / math.sqrt(wide)
    around = (q * q).sum(axis=1)[:, None] * np.maximum(0, 1 - factor ** 2) / max(1, wide - 1)
    error = epsilon * norm / factor * np.sqrt(around + step[:, None] ** 2 / 12)
    return (q @ centre)[:, None] + norm / factor * with_code, error + 1e-9


def search_block(q_ids, q, ids, x, bits, norm, factor, centre, rotate, k: int, epsilon: float = EPSILON):
    """Exact best ``k`` of a block for each query, among the vectors the bounds let through.

    Those of 64 queries are reranked together by one matrix product, whose rounding depends on a vector's
    place; what is within that rounding of the k-th best gets the score that counts, summed alike for all."""
    out = []
    reach = np.sqrt((x * x).sum(axis=1).max()) if len(x) else 0.0
    for at in range(0, len(q), 64):
        part = q[at:at + 64]
        guess, error = estimates(part, bits, norm, factor, centre, rotate, epsilon)
        low = guess - error
        least = np.partition(low, -k, axis=1)[:, -k] if k < len(ids) else np.full(len(part), -np.inf)
        through = guess + error >= least[:, None]
        some = np.flatnonzero(through.any(axis=0))
        through = through[:, some]
        near = np.where(through, part @ x[some].T, -np.inf)
        if k < len(some):
            margin = 1e-12 * reach * np.sqrt((part * part).sum(axis=1))
            through &= near >= (np.partition(near, -k, axis=1)[:, -k] - margin)[:, None]
        for i, query in enumerate(part):
            few = some[np.flatnonzero(through[i])]
            score = (x[few] * query).sum(axis=1)
            best = np.lexsort((ids[few], -score))[:k]
            out.append((np.full(len(best), q_ids[at + i]), ids[few[best]], score[best]))
    return [np.concatenate(c) for c in zip(*out)] if out else [[], [], []]


def _valid(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the vectors that take part, repeated rows once."""
    sized = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return sized.where(F.col("vec_id").isNotNull() & F.coalesce(finite & some, F.lit(False))).distinct()


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, epsilon: float = EPSILON,
            vector_block: int = VECTOR_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` vectors with the largest inner product, for
    each query, that is each vector whose id is divisible by ``every``.

    All other vectors are candidates; equal scores rank by id.  Null ids, null or zero vectors,
    vectors with null or non-finite components, and vectors whose length is not the most frequent
    one take no part; repeated rows count once.  Without a valid vector the result is empty.
    Other columns are not read.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")
    valid = _valid(vectors)
    size = valid.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = size["dim"]
    valid = scratch.write(valid.where(F.size("embedding") == dim))
    sample = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CENTRE_ROWS).toArrow()
    centre = np.array(sample["embedding"].to_pylist()).mean(axis=0)
    rotate = rotation(dim)
    few = Window.partitionBy("embedding").orderBy("vec_id")
    candidates = valid.withColumn("_n", F.row_number().over(few)).where(F.col("_n") <= k + 1).drop("_n")
    asked = valid.where(F.col("vec_id") % every == 0)
    distinct = scratch.write(asked.groupBy("embedding").agg(F.min("vec_id").alias("search")))

    def encode(cols):
        x = np.array(cols["embedding"], float).reshape(-1, dim)
        bits, norm, factor = codes_of(x, centre, rotate)
        return {"vec_id": cols["vec_id"], "embedding": cols["embedding"], "code": [b.tobytes() for b in bits],
                "norm": norm.tolist(), "factor": factor.tolist()}

    index = scratch.write(map_batches(candidates, encode, "vec_id long, embedding array<double>, code binary, "
                                                          "norm double, factor double"))
    down = max(1, math.ceil(index.count() / vector_block))
    across = max(1, math.ceil(distinct.count() / query_block))
    cells = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (distinct.withColumn("i", F.pmod(F.xxhash64("search"), F.lit(across)).cast("int")).withColumn("j", cells(down)))
    right = (index.withColumn("j", F.pmod(F.xxhash64("vec_id"), F.lit(down)).cast("int")).withColumn("i", cells(across)))

    def cell(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = [[], [], []]
        if len(queries) and len(block):
            x = np.stack(block["embedding"].to_numpy())
            bits = np.frombuffer(b"".join(block["code"]), np.uint64).reshape(len(block), -1)
            found = search_block(queries["search"].to_numpy(), np.stack(queries["embedding"].to_numpy()),
                                 block["vec_id"].to_numpy(), x, bits, block["norm"].to_numpy(),
                                 block["factor"].to_numpy(), centre, rotate, k + 1, epsilon)
        return pd.DataFrame({"search": found[0], "vec_id": found[1], "score": found[2]}).astype(
            {"search": "int64", "vec_id": "int64", "score": "float64"})

    found = (left.groupBy("i", "j").cogroup(right.groupBy("i", "j"))
             .applyInPandas(cell, "search long, vec_id long, score double"))
    best = lambda who: Window.partitionBy(who).orderBy(F.desc("score"), "vec_id")
    merged = scratch.write(found.withColumn("rank", F.row_number().over(best("search")))
                           .where(F.col("rank") <= k + 1).drop("rank"))
    own = asked.join(distinct, "embedding").select(F.col("vec_id").alias("query_id"), "search")
    return (own.join(merged, "search").where("query_id != vec_id")
            .withColumn("rank", F.row_number().over(best("query_id"))).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op5_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all embeddings."""
    return nearest(table(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
