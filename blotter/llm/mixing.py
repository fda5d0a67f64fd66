"""Mixing sources to target weights along a time-varying curriculum.

A source's share of all words follows its weight, up to ``MAX_PASSES`` times its size; what
that leaves over is shared among the others by weight (water-filling).  Its words are taken in
passes over its documents in the order of their hashes; the last pass stops inside the document
that reaches the target.

The schedule of a source tells how its share is spread over the training time 0..1: the density
``1 + ramp * (2 t - 1)`` integrates to the demand ``t + ramp * (t * t - t)``.  A document whose
words start at the share ``q`` of its source's target is due where the demand reaches ``q``: the
quadratic is inverted in closed form.  Sorting by that position interleaves the sources.

Prefix sums over a source are taken in two steps, so a source of any size is spread over many
tasks: sums of hash buckets (about ``BUCKET_ROWS`` rows each), then running sums in a bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import WORD, Scratch, table

WEIGHTS = (5, 2, 1)           # of the sources by code point, repeating
RAMPS = (-0.5, 0.0, 0.5)      # schedules of the sources, repeating: early, even, late
MAX_PASSES = 3
BUCKET_ROWS = 4096


def _cycled(values, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(at, F.lit(len(values))) + 1).cast("int"))


def targets(sizes: DataFrame, weights=WEIGHTS, ramps=RAMPS, max_passes: int = MAX_PASSES) -> DataFrame:
    """``source_size``, ``target`` and ``ramp`` of each source (``no_source, name, size`` rows).

    Sources whose cap is reached first come first; a source is capped if its cap is at most its
    share of what the ones before it have left.  The level of the first uncapped source holds
    for all after it.  Windows here run over one row a source.
    """
    each = sizes.groupBy("no_source", "name").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("no_source", "name")) - 1
    each = (each.withColumn("at", rank).withColumn("weight", _cycled(weights, F.col("at")))
            .withColumn("ramp", _cycled(ramps, F.col("at")))
            .withColumn("cap", max_passes * F.col("source_size")))
    everything = Window.partitionBy(F.lit(1))
    before = (Window.orderBy(F.col("cap") / F.col("weight"), "at")
              .rowsBetween(Window.unboundedPreceding, -1))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    heavy = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    each = (each.withColumn("level", left.cast("double") / heavy)
            .withColumn("open", F.col("cap") > F.col("level") * F.col("weight")))
    first = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "at", "level"))).over(everything)
    return (each.withColumn("common", first.getField("level"))
            .select("no_source", "name", "source_size", "ramp",
                    F.when(F.col("open"), F.col("common") * F.col("weight"))
                    .otherwise(F.col("cap").cast("double")).alias("target")))


def position(words_before: Column, target: Column, ramp: Column) -> Column:
    """When a source's demand reaches ``words_before`` of its ``target``."""
    q = F.least(F.lit(1.0), words_before / target)
    flat = 1 - ramp
    return F.when(q > 0, 2 * q / (flat + F.sqrt(flat * flat + 4 * ramp * q))).otherwise(F.lit(0.0))


def mixture(docs: DataFrame, carry: tuple[str, ...] = (), weights=WEIGHTS, ramps=RAMPS,
            max_passes: int = MAX_PASSES) -> DataFrame:
    """For every row of ``docs``: ``doc_id, size, source_size, target, taken`` and ``positions``,
    the training position of each of its passes (null for the first if nothing is taken).

    ``carry`` names columns of ``docs`` to be kept, in a struct ``row``.  A null text has size 0
    and is never taken; a null source is a source of its own, after all others; null ids share
    one place in the order of hashes.  Repeated rows are documents of their own.  An empty table
    gives an empty result; other columns are not read.  Equal tables give equal rows.
    """
    rows = docs.count()
    bits = max(0, math.ceil(math.log2(max(1, rows / BUCKET_ROWS))))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0)).alias("size"), key.alias("key"),
        F.shiftright(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), 32 - bits).alias("bucket"),
        *([F.struct(*carry).alias("row")] if carry else []))
    scratch = Scratch(docs.sparkSession, "mixing")
    if not carry:
        base = scratch.write(base)
    sums = scratch.write(base.groupBy("no_source", "name", "bucket").agg(F.sum("size").alias("size")))
    earlier = Window.partitionBy("no_source", "name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sums.withColumn("offset", F.coalesce(F.sum("size").over(earlier), F.lit(0))).drop("size")
               .join(targets(sums, weights, ramps, max_passes), ["no_source", "name"]))
    inside = (Window.partitionBy("no_source", "name", "bucket").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    due = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(due / F.col("source_size"))).otherwise(F.lit(0))
    rest = due - F.col("passes") * F.col("source_size")
    last = F.greatest(F.lit(0), F.least("size", rest - F.col("before")))
    times = F.col("passes") + (F.col("last") > 0).cast("long")
    starts = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), times - 1).cast("long")),
                         lambda n: position((n * F.col("source_size") + F.col("before")).cast("double"),
                                            F.col("target"), F.col("ramp")))
    return (base.join(offsets, ["no_source", "name", "bucket"])
            .withColumn("before", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .withColumn("passes", passes.cast("long")).withColumn("last", last.cast("long"))
            .withColumn("taken", F.col("passes") * F.col("size") + F.col("last"))
            .withColumn("positions", F.when(F.col("taken") > 0, starts))
            .select("doc_id", "size", "source_size", "target", "taken", "positions", *(["row"] if carry else [])))


def placements(mixed: DataFrame) -> DataFrame:
    """One row per document and pass in training order: the words of the pass (the last may stop
    inside the document) and its ``position``; rows are range-sorted by it."""
    each = mixed.where("taken > 0").select("*", F.posexplode("positions").alias("pass", "position"))
    words = F.least(F.col("size"), F.col("taken") - F.col("pass") * F.col("size"))
    return each.withColumn("words", words).drop("positions").orderBy("position", "doc_id", "pass")


def op9_source_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents with what the mix takes of them, in the order of their first position."""
    mixed = mixture(table(spark, sf_dir, "documents"))
    return (mixed.withColumn("position", F.get("positions", F.lit(0))).drop("positions")
            .orderBy(F.col("position").asc_nulls_last(), "doc_id"))


OP9_SQL = """
WITH base AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS nth FROM sources),
weighed AS (SELECT *, CASE nth % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
                   CASE nth % 3 WHEN 0 THEN -0.5::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS ramp,
                   3 * source_size AS cap FROM ranked),
levelled AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS DOUBLE) AS level
  FROM weighed WINDOW w AS (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
capped AS (SELECT *, cap > level * weight AS open FROM levelled),
targets AS (
  SELECT source, source_size, ramp,
         CASE WHEN open THEN (SELECT level FROM capped WHERE open ORDER BY cap / weight, nth LIMIT 1) * weight
              ELSE CAST(cap AS DOUBLE) END AS target FROM capped),
placed AS (
  SELECT b.*, t.source_size, t.target, t.ramp, CAST(round(t.target) AS BIGINT) AS due,
         coalesce(sum(size) OVER (PARTITION BY b.source ORDER BY key, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source),
passed AS (SELECT *, CASE WHEN source_size > 0 THEN due // source_size ELSE 0 END AS passes FROM placed),
taking AS (SELECT *, passes * size + greatest(0, least(size, due - passes * source_size - before)) AS taken,
                  least(1.0::DOUBLE, before / target) AS q FROM passed)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken = 0 THEN NULL WHEN q > 0
            THEN 2 * q / ((1 - ramp) + sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * q)) ELSE 0.0::DOUBLE END AS position
FROM taking
"""
