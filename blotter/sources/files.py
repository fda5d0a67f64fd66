"""Delimited-file sources and table sinks.

CSV is read with its header and every column as text: no inference pass
over the data (which would read the whole file once more), then columns are
picked by name and cast to the canonical types with ``try_cast``.  Picking
by name matters: an explicit schema on a CSV applies by position.

Tables are written beside their place and moved there when whole, so a reader
never meets a half-written one and a failed write leaves the old one as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.operators.integrate import conform, union_sources


def _first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(line, paths)``: the files that begin with each line, blank lines and empty files left out.

    One job over the text of all files, whatever their number: a first line is the one of the file's
    first block that its task reads first, a partial minimum per file."""
    lines = (spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"),
                                           F.col("_metadata.file_block_start").alias("start"), "value")
             .where((F.col("start") == 0) & (F.trim("value") != "")))
    first = (lines.withColumn("at", F.monotonically_increasing_id())
             .groupBy("path").agg(F.min_by("value", "at").alias("line")))
    return first.groupBy("line").agg(F.array_sort(F.collect_list("path")).alias("paths"))


def read_csv_text(spark: SparkSession, path: str | Sequence[str],
                  columns: Sequence[str] | None = None, same_header: bool = False) -> DataFrame:
    """Headered CSV, all columns text; optionally only ``columns``.

    Files of a folder, glob or list may differ in their headers: files with one
    header are read together, the groups united by column name, and a column
    that a group lacks is NULL there.  The headers of all files are found in one
    job, and Spark resolves one file of each distinct header.  With ``same_header``
    that job is left out (it reads the text once more): the first file's
    header holds for all, and reading a file with another one fails.  A column
    of ``columns`` missing from all is NULL.
    """
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("mode", "PERMISSIVE").option("multiLine", False))
    paths = [path] if isinstance(path, str) else list(path)
    if same_header:
        df = reader.option("enforceSchema", False).csv(paths)
    else:
        groups = [[unquote(p) for p in r.paths] for r in _first_lines(spark, paths).collect()]
        groups.sort()
        df = union_sources([reader.csv(same) for same in groups]) if len(groups) > 1 else reader.csv(paths)
    return conform(df, columns) if columns is not None else df


def read_csv_typed(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Headered CSV conformed to ``schema`` by column name (bad values NULL)."""
    return conform(read_csv_text(spark, path), [f.name for f in schema.fields], schema)


class TableExists(Exception):
    """A table is in the way and the mode does not replace it."""


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] = (), header: bool = True) -> None:
    """Q13: write a result in parallel (never one task for all).

    ``mode``: ``overwrite``, ``append``, ``errorifexists`` (fail if present) or
    ``ignore`` (write only if absent).  Partitioning by a year column lets
    later date cuts skip whole folders; rows are rebalanced by it first, so that a year
    has a few files of Spark's advisory size whatever the number of tasks, and
    a year with most of the rows is still split.

    All modes but ``append`` write a new table beside ``path`` and rename it when it is whole: if the
    write fails, the old table stays and can be read, and the table may read the
    one it replaces.  (Where a rename is a copy, as in object stores, the swap is not atomic.)
    ``append`` leaves what it adds to Spark's commit protocol.
    """
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def save(where: str, how: str) -> None:
        rows = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
        w = rows.write.mode(how).format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if fmt == "csv":
            w = w.option("header", header)
        w.save(where)

    if mode == "append":
        return save(path, "append")
    if mode not in ("overwrite", "errorifexists", "error", "ignore"):
        raise ValueError(f"unknown mode {mode!r}")
    there = fs.exists(target)
    if there and mode == "ignore":
        return None
    if there and mode != "overwrite":
        raise TableExists(f"{path} exists")
    tag = uuid.uuid4().hex
    new, old = (hadoop.Path(target.getParent(), f".{target.getName()}-{kind}-{tag}") for kind in ("new", "old"))
    try:
        save(new.toString(), "errorifexists")
        if there and not fs.rename(target, old):
            raise OSError(f"could not move {path} aside")
        if not fs.rename(new, target):
            if there:
                fs.rename(old, target)
            raise OSError(f"could not move the new table to {path}")
    finally:
        fs.delete(new, True)
    if there:
        fs.delete(old, True)
    return None


def write_and_reload(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                     fmt: str = "parquet") -> DataFrame:
    """Write, then read back: cuts the lineage so later branches start from the table."""
    write_table(df, path, "overwrite", fmt, partition_by)
    reader = df.sparkSession.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)
