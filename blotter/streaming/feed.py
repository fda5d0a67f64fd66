"""The year-to-date incident feed as a stream of dropped files.

The stream only ingests: every row of every file is appended, as it is, to a
Parquet table (exactly once, by the file sink's log), with no watermark and no
state.  The monthly count is a batch over what has landed: first row per key,
date rule, count.  So the counts do not depend on how files fall into triggers
or in which order their dates come, and late rows count like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from blotter.functions.dates import date_with_fallback
from blotter.operators.integrate import dedup_first
from blotter.operators.trend import monthly_counts
from blotter.session import ensure_checkpoint_dir


def read_feed(spark: SparkSession, path: str, columns: Sequence[str],
              max_files_per_trigger: int | None = None, fmt: str = "csv",
              schema: T.StructType | None = None, base_path: str | None = None) -> DataFrame:
    """Files landing under ``path`` (a folder or a glob) as a stream of ``columns``.

    CSV: ``schema``, or by default all-text ``columns``, must be the files' full
    header in order: a file with another header fails the stream
    (``enforceSchema`` is off) instead of filling columns by position.  Other
    formats read ``columns`` of an explicit ``schema`` by name.  ``base_path``: the
    folder a glob is relative to.
    """
    if schema is None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if base_path:
        reader = reader.option("basePath", base_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(*columns)


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """``<shared folder>/streams/<name>``, see :func:`blotter.session.ensure_checkpoint_dir`."""
    return f"{ensure_checkpoint_dir(spark)}/streams/{name}"


def ingest_feed(feed: DataFrame, out: str, name: str, checkpoint: str | None = None,
                available_now: bool = False) -> StreamingQuery:
    """Append every row of ``feed`` to the Parquet table ``out``."""
    w = (feed.writeStream.outputMode("append").format("parquet").queryName(name)
         .option("path", out)
         .option("checkpointLocation", checkpoint or stream_checkpoint(feed.sparkSession, name)))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def landed_monthly_counts(landed: DataFrame, key: str, start_date: str, end_date: str | None = None,
                          pattern: str = "M/d/yyyy", by: Sequence[str] = ()) -> DataFrame:
    """Monthly counts of the landed rows, each key once (its earliest date first, NULL
    before all, then every other column), rows without a date left out after that."""
    dated = landed.withColumn("_date", date_with_fallback(start_date, end_date, pattern, landed))
    once = dedup_first(dated, key, ["_date"]).where(F.col("_date").isNotNull())
    return monthly_counts(once, "_date", by)
