"""Shared helpers of the training-data operators.

Words are the runs of ``[^\\x20\\x09-\\x0D]`` everywhere: on UTF-8 bytes that is
exactly what ``bytes.split()`` returns, so tasks split encoded texts and never
meet Unicode white space rules.
"""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns an operator reads, whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def id_remainder(n: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as decimal text, modulo ``n`` (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def encoded(text: str | None) -> bytes:
    """UTF-8 bytes of a text; null is the empty text."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


ROWS = 2048


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with a function from a pandas-free dict of Python lists to a dict of
    columns, called once per ``ROWS`` rows at most."""
    arrow = arrow_schema(df.sparkSession, schema)

    def one(some):
        out = fn(some.to_pydict())
        return pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(lambda batches: map(one, slices(batches)), schema)


def slices(batches):
    """The Arrow batches of a task in slices of ``ROWS`` rows at most (the session's
    ``spark.sql.execution.arrow.max*PerBatch`` bound them too widely for Python objects).

    What the worker has freed is returned after each batch and at the end of the task: workers
    outlive their tasks, and an executor's memory holds all of them beside the JVM."""
    for whole in batches:
        for start in range(0, whole.num_rows, ROWS):
            yield whole.slice(start, ROWS)
        del whole
        give_back_memory()


def give_back_memory() -> None:
    """Return what this Python process has freed to the system (where its C library can)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


#: A bitmap has so many bits for each id, 2**MIN_BITS at least and 2**BITMAP_BITS (2**20 rows of two longs) at most.
BITS_PER_ID = 16
MIN_BITS, BITMAP_BITS = 16, 26


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no helper column can clash with them; ``__row.*``
    takes it apart again."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")


def _flagged(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """``__row, __id, __maybe`` for each row of ``df``: false only if its ``on`` is null or surely not in
    the one column of ``ids``, by a hashed bitmap sized by their number (at most 2**BITMAP_BITS bits, so a
    broadcast of bounded size)."""
    bits = min(BITMAP_BITS, max(MIN_BITS, (number_of_rows(ids) * BITS_PER_ID).bit_length()))
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))
    flag = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(c, F.lit(64)).cast("int"))
    bitmap = (ids.toDF("__id").select(spot(F.col("__id")).alias("__spot"))
              .select(F.shiftright("__spot", 6).alias("__word"), flag(F.col("__spot")).alias("__bit"))
              .groupBy("__word").agg(F.bit_or("__bit").alias("__bits")))
    near = (df.select(whole_row(df), F.col(f"`{on}`").alias("__id"), spot(F.col(f"`{on}`")).alias("__spot"))
            .withColumn("__word", F.shiftright("__spot", 6)).join(F.broadcast(bitmap), "__word", "left"))
    met = F.coalesce(F.col("__bits").bitwiseAND(flag(F.col("__spot"))) != 0, F.lit(False))
    return near.select("__row", "__id", (met & F.col("__id").isNotNull()).alias("__maybe"))


def among(df: DataFrame, ids: DataFrame, on: str = "doc_id") -> DataFrame:
    """The rows of ``df`` whose ``on`` is in the one column of ``ids`` (a written table, as it is read several
    times).  The bitmap drops most other rows before anything is shuffled; the semi-join behind it is exact."""
    if not number_of_rows(ids):
        return df.where(F.lit(False))
    near = _flagged(df, ids, on).where("__maybe")
    return near.join(ids.toDF("__id"), "__id", "left_semi").select("__row.*")


def without(df: DataFrame, ids: DataFrame, on: str = "doc_id", scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``df`` whose ``on`` is null or not in the one column of ``ids`` (a written table).

    Rows that the bitmap clears pass; which others stay is found on their ids alone, and written, so that the
    rows themselves are shuffled only where a second bitmap, of the few ids that stay, cannot clear them.
    """
    if not number_of_rows(ids):
        return df
    scratch = scratch or Scratch(df.sparkSession, "without")
    flagged = _flagged(df, ids, on)
    stay = scratch.write(flagged.where("__maybe").select("__id").distinct()
                         .join(ids.toDF("__id"), "__id", "left_anti"))
    rest = among(flagged.where("__maybe").select("__row", "__id"), stay, "__id")
    return flagged.where("NOT __maybe").select("__row.*").unionAll(rest.select("__row.*"))


# ---------------------------------------------------------------- shared intermediate tables

def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` as the session names it, else
    (in tests and single-machine runs that set none) a folder of the warehouse, which Spark
    itself needs to be shared."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/llm_scratch"


class Scratch:
    """Intermediate tables written as Parquet under the shared folder.

    A written table cuts the lineage: after the loss of an executor the next step rereads the
    files instead of recomputing everything before them.  ``drop`` removes a table as soon as
    no plan needs it; what is left goes when the driver's JVM ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        path, fs = self._hadoop(self.root)
        fs.deleteOnExit(path)

    def _hadoop(self, where: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(where)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def path(self) -> str:
        self.count += 1
        return f"{self.root}/{self.count}"

    def write(self, df: DataFrame, *measures: Column) -> DataFrame:
        """``df`` written and read again.  Its number of rows and the aggregates ``measures`` are taken while it
        is written (``measured``): a query less each."""
        where, seen = self.path(), Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *measures).write.parquet(where)
        out = self.spark.read.schema(df.schema).parquet(where)
        out._scratch_path, out._scratch_measured = where, seen.get
        return out

    def drop(self, *written: DataFrame | None) -> None:
        """Delete tables that no plan needs any more.  What their queries left (plans, shuffle files, broadcasts)
        Spark keeps until the driver's JVM collects its garbage, so that is asked for."""
        for df in written:
            if df is not None:
                path, fs = self._hadoop(df._scratch_path)
                fs.delete(path, True)
        self.spark.sparkContext._jvm.System.gc()


def measured(written: DataFrame) -> dict:
    """What ``Scratch.write`` measured of a table (``rows`` and the aggregates asked for); empty for others."""
    return vars(written).get("_scratch_measured", {})


def number_of_rows(df: DataFrame) -> int:
    """Counted while it was written, if it was."""
    rows = measured(df).get("rows")
    return df.count() if rows is None else rows
