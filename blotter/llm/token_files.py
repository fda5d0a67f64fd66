"""Token-id files: whole documents' ids, in id order, in coded frames.

Documents are range-sorted by id; each task tokenises its range and writes frames of about
``FRAME_IDS`` ids (whole documents; a longer document makes a longer frame).  A file is a Parquet
file with one frame a row: the coded ids (see ``idcoder``), the documents' ids and lengths, and
the frame's place (range and number in it), so files are committed, retried and read by Spark
like any table.  The ids before a frame are the running sum over the frames' counts: one small
row a frame.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm import idcoder
from blotter.llm.common import Scratch, arrow_schema, give_back_memory, id_and_text, slices, table
from blotter.llm.tokens import END_ID, encoder, public_path

FRAME_IDS = 1 << 22
PREFIX = 16  # signs of a text that tell rows of one id apart where ranges are cut
FRAMES = "part long, frame long, n_ids long, doc_ids array<long>, lengths array<long>, coded binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
              frame_ids: int = FRAME_IDS) -> None:
    """Write the ids of all ``docs`` (``doc_id, text``) as frames in ascending ``doc_id`` order.

    A null text is its end id alone.  Null ids come first; rows with equal ids come in the order
    of their texts.  Other columns are not read; an empty table writes no frame.
    """
    tokenizer = tokenizer or public_path()
    schema = arrow_schema(docs.sparkSession, FRAMES)

    def frame_of(part, number, ids, blobs):
        flat = np.frombuffer(b"".join(blobs), "<u4")
        row = (part, number, len(flat), ids, [len(b) // 4 for b in blobs], idcoder.encode(flat))
        return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, schema)], schema=schema)

    def run(batches):
        from pyspark import TaskContext
        part, number, size, ids, blobs = TaskContext.get().partitionId(), 0, 0, [], []
        known = encoder(tokenizer)
        for some in slices(batches):
            rows = some.to_pydict()
            for doc_id, blob in zip(rows["doc_id"], known.encode(rows["text"], end_id)):
                ids.append(doc_id)
                blobs.append(blob)
                size += len(blob) // 4
                if size >= frame_ids:
                    yield frame_of(part, number, ids, blobs)
                    number, size, ids, blobs = number + 1, 0, [], []
            del some, rows
        known.forget()
        if ids:
            yield frame_of(part, number, ids, blobs)
        del ids, blobs
        give_back_memory()

    in_order(docs).mapInArrow(run, FRAMES).write.option("compression", "none").parquet(path)


def in_order(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` by id, then text.  Ranges are cut by ids and the texts' first signs, as the sample that
    finds the cuts goes to the driver."""
    return (id_and_text(docs).repartitionByRange("doc_id", F.substring("text", 1, PREFIX))
            .sortWithinPartitions("doc_id", "text"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of every document in the files; ``start`` counts the ids of all
    documents before it, ``ids`` are little-endian uint32 bytes.  A damaged block raises."""
    frames = spark.read.schema(FRAMES).parquet(path)
    before = Window.orderBy("part", "frame").rowsBetween(Window.unboundedPreceding, -1)
    # the frames are joined with their places, one row a frame, before any is decoded
    places = frames.select("part", "frame", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))
    decoded = "doc_id long, start long, ids binary"
    schema = arrow_schema(spark, decoded)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: v[0] for k, v in batch.slice(i, 1).to_pydict().items()}
                flat = idcoder.decode(row["coded"]).astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                first = row["before"]
                blob = flat.tobytes()
                n = len(ends)
                for at in range(0, n, 4096):
                    some = range(at, min(n, at + 4096))
                    cols = (row["doc_ids"][at:at + 4096], (starts[at:at + 4096] + first).tolist(), [blob[4 * starts[k]:4 * ends[k]] for k in some])
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)],
                                                     schema=schema)

    return (frames.join(places, ["part", "frame"]).select("before", "doc_ids", "lengths", "coded")
            .mapInArrow(run, decoded))


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    """All documents written, read back and reduced to counts and checksums."""
    path = Scratch(spark, "token-ids").path()
    write_ids(table(spark, sf_dir, "documents"), path)
    return read_ids(spark, path).select("doc_id", "start", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
                                        F.crc32("ids").alias("ids_crc32"))
