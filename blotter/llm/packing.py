"""Cost-balanced packing of documents into training sequences.

A piece of ``l`` tokens costs ``l + quadratic * l * l``: the linear part stands for the
matrix products per token, the quadratic one for attention inside the piece (a document mask
keeps pieces of one sequence apart).  Documents are taken in descending order of cost and go
to the cheapest sequence with enough room; a document that fits nowhere is cut, its first
part filling the cheapest sequence that has room at all.

Packing works on groups of about ``group_tokens`` ids which each task gathers from its own
input partition, so nothing is shuffled, a hot source cannot unbalance anything, and a task
holds one group (and at least one document) at a time.  The rooms of a group add up to its
ids: ``total // capacity`` full sequences and, for the rest, one sequence for each power of
two in it, which needs no padding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import arrow_schema, give_back_memory, id_and_text, slices, table
from blotter.llm.tokens import END_ID, encoder, public_path

CAPACITY = 2048
GROUP_TOKENS = 1 << 20
#: attention against matrix products of a width-768 transformer: 4dl of 24dd per token
QUADRATIC = 1 / (6 * 768)

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long, sequence_tokens long, sequence_cost double")


def rooms(total: int, capacity: int) -> np.ndarray:
    """Sequence sizes for ``total`` ids: full ones, then the powers of two of the rest."""
    rest = total % capacity
    tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([capacity] * (total // capacity) + tail, np.int64)


def assign(lengths: list[int], capacity: int = CAPACITY, quadratic: float = QUADRATIC):
    """Pieces ``(document, start, length, sequence, offset)`` and the cost of each sequence.

    Ties go to the earlier document and the earlier sequence, so the same group always gives
    the same pieces.
    """
    size = rooms(int(sum(lengths)), capacity)
    room, cost = size.copy(), np.zeros(len(size))
    pieces = []

    def put(doc, start, length, s):
        pieces.append((doc, start, length, s, int(size[s] - room[s])))
        room[s] -= length
        cost[s] += length + quadratic * length * length

    free = 0  # sequences before it are taken by whole-sequence pieces
    rests = []
    for doc, n in enumerate(lengths):
        start = 0
        while n - start >= capacity and free < len(size) and size[free] == capacity:
            put(doc, start, capacity, free)  # an empty sequence is the cheapest
            free, start = free + 1, start + capacity
        if n > start:
            rests.append((n - start, doc, start))
    rests.sort(key=lambda x: (-x[0], x[1]))
    for left, doc, start in rests:
        while left:
            price = np.where(room >= left, cost, np.inf)
            s = int(price.argmin())
            if price[s] == np.inf:
                s = int(np.where(room > 0, cost, np.inf).argmin())
            take = min(left, int(room[s]))
            put(doc, start, take, s)
            left, start = left - take, start + take
    return pieces, cost


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
         group_tokens: int = GROUP_TOKENS, end_id: int = END_ID,
         quadratic: float = QUADRATIC) -> DataFrame:
    """One row per piece, with its ids (little-endian uint32) and its place in a sequence.

    A null text is empty: its document is the end id alone.  A null id, repeated rows and
    equal ids are packed like any other row.  ``sequence_id`` is unique over the table: the
    partition's number and a count within it.  An empty table gives no rows; other columns of
    ``docs`` are not read.
    """
    path = tokenizer or public_path()
    schema = arrow_schema(docs.sparkSession, SCHEMA)

    def packed(ids, blobs, first):
        pieces, cost = assign([len(b) // 4 for b in blobs], capacity, quadratic)
        sizes = {}
        for _, _, length, s, _ in pieces:
            sizes[s] = sizes.get(s, 0) + length
        cols = list(zip(*((ids[d], start, n, blobs[d][4 * start:4 * (start + n)], len(blobs[d]) // 4,
                           first + s, offset, sizes[s], float(cost[s]))
                          for d, start, n, s, offset in pieces)))
        return (pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)],
                                           schema=schema), len(cost))

    def run(batches):
        from pyspark import TaskContext
        known = encoder(path)
        first = TaskContext.get().partitionId() << 32
        ids, blobs, size = [], [], 0
        for some in slices(batches):
            part = some.to_pydict()
            for doc_id, blob in zip(part["doc_id"], known.encode(part["text"], end_id)):
                ids.append(doc_id)
                blobs.append(blob)
                size += len(blob) // 4
                if size >= group_tokens:
                    out, n = packed(ids, blobs, first)
                    yield out
                    first, ids, blobs, size = first + n, [], [], 0
            del some, part
        known.forget()
        if blobs:
            yield packed(ids, blobs, first)[0]
        del ids, blobs
        give_back_memory()

    return id_and_text(docs).mapInArrow(run, SCHEMA)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    """Pieces of all documents; the ids are reduced to their checksum."""
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "sequence_tokens", "sequence_cost")
