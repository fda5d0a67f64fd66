"""SimHash near-duplicates: fingerprints, deletion-variant signatures, verification, components.

1. One pass over the texts gives each document a 64-bit fingerprint: a bit is 1 if it is set in
   over half of the XXH64 hashes of the document's word shingles, repeats included.
2. Equal fingerprints fall together; the smallest id of each stands for it.
3. Two fingerprints that differ in at most four bits agree, in one of three segments, on all bits
   but one at most.  Each fingerprint is indexed under every segment with one of its bits struck
   out (64 variants); fingerprints that meet under a variant are verified by their distance.
4. Variants are counted first.  What meets under a variant of at most ``BLOCK`` fingerprints is
   compared in one pass over the sorted index.  A larger variant is verified against its
   smallest member first; where several components remain, its members are compared across
   them in pairs of blocks.  Either way a task returns only links that join something,
   never all pairs, and no variant is cut off.
5. Components of the links, by large-star and small-star.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import Scratch, among, encoded, id_and_text, map_batches, table, without
from blotter.llm.components import components

SEED = 42
DISTANCE = 4
#: first bit and width of each segment: of four differing bits at most one falls into one of them
SEGMENTS = ((0, 21), (21, 21), (42, 22))
BLOCK = 1024
SLICE = 1 << 16


def fingerprint(text: str | None, words: int = 4) -> int:
    """SimHash of the whole text (A-Z lowered), unsigned; without words it is zero."""
    from xxhash import xxh64_digest
    parts = encoded(text).lower().split()
    if not parts:
        return 0
    norm = b" ".join(parts)
    ends = np.cumsum([len(w) + 1 for w in parts])
    last = (ends[min(words, len(parts)) - 1:] - 1).tolist()
    first = [0, *ends[:len(last) - 1].tolist()]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(first), SLICE):
        digests = b"".join([xxh64_digest(norm[a:b], SEED) for a, b in zip(first[i:i + SLICE], last[i:i + SLICE])])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) for every row of ``docs``."""
    def run(cols):
        known: dict[str | None, int] = {}
        for text in cols["text"]:
            if text not in known:
                known[text] = fingerprint(text, words)
        fps = np.array([known[t] for t in cols["text"]], np.uint64).view(np.int64)
        return {"doc_id": cols["doc_id"], "fp": fps}

    return map_batches(id_and_text(docs), run, "doc_id long, fp long")


def variants(distinct: DataFrame) -> DataFrame:
    """``key, fp, rep``, a row for each bit struck out of its segment.  The key holds the bit's
    number and the other bits of the segment, so equal keys are equal variants."""
    def key(bit, start, width):
        rest = ((1 << width) - 1) & ~(1 << (bit - start))
        kept = F.shiftrightunsigned("fp", start).bitwiseAND(F.lit(rest).cast("long"))
        return kept.bitwiseOR(F.lit(bit << 22).cast("long"))

    keys = [key(bit, start, width) for start, width in SEGMENTS for bit in range(start, start + width)]
    return distinct.select(F.explode(F.array(*keys)).alias("key"), "fp", "rep")


def _apart(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Differing bits (numpy counts the bits of a signed number's absolute value)."""
    return np.bitwise_count((one ^ two).view(np.uint64))


def _joined(vertices: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each vertex to the smallest one it is connected with over the pairs, as ids."""
    label = np.arange(len(vertices))
    while True:
        least = np.minimum(label[one], label[two])
        before = label.copy()
        np.minimum.at(label, one, least)
        np.minimum.at(label, two, least)
        np.minimum.at(label, before, label.copy())
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(len(vertices)))
    return vertices[moved], vertices[label[moved]]


def _run_links(key: np.ndarray, fp: np.ndarray, rep: np.ndarray, distance: int):
    """Links among the rows of equal keys (sorted): each row meets the next, the one after, ..."""
    one, two, at, step = [], [], np.flatnonzero(key[1:] == key[:-1]), 1
    while len(at):
        near = at[_apart(fp[at], fp[at + step]) <= distance]
        one.append(near)
        two.append(near + step)
        step += 1
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
    if not one:
        return rep[:0], rep[:0]
    vertices, number = np.unique(rep, return_inverse=True)
    return _joined(vertices, number[np.concatenate(one)], number[np.concatenate(two)])


def _in_runs(index: DataFrame, distance: int) -> DataFrame:
    """Links ``(u, v)`` inside each key; keys have at most ``BLOCK`` rows, so what a batch leaves
    open at its end is bounded too."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        rest = [np.empty(0, np.int64)] * 3
        for batch in _ended(batches):
            rows = rest if batch is None else [np.concatenate([r, b]) for r, b in zip(rest, batch)]
            key = rows[0]
            cut = len(key) if batch is None else int(np.searchsorted(key, key[-1])) if len(key) else 0
            rest = [r[cut:] for r in rows]
            u, v = _run_links(key[:cut], rows[1][:cut], rows[2][:cut], distance)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)

    return (index.repartition("key").sortWithinPartitions("key", "fp")
            .select("key", "fp", "rep").mapInArrow(run, "u long, v long"))


def _ended(batches):
    """Arrow batches as lists of arrays, and None after the last."""
    for batch in batches:
        if batch.num_rows:
            yield [column.to_numpy() for column in batch.columns]
    yield None


def _across(members: DataFrame, distance: int) -> DataFrame:
    """Links between different components under one large variant.

    ``members`` are ``key, size, fp, rep, component``, dealt to blocks of about ``BLOCK``; each pair
    of blocks is a group of its own, so a variant of any size is spread over many tasks."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = (members.withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "fp", "rep", "component", "block",
                     F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))

    def compare(pdf):
        import pandas as pd
        fp, rep, component, block = (pdf[c].to_numpy() for c in ("fp", "rep", "component", "block"))
        one, two = [], []
        second = np.flatnonzero(block == pdf["j"].iat[0])
        for x in np.flatnonzero(block == pdf["i"].iat[0]):
            near = second[(component[second] != component[x])
                          & (_apart(fp[second], fp[x]) <= distance)]
            one.append(np.full(len(near), x))
            two.append(near)
        one, two = (np.concatenate(a) if a else np.empty(0, np.int64) for a in (one, two))
        vertices, number = np.unique(component, return_inverse=True)
        u, v = _joined(vertices, number[one], number[two])
        return pd.DataFrame({"u": u, "v": v})

    return dealt.groupBy("key", "i", "j").applyInPandas(compare, "u long, v long")


def _large(index: DataFrame, large: DataFrame, distance: int, scratch: Scratch) -> DataFrame:
    """Links under the variants of more than ``BLOCK`` fingerprints (``large`` are ``key, size``)."""
    members = scratch.write(among(index, large.select("key"), "key"))
    centres = members.groupBy("key").agg(F.min(F.struct("rep", "fp")).alias("centre"))
    stars = scratch.write(
        members.join(centres, "key")
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("centre.fp"))) <= distance)
        .select(F.col("rep").alias("u"), F.col("centre.rep").alias("v")).where("u != v").distinct())
    label = components(stars, scratch)
    labelled = _labelled(members, label, "rep", "component")
    open_ = (labelled.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"))
             .where("a != b").select("key"))
    across = _across(labelled.join(open_, "key").join(large, "key"), distance)
    return scratch.write(label.unionAll(across))


def _labelled(df: DataFrame, label: DataFrame, on: str, name: str) -> DataFrame:
    """``df`` with the component of its column ``on`` (itself where ``label`` has none)."""
    right = label.select(F.col("u").alias(on), F.col("v").alias("_component"))
    return df.join(right, on, "left").withColumn(name, F.coalesce("_component", on)).drop("_component")


def simhash_duplicates(docs: DataFrame, words: int = 4, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Two documents are linked if their fingerprints differ in at most ``distance`` bits (at most
    five, as three segments then still hold one with at most one of them);
    ``component_id`` is the smallest id reachable over links, itself included.  A null, empty or
    blank text has the fingerprint zero and is linked like any other; a text of fewer than
    ``words`` words is one shingle; a text of any length is read whole.  A repeated id is one
    document with the links of all its texts, and each of its rows is returned (equal rows
    too).  A row with a null id takes no part: its ``component_id`` is null.  Ties do not
    arise (a minimum of ids names a component).  An empty table gives an empty result; only
    ``doc_id`` and ``text`` are read, so other columns' names do not matter.
    """
    if not 0 <= distance <= 2 * len(SEGMENTS) - 1:
        raise ValueError("three segments with one bit struck out find distances of up to five bits")
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.write(fingerprints(docs, words))
    known = prints.where("doc_id IS NOT NULL")
    distinct = scratch.write(known.groupBy("fp").agg(F.min("doc_id").alias("rep")))

    # an id with several fingerprints joins what stands for them
    several = scratch.write(known.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
                            .where("a != b").select("doc_id"))
    own = (among(known, several).distinct().join(distinct, "fp")
           .select(F.col("doc_id").alias("u"), F.col("rep").alias("v")))

    index = variants(distinct)
    large = scratch.write(index.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > BLOCK))
    links = own
    if large.isEmpty():
        links = links.unionAll(_in_runs(index, distance))
    else:
        links = (links.unionAll(_in_runs(without(index, large.select("key"), "key", scratch), distance))
                 .unionAll(_large(index, large, distance, scratch)))
    links = scratch.write(links.distinct())
    label = components(links, scratch)

    named = _labelled(distinct, label, "rep", "component_id").select("fp", "component_id")
    out = prints.join(named, "fp", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      component.alias("component_id"))


def op12_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of four-word shingles, linked at four differing bits, over all documents."""
    return simhash_duplicates(table(spark, sf_dir, "documents"))
