"""Prefix trie of conversations by vertical bitmaps.

1. Each turn is reduced to a digest of its role and text and the text's bytes, so no text is shuffled.
   Conversations are dealt by ranges of their five-block; a task reads them in ascending order and
   cuts them into shards of bounded size.
2. A shard is a vertical index: a posting for each (position, turn) holds the bitset of the
   conversations that have this turn there, and one for each length those that end there.
   Depth first, the bitset of a node is intersected with the postings of its members'
   next turns; each intersection is a child, its popcount the child's members.  On the way
   back a node learns the leaves and the bytes below it.
3. A node of several shards has the same path digest in each: its rows are merged in one pass over the rows
   sorted by node.  Shards hold ascending ids, so the lists of ended conversations are hashed one
   after the other without being joined.
4. A node of one shard is complete there, and so is all below it.  Nodes of several shards are an
   upper part of the trie; what lies below them is summed by pointer doubling, in as many rounds as the
   logarithm of their depth.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import Scratch, arrow_schema, table

FAMILY = 5
PREFIXES = 9
#: a shard is closed at a block's end once it holds so many conversations or turns
SHARD_CONVERSATIONS = 4096
SHARD_TURNS = 1 << 16
ROOT = b"\0" * 16

SHARD_ROWS = ("node binary, parent binary, depth long, bytes long, conv_id long, parent_conv_id long, n_convs long, "
              "n_children long, n_leaves long, saved_tokens long, ends string")
MERGED_ROWS = ("node binary, parent binary, depth long, bytes long, conv_id long, parent_conv_id long, n_convs long, "
               "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, shards long")


def taken_turns(conv_id: int) -> int:
    """Turns a conversation takes from the first of its block."""
    return zlib.crc32(str(conv_id).encode()) % PREFIXES


def turns_of(conversations: DataFrame) -> DataFrame:
    """``block, conv_id, turn, digest, bytes``: what the trie needs of each turn."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    conv_id = F.col("conv_id").cast("long")
    return (conversations.where(conv_id.isNotNull())
            .select((conv_id - conv_id % FAMILY).alias("block"), conv_id.alias("conv_id"),
                    F.col("turn").cast("long").alias("turn"),
                    F.unhex(F.md5(F.concat_ws(":", F.octet_length(role), role, text).cast("binary"))).alias("digest"),
                    F.octet_length(text).cast("long").alias("bytes")))


def _rebuilt(conv: np.ndarray):
    """Ids and, for each rebuilt conversation, the rows of its turns; ``conv`` is ascending and
    holds whole blocks."""
    ids, starts = np.unique(conv, return_index=True)
    ends = np.append(starts[1:], len(conv))
    place = {c: i for i, c in enumerate(ids.tolist())}
    rows = []
    for c, start, end in zip(ids.tolist(), starts.tolist(), ends.tolist()):
        h = taken_turns(c)
        base = place.get(c - int(np.fmod(c, FAMILY)))
        own = range(min(start + h, end), end)
        head = range(0) if base is None else range(starts[base], min(starts[base] + h, ends[base]))
        rows.append([*head, *own])
    return ids, rows


def _bits(bitset: int):
    """Numbers of the set bits, ascending."""
    data = np.frombuffer(bitset.to_bytes((bitset.bit_length() + 7) // 8 or 1, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(data, bitorder="little"))


def shard_nodes(conv: np.ndarray, digest: list[bytes], size: np.ndarray) -> dict[str, list]:
    """The shard's trie as columns of ``SHARD_ROWS``, from its turns in order."""
    ids, rows = _rebuilt(conv)
    size = size.tolist()
    postings: dict[tuple[int, bytes], int] = {}
    ended: dict[int, int] = {}
    for i, turns in enumerate(rows):
        bit = 1 << i
        for position, row in enumerate(turns):
            key = (position, digest[row])
            postings[key] = postings.get(key, 0) | bit
        ended[len(turns)] = ended.get(len(turns), 0) | bit
    names = [c.split()[0] for c in SHARD_ROWS.split(", ")]
    out: dict[str, list] = {name: [] for name in names}

    def visit(node, above, depth, length, members):
        """A row of the node; what its subtree adds is filled in on the way back."""
        ends = members & ended.get(depth, 0)
        first = int(ids[(members & -members).bit_length() - 1])
        count = members.bit_count()
        values = (node, None if above is None else out["node"][above], depth, length, first,
                  None if above is None else out["conv_id"][above], count, 0, 0, (count - 1) * length,
                  ",".join(map(str, ids[_bits(ends)].tolist())) if ends else None)
        for name, value in zip(names, values):
            out[name].append(value)
        return len(out["node"]) - 1, members & ~ends

    parents = [None]
    at, rest = visit(ROOT, None, 0, 0, (1 << len(ids)) - 1)
    stack = [(at, rest)]
    while stack:
        at, rest = stack.pop()
        if not rest:
            continue
        depth = out["depth"][at]
        row = rows[(rest & -rest).bit_length() - 1][depth]
        child = rest & postings[depth, digest[row]]
        stack.append((at, rest & ~child))
        node = hashlib.blake2b(out["node"][at] + digest[row], digest_size=16).digest()
        stack.append(visit(node, at, depth + 1, size[row], child))
        parents.append(at)
        out["n_children"][at] += 1
    leaves, saved = out["n_leaves"], out["saved_tokens"]
    for at in range(len(parents) - 1, -1, -1):  # children come after their parents
        leaves[at] += not out["n_children"][at]
        if at:
            leaves[parents[at]] += leaves[at]
            saved[parents[at]] += saved[at]
    return out


def _shards(turns: DataFrame) -> DataFrame:
    schema = arrow_schema(turns.sparkSession, SHARD_ROWS)

    def closed(parts):
        block, conv, digest, size = (np.concatenate([p[i] for p in parts]) for i in range(4))
        out = shard_nodes(conv, digest.tolist(), size)
        step = 1 << 14
        for i in range(0, len(out["node"]), step):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name][i:i + step], type=f.type) for f in schema],
                                             schema=schema)

    def run(batches):
        parts, n_turns, n_convs = [], 0, 0
        for batch in batches:
            block, conv, size = (batch.column(i).to_numpy() for i in (0, 1, 3))
            digest = np.empty(len(block), object)
            digest[:] = batch.column(2).to_pylist()
            while len(block):
                new = np.flatnonzero(np.diff(block)) + 1
                if parts and parts[-1][0][-1] != block[0]:
                    new = np.concatenate([[0], new])
                # the first end of a block at which the shard is full
                convs = np.concatenate([[0], np.cumsum(np.diff(conv) != 0) + 1])
                full = (n_turns + new >= SHARD_TURNS) | (n_convs + convs[new] >= SHARD_CONVERSATIONS)
                cut = int(new[full.argmax()]) if full.any() else len(block)
                parts.append((block[:cut], conv[:cut], digest[:cut], size[:cut]))
                n_turns, n_convs = n_turns + cut, n_convs + (int(convs[cut - 1]) if cut else 0)
                if cut < len(block) or full.any():
                    yield from closed(parts)
                    parts, n_turns, n_convs = [], 0, 0
                block, conv, digest, size = (a[cut:] for a in (block, conv, digest, size))
        if parts:
            yield from closed(parts)

    ordered = (turns.repartitionByRange("block")
               .sortWithinPartitions("block", "conv_id", F.col("turn").asc_nulls_first(), "digest"))
    return ordered.select("block", "conv_id", "digest", "bytes").mapInArrow(run, SHARD_ROWS)


def _merged(shards: DataFrame) -> DataFrame:
    """One row a node: rows of the same node follow each other, in the order of their ids."""
    schema = arrow_schema(shards.sparkSession, MERGED_ROWS)
    summed = [i for i, f in enumerate(schema) if f.name == "n_convs"][0]

    def run(batches):
        now, sha, done = None, None, []

        def flush():
            rows = [pa.array(c, type=f.type) for c, f in zip(zip(*done), schema)]
            done.clear()
            return pa.RecordBatch.from_arrays(rows, schema=schema)

        for batch in batches:
            for row in zip(*batch.to_pydict().values()):
                *values, ends = row
                if now is not None and now[0] == row[0]:
                    now[summed] += row[summed]
                    now[-1] += 1
                    if ends is not None:
                        sha.update((b"," if sha.any else b"") + ends.encode())
                        sha.any = True
                    continue
                if now is not None:
                    now[-2] = sha.hexdigest()
                    done.append(now)
                    if len(done) >= 1 << 14:
                        yield flush()
                now, sha = [*values, None, 1], _Sha(ends)
        if now is not None:
            now[-2] = sha.hexdigest()
            done.append(now)
            yield flush()

    return (shards.repartition("node").sortWithinPartitions("node", "conv_id")
            .select(*[c.split()[0] for c in SHARD_ROWS.split(", ")]).mapInArrow(run, MERGED_ROWS))


class _Sha:
    """SHA-256 of lists joined by commas."""

    def __init__(self, first: str | None):
        self.any = first is not None
        self.sha = hashlib.sha256((first or "").encode())
        self.update, self.hexdigest = self.sha.update, self.sha.hexdigest


def _below(shared: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, n_leaves, saved_tokens`` summed over each shared node's subtree of shared nodes.

    After k rounds a node holds the sums of what lies less than 2^k below it and points to its
    ancestor 2^k above; it then adds the sums of all that point to it."""
    now = scratch.write(shared.select("node", F.col("parent").alias("above"), "n_leaves", "saved_tokens"))
    while not now.where("above IS NOT NULL").isEmpty():
        add = (now.where("above IS NOT NULL").groupBy(F.col("above").alias("node"))
               .agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")))
        hop = now.select(F.col("node").alias("above"), F.col("above").alias("higher"))
        step = scratch.write(
            now.join(add, "node", "left").join(hop, "above", "left")
            .select("node", F.col("higher").alias("above"),
                    (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                    (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens")))
        scratch.drop(now)
        now = step
    return now


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of rebuilt conversations, one row each (columns ``RESULT``).

    A conversation's turns are ordered by ``turn``, null first; turns with the same number by the MD5
    digest of role and text (equal rows are turns of their own); null roles and texts are empty.
    Conversation ``c`` becomes the first ``h`` turns of ``c - c % 5`` (the remainder has the sign of
    ``c``) and its own from there, with ``h = crc32(decimal c) % 9``.  Rows with a null ``conv_id``
    take no part; an empty table has no conversations and no node.  Texts of any length are read whole; a
    conversation's digests (not its texts) are held by one task, so its turns are bounded by that
    task's memory (some 300 bytes a turn).  Other columns are not read.
    """
    scratch = Scratch(conversations.sparkSession, "prefix-trie")
    shards = scratch.write(_shards(turns_of(conversations)))
    merged = scratch.write(_merged(shards))
    scratch.drop(shards)

    shared = merged.where("shards > 1")
    heads = shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("head"))
    placed = scratch.write(merged.join(heads, "parent", "left")
                           .withColumn("parent_conv_id", F.coalesce("head", "parent_conv_id")))
    # sums over children of shared nodes: those of one shard with all that lies below them
    alone = F.col("shards") == 1
    under = (placed.where("head IS NOT NULL").groupBy(F.col("parent").alias("node"))
             .agg(F.count(F.lit(1)).alias("children"),
                  F.sum(F.when(alone, F.col("n_leaves")).otherwise(0)).alias("leaves"),
                  F.sum(F.when(alone, F.col("saved_tokens")).otherwise(0)).alias("saved")))
    children = F.coalesce("children", F.lit(0).cast("long"))
    upper = scratch.write(
        placed.where("shards > 1").join(under, "node", "left")
        .withColumn("n_leaves", F.coalesce("leaves", F.lit(0)) + (children == 0).cast("long"))
        .withColumn("saved_tokens", F.coalesce("saved", F.lit(0)) + (F.col("n_convs") - 1) * F.col("bytes"))
        .withColumn("n_children", children).drop("children", "leaves", "saved"))
    sums = _below(upper, scratch)
    top = upper.drop("n_leaves", "saved_tokens").join(sums.drop("above"), "node")
    return placed.where("shards = 1").select(*RESULT).unionAll(top.select(*RESULT))


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each with a prefix of its block's first."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


OP13_SQL = """
WITH crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT range::BIGINT AS i FROM range(256))),
turns AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, md5(concat_ws(':', strlen(coalesce(role, '')), coalesce(role, ''),
                                                                coalesce(text, '')))) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (
  SELECT conv_id, own,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''),
                                                                 lambda s: ascii(s)::BIGINT)),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM turns, crc),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.own, [])[1:a.h], a.own[a.h + 1:]) AS path
  FROM heads a LEFT JOIN turns b ON b.conv_id = a.conv_id - a.conv_id % 5),
steps AS (
  SELECT conv_id, len(path) AS n, d, path[1:d] AS prefix, coalesce(strlen(path[d].t), 0) AS bytes
  FROM rebuilt, unnest(range(len(path) + 1)) AS u(d)),
nodes AS (
  SELECT prefix, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends
  FROM steps GROUP BY prefix, d),
kin AS (SELECT a.prefix, a.depth, count(b.prefix) AS n_children, any_value(a.n_convs) AS n_convs,
               any_value(a.bytes) AS bytes
        FROM nodes a LEFT JOIN nodes b ON b.depth = a.depth + 1 AND b.prefix[1:a.depth] = a.prefix
        GROUP BY a.prefix, a.depth),
sums AS (SELECT k.prefix[1:u.d] AS prefix, sum((n_children = 0)::INT) AS n_leaves,
                sum((n_convs - 1) * bytes) AS saved_tokens
         FROM kin k, unnest(range(k.depth + 1)) AS u(d) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, k.n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN kin k ON k.prefix = n.prefix JOIN sums s ON s.prefix = n.prefix
LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.prefix[1:n.depth - 1]
"""
