"""The prefix trie against a plain one built from whole prefixes."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import blotter.llm.prefix_trie as prefix_trie
from blotter.llm.prefix_trie import OP13_SQL, RESULT, _bits

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}:{text}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = abs(c) // 5 * 5 * (1 if c >= 0 else -1)
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {p: 0 for p in members}
    leaves, saved = {p: 0 for p in members}, {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, cs in members.items():
        size = len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * size
    return sorted((min(cs), len(p), str(min(members[p[:-1]]) if p else None), len(cs), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(cs) if len(paths[c]) == len(p)).encode()).hexdigest())
                  for p, cs in members.items())


def got(df):
    return sorted((r.conv_id, r.depth, str(r.parent_conv_id), r.n_convs, r.n_children, r.n_leaves, r.saved_tokens,
                   r.ends_sha256) for r in df.collect())


def conversations(seed, ids, texts=4, longest=12):
    rnd = random.Random(seed)
    rows = []
    for c in ids:
        for turn in range(rnd.randint(1, longest)):
            rows.append((c, turn, rnd.choice(["user", "user", None]), rnd.choice([None, "", "é", "yes", "nö " * 3][:texts])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard", [1, 6, 4096])
def test_equals_plain_trie(spark, monkeypatch, shard):
    monkeypatch.setattr(prefix_trie, "SHARD_CONVERSATIONS", shard)
    rows = conversations(shard, [*range(-12, 60), 1003, 1007, 10 ** 12])
    # ties, repeated rows, null turns, null ids
    rows += [(70, 1, "a", "x"), (70, 1, "b", "x"), (70, 1, "a", "x"), (70, None, "z", "first"), (None, 1, "a", "x"),
             (71, None, None, None), (75, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = df.withColumns({c: F.lit(7) for c in ("node", "parent", "block", "digest", "bytes", "depth", "shards", "ends")})
    out = prefix_trie.prefix_trie(df)
    assert tuple(out.columns) == RESULT
    assert got(out) == plain(rows)


def test_many_equal_conversations_over_many_shards(spark, monkeypatch):
    """A third share one first turn, a third are equal: nodes of many shards, merged and summed."""
    monkeypatch.setattr(prefix_trie, "SHARD_CONVERSATIONS", 20)
    rows = []
    for c in range(900):
        for turn in range(11):
            text = f"t{turn}" if c % 3 == 0 or c % 3 == 1 and turn == 0 else f"{c} {turn}"
            rows.append((c, turn, "user", text))
    out = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert got(out) == plain(rows)


def test_long_conversations(spark, monkeypatch):
    """Thousands of turns, equal in two shards: sums by doubling, and a walk without recursion."""
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 1000)
    rows = [(c, turn, "user", f"t{turn}") for c in (0, 50, 100) for turn in range(3000 - c)]
    rows.append((7, 0, "user", "x" * 3_000_000))
    out = {(r.conv_id, r.depth): r for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[0, 0].n_convs == 4 and out[0, 0].n_leaves >= 1
    assert out[0, 2900].n_convs == 3 and out[0, 2900].n_leaves == 1 and out[0, 3000].n_leaves == 1
    depth = {0: 3000, 50: 2950, 100: 2900}
    for c, d in depth.items():
        want = hashlib.sha256(str(c).encode()).hexdigest()
        assert out[0, d].ends_sha256 == want
    bytes_ = [len(f"t{t}") for t in range(3000)]
    assert out[0, 2].saved_tokens == sum(b * ((2 if t < 2900 else 1 if t < 2950 else 0)) for t, b in enumerate(bytes_) if t > 0)


def test_turnless_and_empty(spark):
    rows = [(3, 0, "user", "x"), (8, None, None, None)]  # no first of their block: what they take is missing
    assert got(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sql_agrees(spark, tmp_path):
    rows = conversations(9, range(0, 40), texts=5) + [(None, 0, "a", "b")]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    cur = con.execute(OP13_SQL)
    names = [d[0] for d in cur.description]
    want = sorted(tuple(str(v) if n == "parent_conv_id" else v for n, v in zip(names, r)) for r in cur.fetchall())
    assert tuple(names) == RESULT and want == plain(rows)


def test_bits():
    for bitset in (0, 1, 5, 1 << 300 | 1 << 7):
        assert _bits(bitset).tolist() == [i for i in range(301) if bitset >> i & 1]
