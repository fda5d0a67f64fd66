"""Near-duplicate classes and components against brute force."""

import random

import numpy as np
import pytest

import blotter.llm.minhash as minhash
from blotter.llm.common import Scratch, among, without
from blotter.llm.components import components
from blotter.llm.minhash import bands_for, near_duplicates, shingle_hashes


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, n):
    w = words(text)
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def classes(rows, n, part):
    """Smallest id reachable, by all pairs."""
    sets = [(d, shingles(t, n)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= part * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in parent}


def corpus(seed, n=40, families=12):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(families):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 4, 30, 80, 300]))]
        for _ in range(rnd.randint(1, n // families + 3)):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4, 8])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append(" ".join(copy).upper() if rnd.random() < .2 else "  ".join(copy))
    rnd.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("n, part", [(3, 85), (5, 80)])
def test_classes_equal_brute_force(docs_of, n, part):
    rows = corpus(n) + [(1, None), (4, ""), (7, " \n"), (None, "w1 w2 w3 w4"), (10, "same text here now"),
                        (13, "same text here now"), (16, "Same  TEXT here now"), (16, "Same  TEXT here now"),
                        (19, "É a b c"), (22, "é a b c")]
    got = near_duplicates(docs_of(rows), words=n, part=part).collect()
    assert len(got) == len(rows)
    want = classes(rows, n, part)
    size = {}
    for d, t in rows:
        size.setdefault(d, len(shingles(t, n)))
    for r in got:
        assert r.n_shingles == size[r.doc_id]
        assert r.component_id == (want[r.doc_id] if r.doc_id is not None else None)
        assert r.kept == (r.doc_id is not None and r.doc_id == r.component_id)


def test_family_spread_over_blocks(docs_of, monkeypatch):
    """A chain of near copies in which most pairs are no links, dealt to many small blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rnd = random.Random(9)
    text = [f"a{rnd.randrange(900)}" for _ in range(120)]
    rows = []
    for i in range(40):
        rows.append((1000 - i, " ".join(text)))
        for _ in range(3):
            text[rnd.randrange(len(text))] = f"b{rnd.randrange(900)}"
    got = {r.doc_id: r.component_id for r in near_duplicates(docs_of(rows), words=3, part=85).collect()}
    assert got == classes(rows, 3, 85)


def test_repeated_id_keeps_the_links_of_all_its_texts(docs_of):
    """One text of id 5 is a copy of another id's, the other one is near a third."""
    a, b = ([f"{c}{i}" for i in range(80)] for c in "ab")
    rows = [(3, " ".join(a)), (5, " ".join(a)), (5, " ".join(b)), (9, " ".join(b + ["x"])), (11, "c " + " ".join(b))]
    got = near_duplicates(docs_of(rows), words=3, part=85).collect()
    assert [(r.doc_id, r.component_id) for r in sorted(got, key=lambda r: r.doc_id)] == [(d, 3) for d, _ in rows]


def test_empty_table(docs_of):
    assert near_duplicates(docs_of([])).count() == 0


def test_hashes_tell_shingles_apart():
    texts = [" ".join(str(random.Random(i).random()) for _ in range(200)) for i in range(20)]
    for t in texts:
        assert len(shingle_hashes(t, 3)[0]) == len(shingles(t, 3))
    assert len(shingle_hashes("b " * 70000, 3)[0]) == 1


def test_bands_meet_the_miss_bound():
    for threshold in (0.8, 0.85, 0.9):
        bands, rows = bands_for(threshold)
        assert bands * rows <= minhash.HASHES and (1 - threshold ** rows) ** bands <= minhash.MISS


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    df = spark.createDataFrame(edges + edges[:9], "u long, v long")
    got = {r.u: r.v for r in components(df, Scratch(spark, "t")).collect()}
    parent = list(range(500))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert got == {x: root(x) for x in range(500) if root(x) != x}
    none = components(spark.createDataFrame([], "u long, v long"), Scratch(spark, "t"))
    assert none.count() == 0


def test_bitmap_split_is_exact(spark, monkeypatch):
    import blotter.llm.common as common
    df = spark.range(500).selectExpr("CASE WHEN id % 50 = 7 THEN null ELSE id END AS doc_id", "id AS x")
    ids = spark.range(0, 500, 3).toDF("some")
    for bits in (24, 6):  # the small one is full of false hits
        monkeypatch.setattr(common, "BITMAP_BITS", bits)
        a = {r.x for r in among(df, ids).collect()}
        b = {r.x for r in without(df, ids).collect()}
        assert a == {i for i in range(500) if i % 3 == 0 and i % 50 != 7} and a | b == set(range(500)) and not a & b


def test_signature_estimates_similarity():
    a, b = minhash._hash_functions(320)
    x = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    one, two = minhash.signature(x[:900], a, b), minhash.signature(x[100:], a, b)
    assert abs((one == two).mean() - 0.8) < 0.1


def test_components_take_one_query_a_round(spark, monkeypatch):
    """Counts and checksums come with the tables as they are written."""
    edges = [(i, i + 1) for i in range(20)] + [(40, 30), (40, 35), (50, 50)]
    table = spark.createDataFrame(edges, "u long, v long")
    kind = type(table)
    with monkeypatch.context() as patched:
        for name in ("first", "count", "collect", "isEmpty"):
            patched.setattr(kind, name, lambda *_: pytest.fail("a query beside the rounds"))
        found = components(table, Scratch(spark, "rounds"))
        none = components(table.where("u > 60"), Scratch(spark, "no-rounds"))
    want = {(i, 0) for i in range(1, 21)} | {(40, 30), (35, 30)}
    assert {tuple(r) for r in found.collect()} == want and none.collect() == []


def test_without_and_among(spark, tmp_path):
    """Null ids stay in what is left, repeated rows too; a table is read twice at most, and once if no id goes."""
    rows = [(i, f"t{i}") for i in range(50)] + [(7, "t7"), (8, "other"), (None, "none"), (None, None)]
    spark.createDataFrame(rows, "doc_id long, carried string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    scratch = Scratch(spark, "without-among")
    some, no = (scratch.write(spark.createDataFrame([(i,) for i in ids], "doc_id long")) for ids in ([7, 9, 99], []))
    order = lambda found: sorted(map(tuple, found), key=str)
    inside = [r for r in rows if r[0] in (7, 9)]
    assert order(without(df, some).collect()) == order(r for r in rows if r not in inside)
    assert order(among(df, some).collect()) == order(inside)
    assert order(without(df, no).collect()) == order(rows) and among(df, no).collect() == []
    assert without(df, some).columns == among(df, no).columns == df.columns

    def reads(found):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        return sum("Relation" in line and "carried" in line for line in plan.splitlines())

    assert reads(without(without(df, some), some)) <= 4 and reads(without(df, no)) == 1
