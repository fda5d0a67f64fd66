"""The corpus pipeline: each stage against its operator or a plain version."""

import os
import random
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark, docs_of, labels_of, tmp_path):
    """A small corpus with good, junk, copied, private and empty documents, and its labels."""
    rnd = random.Random(8)
    vocabulary = ["".join(rnd.choice("abcdeiourst") for _ in range(rnd.randint(2, 9))) for _ in range(500)]
    rows, labels = [], []
    for i in range(120):
        w = [rnd.choice(vocabulary) for _ in range(rnd.randint(55, 150))]
        good = i % 4 != 0
        rows.append((i, " ".join(w if good else [x + " |" for x in w]), "en", f"s{i % 5}" if i % 7 else None))
        labels.append((i, int(good), 0))
    rows += [(200 + k, rows[1][1] + (" tail" if k % 2 else ""), "en", "s1") for k in range(6)]
    rows += [(300, rows[2][1] + " write to jo.ne@corp.example.com", "en", "s2"), (301, None), (302, ""),
             (None, rows[3][1], "en", None), (1, rows[1][1], "en", "s1")]
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels_of(labels).write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path), rows


def test_stages(spark, tables):
    sf, rows = tables
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    good = pipeline.quality_stage(spark, docs, sf)
    kept = [r.doc_id for r in good.collect()]
    assert not {i for i in range(0, 120, 4)} & set(kept) and set(range(1, 120, 4)) <= set(kept)
    assert {301, 302}.isdisjoint(kept)

    one = pipeline.dedup_stage(spark, good, sf)
    left = Counter(r.doc_id for r in one.collect())
    assert max(left.values()) == 1 and None in left and 1 in left and not set(range(200, 206)) & set(left)
    assert set(left) == set(kept) - set(range(200, 206)) - {300}

    clean = pipeline.surrogate_stage(spark, good, sf)
    texts = {r.doc_id: r for r in clean.collect()}
    assert "jo.ne" not in texts[300].text and texts[300].n_chars == len(texts[300].text)
    source = dict((d, t) for d, t, *_ in rows)
    assert all(r.text == source[d] for d, r in texts.items() if d != 300)

    mixed = pipeline.mixing_stage(spark, clean, sf)
    assert good.columns == one.columns == clean.columns == mixed.columns == columns
    words = lambda t: (t or "").split()
    for r in mixed.collect():
        assert words(texts[r.doc_id].text)[:len(words(r.text))] == words(r.text) and r.n_chars == len(r.text)

    packed = pipeline.packing_stage(spark, mixed, sf).collect()
    assert sum(r.length for r in packed) == sum(r.doc_tokens for r in packed if r.start == 0)


def test_dedup_stage_keeps_other_texts_of_an_id(spark, docs_of):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (5, c), (5, c), (9, b + " x")]
    got = pipeline.dedup_stage(spark, docs_of(rows), "")
    left = Counter((r.doc_id, r.text) for r in got.collect())
    near = {(5, b): 1} if (5, b) in left else {(9, b + " x"): 1}
    assert left == {(3, a): 1, (5, c): 1, **near}
    assert got.columns == docs_of(rows).columns


def test_dedup_stage_with_the_largest_ids(spark, docs_of):
    """A repeated id needs keys beyond the ids, and there are none above the largest long."""
    top = 2 ** 63 - 1
    a, b = (" ".join(f"{x}{i}" for i in range(80)) for x in "ab")
    rows = [(top, a), (top, b), (-top - 1, b + " x"), (7, a + " y"), (top - 1, "alone")]
    got = pipeline.dedup_stage(spark, docs_of(rows), "")
    left = Counter((r.doc_id, r.text) for r in got.collect())
    # the second text of the repeated id comes after all ids
    assert left == {(-top - 1, b + " x"): 1, (7, a + " y"): 1, (top - 1, "alone"): 1}


def test_run_equals_the_stages(spark, tables):
    sf, _ = tables
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf)
    key = lambda df: sorted((r.doc_id is None, r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    a, b = key(pipeline.run(spark, sf)), key(docs)
    # cuts depend on how documents meet in groups; what is packed does not
    total = lambda rows: Counter((r[1], None) for r in rows)
    assert sum(r[3] for r in a) == sum(r[3] for r in b) and set(total(a)) == set(total(b))


def test_empty_table(spark, docs_of, labels_of, tmp_path):
    docs_of([]).write.parquet(str(tmp_path / "documents.parquet"))
    labels_of([]).write.parquet(str(tmp_path / "labels.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", ["op5_nearest_neighbours", "op9_source_mixing"])
def test_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    cols = sorted(d[0] for d in cur.description)
    order = [[d[0] for d in cur.description].index(c) for c in cols]
    norm = lambda v: round(v, 6) if isinstance(v, float) else v
    want = sorted(str(tuple(norm(r[i]) for i in order)) for r in cur.fetchall())
    got = sorted(str(tuple(norm(r[c]) for c in cols)) for r in entry.queries()[name](spark, SF).collect())
    assert got == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_packed_and_filed_ids_agree(spark):
    """Two queries on the driver's smallest table: pieces and files carry the same documents."""
    packed = {}
    for r in entry.queries()["op3_packing"](spark, SF).collect():
        packed.setdefault(r.doc_id, [0, r.doc_tokens])[0] += r.length
    filed = {r.doc_id: r for r in entry.queries()["op8_token_files"](spark, SF).collect()}
    assert {d: n for d, (n, _) in packed.items()} == {d: r.n_tokens for d, r in filed.items()}
    at = 0
    for d in sorted(filed):
        assert filed[d].start == at
        at += filed[d].n_tokens
