"""Base counts against plain statements; held-out accuracy of the trained classifiers."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm import quality_rules as rules
from blotter.llm import quality_trees as trees
from blotter.llm.common import id_remainder
from blotter.llm.quality_rules import kept_documents, quality_rules
from blotter.llm.quality_trees import quality_scores
from blotter.llm.toxicity import log_count_ratios, toxicity


def plain_counts(text):
    raw = (text or "").encode()
    w = raw.split()
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(len(x.decode()) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered))


def counts(text):
    raw = (text or "").encode()
    words = raw.split()
    table = rules.word_table(None)
    table.learn([words])
    return rules.base_counts(raw, text, words, table.numbers(words))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é#|\n\t \x1c", max_size=60))
def test_base_counts(text):
    assert counts(text) == plain_counts(text)


def test_base_counts_of_edge_cases():
    for text in (None, "", " \n", "a a a a", "x " * 40000, "a\n\na\n a\n", " a"):
        assert counts(text) == plain_counts(text)


def test_repeat_words_beyond_the_key_bits(monkeypatch):
    monkeypatch.setattr(rules, "_SHIFT", 2)
    for seed in range(20):
        rnd = random.Random(seed)
        text = " ".join(str(rnd.randrange(12)) for _ in range(80))
        assert counts(text) == plain_counts(text)


def corpus(n=260, seed=4):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeiourst") for _ in range(rnd.randint(2, 9))) for _ in range(600)]
    rows, labels = [], []
    for i in range(n):
        w = [rnd.choice(vocabulary) for _ in range(rnd.randint(60, 200))]
        good, toxic = rnd.random() < .6, rnd.random() < .4
        if not good:
            w = [x + rnd.choice([" |", "%%%", "###"]) for x in w]
        if toxic:
            for _ in range(3):
                w[rnd.randrange(len(w))] = rnd.choice(["zyxxgrunk", "qwordfool", "Zyxxgrunks"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(good), int(toxic)))
    extra = [(9001, None), (9002, ""), (9003, " \n\t"), (None, "no id at all"), (9004, "word " * 30000),
             rows[0], (9005, "퟿\U0001F600 x")]
    return rows + extra, labels + [labels[0], (7, 0, 1)] + [(50000, 1, 0)]


def test_quality_fit_leaves_the_sample_to_a_task(docs_of, labels_of, monkeypatch):
    """What is collected is the model: no bag of words reaches the driver, and rows may come in any order."""
    rows = [(i // 2, ("good plain words " if i // 2 % 2 else "zz## qq$$ xx%% ") * 20 + f"w{i}") for i in range(80)]
    docs, labels = docs_of(rows, extra=False), labels_of([(i, i % 2, None) for i in range(40)])
    monkeypatch.setattr(type(docs), "toArrow", None)
    one = rules.fit(docs.coalesce(1), labels)
    many = rules.fit(docs.coalesce(1), labels)
    assert len(one) == 5 and all(np.array_equal(a, b) for a, b in zip(one, many))
    assert one[0].dtype == one[1].dtype == np.float32 and len(one[0]) == len(one[1]) == rules.MASK + 1
    assert rules.fit(docs, labels_of([])) is None and rules.fit(docs, labels_of([(1, 1, None)])) is None


def test_quality_rules_learn(docs_of, labels_of):
    rows, labels = corpus()
    docs = docs_of(rows).repartition(3)
    got = quality_rules(docs, labels_of(labels + [(8, None, None)])).collect()
    assert len(got) == len(rows)
    good = dict((d, q) for d, q, _ in labels)
    judged = [(r.kept, good[r.doc_id]) for r in got if r.doc_id in good and r.doc_id != 7]
    assert sum(k == bool(q) for k, q in judged) / len(judged) > 0.97
    texts = {}
    for d, t in rows:
        texts.setdefault(d, t)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert 0 <= r.score <= 1 and not (r.kept and r.base_failed)
    kept = kept_documents(docs, labels_of(labels))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


def test_without_labels(docs_of, labels_of):
    rows, _ = corpus(20)
    got = quality_rules(docs_of(rows), labels_of([])).collect()
    assert all(r.score is None and r.kept == (not r.base_failed) for r in got)
    assert {r.score for r in toxicity(docs_of(rows), labels_of([])).collect()} == {0.5}
    assert {r.score for r in quality_scores(docs_of(rows), labels_of([])).collect()} == {0.5}
    one = toxicity(docs_of(rows), labels_of([(0, 1, 0), (1, 1, 0)])).collect()
    assert all(r.predicted == 0 for r in one)


def test_empty_tables(docs_of, labels_of):
    labels = labels_of([(1, 1, 0)])
    for fn in (quality_rules, quality_scores, toxicity, kept_documents):
        assert fn(docs_of([]), labels).count() == 0


@pytest.mark.parametrize("fn, label", [(toxicity, 2), (quality_scores, 1)])
def test_held_out_accuracy(docs_of, labels_of, fn, label):
    rows, labels = corpus()
    got = fn(docs_of(rows), labels_of(labels), keep=id_remainder(4) != 2).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    truth = {row[0]: row[label] for row in labels if row[0] != 7}
    out = [(r.predicted, truth[r.doc_id]) for r in got
           if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(out) > 30 and sum(a == b for a, b in out) / len(out) > 0.95


def test_rare_toxic_ngrams_count():
    """With both classes at their bound, a fifth of a percent of the toxic rows is enough."""
    pos, neg = np.array([8, 12, 40, 2, 100, 0]), np.array([0, 0, 0, 0, 100, 8])
    ratios = log_count_ratios(pos, neg, 4000, 4000)
    assert set(ratios) == {0, 1, 2, 5} and ratios[1] > ratios[0] > 0 > ratios[5]


def test_held_out_labels_are_not_learned(docs_of, labels_of):
    """Turning held-out labels round changes no score."""
    rows, labels = corpus(120)
    held = lambda d: zlib.crc32(str(d).encode()) % 4 == 2
    turned = [(d, 1 - q, 1 - t) if held(d) else (d, q, t) for d, q, t in labels]
    for fn in (toxicity, quality_scores):
        a, b = ({r.doc_id: r.score for r in fn(docs_of(rows), labels_of(x), keep=id_remainder(4) != 2).collect()}
                for x in (labels, turned))
        assert a == b


def test_remainder_is_crc32_of_the_id_text(spark):
    got = spark.range(50).select("id", id_remainder(5, "id").alias("m")).collect()
    assert all(r.m == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_flat_forest_walks_like_single_rows():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    forest = trees.grow(x, y, np.ones(400))
    z = forest.raw(x)
    assert ((z > 0) == (y == 1)).mean() > 0.97

    def walk(row):
        total = forest.base
        for node in forest.roots:
            while forest.feature[node] >= 0:
                node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
            total += forest.value[node]
        return total
    assert np.allclose([walk(r) for r in x[:50]], z[:50])


def test_statistics_shape():
    for text in (None, "", " \n", "one", "a b\nc d\na b", "É" * 1000):
        assert len(trees.statistics(text)) == len(trees.STATISTICS) and np.isfinite(trees.statistics(text)).all()
    assert not trees.statistics(" \n").any()


def test_documents_are_scored_in_slices_and_the_words_dropped(monkeypatch):
    import types

    import pyarrow as pa
    sizes, dropped = [], []

    def score(texts):
        sizes.append(len(texts))
        return {"kept": [t.endswith("1") for t in texts]}

    monkeypatch.setattr(rules, "id_and_text", lambda docs: docs)
    monkeypatch.setattr(rules, "_scorer", lambda *_: (score, lambda: dropped.append(1)))
    run = rules.kept_documents(types.SimpleNamespace(schema=None, mapInArrow=lambda fn, _: fn), None)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(5000)), "text": [f"t{i}" for i in range(5000)]})
    kept = [i for b in run(iter([batch])) for i in b.column("doc_id").to_pylist()]
    assert kept == list(range(1, 5000, 10)) and sizes == [2048, 2048, 904] and dropped == [1]
