"""Language spans: Viterbi against all paths, held-out accuracy, mixed texts."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm import language
from blotter.llm.language import SCRIPTS, UNKNOWN, _spans, _walk, best_path, best_paths, languages, script_of


def path_score(scores, path, switch):
    return sum(scores[i][k] for i, k in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))



def test_script_of_turns_no_list_into_an_array(monkeypatch):
    """It is asked for every new word; numpy would convert the list of ranges each time."""
    calls = []
    monkeypatch.setattr(language, "np", type("Counted", (), {"__getattr__": lambda _, name: calls.append(name) or getattr(np, name)})())
    for start, _ in SCRIPTS:
        for point in (start - 1, start, start + 1):
            letter = chr(max(point, 0))
            if language._LETTER.search(letter):
                want = [name for first, name in SCRIPTS if first <= ord(letter)][-1]
                assert script_of(f"1_{letter}a") == want
    assert script_of("a") == "latin" and script_of("12") is None and not calls


@pytest.mark.parametrize("seed", range(40))
def test_best_path_is_best(seed):
    rng = np.random.default_rng(seed)
    n, k = rng.integers(1, 9), rng.integers(1, 4)
    scores = -np.abs(rng.normal(size=(n, k)) * 3).astype(np.float32)
    spans = best_path(scores, 2.0)
    path = [lang for a, b, lang in spans for _ in range(a, b)]
    assert len(path) == n and all(x[2] != y[2] for x, y in zip(spans, spans[1:]))
    best = max(path_score(scores, p, 2.0) for p in itertools.product(range(k), repeat=int(n)))
    assert path_score(scores, path, 2.0) == pytest.approx(best, abs=1e-4)


def test_best_path_leaves_the_top_language():
    """Two stretches that each gain less than a penalty, but more together."""
    assert best_path(np.array([[-8, 0, -40], [-8, -40, 0]], np.float32), 12.0) == [(0, 1, 1), (1, 2, 2)]
    for seed in range(300):
        rng = np.random.default_rng(seed)
        scores = np.full((4, 3), -40.0, np.float32)
        scores[:, 0] = -rng.uniform(1, 6, 4)
        scores[:2, 1] = scores[2:, 2] = 0
        path = [lang for a, b, lang in best_path(scores, 12.0) for _ in range(a, b)]
        best = max(path_score(scores, p, 12.0) for p in itertools.product(range(3), repeat=4))
        assert path_score(scores, path, 12.0) == pytest.approx(best, abs=1e-4)


def test_scripts():
    assert [script_of(w) for w in ("abc", "ÉA", "жук", "ελ", "12,", "漢字", "", "1ä")] == [
        "latin", "latin", "cyrillic", "greek", None, "han", None, "latin"]


def text_of(rnd, lang, n):
    syllables = {"aa": "tha er ing ou st".split(), "bb": "oui eau tre que é".split(), "cc": "sch ung ein ü keit".split(),
                 "ru": "про на ко го ста".split()}[lang]
    return " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def test_languages(docs_of):
    rnd = random.Random(6)
    rows = [(i, text_of(rnd, lang, rnd.randint(5, 60)), lang) for i in range(160) for lang in ["aa bb cc ru".split()[i % 4]]]
    odd = [(900, None, "aa"), (901, "", "aa"), (902, "12 -- 3", "bb"), (903, text_of(rnd, "aa", 9), None),
           (None, text_of(rnd, "bb", 20), "bb"), (904, text_of(rnd, "aa", 40) + " " + text_of(rnd, "ru", 30), "aa"),
           (905, text_of(rnd, "cc", 20000), "cc"), (906, "Ελλάδα", None), rows[0]]
    docs = docs_of(rows + odd)
    learn = docs.where("doc_id % 3 != 0 AND doc_id < 800")
    got = languages(docs.repartition(3), learn).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    held = [(by[d].lang_pred, lang) for d, _, lang in rows if d % 3 == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert [by[d].lang_pred for d in (900, 901, 902)] == [UNKNOWN] * 3 and by[900].score == 0
    assert by[None].lang_pred == "bb" and by[905].lang_pred == "cc" and by[903].lang_pred == "aa"
    spans = by[904].spans
    assert [s.lang for s in spans] == ["aa", "ru"] and abs(spans[0].end - 40) <= 1 and spans[1].end == 70
    assert by[906].lang_pred in ("aa", "bb", "cc", "ru")


def test_nothing_to_learn_from(docs_of):
    docs = docs_of([(1, "some text"), (2, None)])
    got = languages(docs, docs).collect()
    assert {(r.lang_pred, r.score) for r in got} == {(UNKNOWN, 0.0)}
    assert languages(docs_of([]), docs.withColumn("lang", F.lit("x"))).count() == 0
    one = languages(docs, docs.withColumn("lang", F.lit("x"))).collect()
    assert {r.doc_id: r.lang_pred for r in one} == {1: "x", 2: UNKNOWN}


@pytest.mark.parametrize("seed", range(6))
def test_texts_walked_together_equal_each_alone(seed):
    """Many lengths, ties (whole numbers) and switches, in any order."""
    rng = np.random.default_rng(seed)
    texts = [(-rng.integers(0, 6, (int(n), 4)) * rng.choice([0.5, 3.0])).astype(np.float32)
             for n in rng.choice([1, 2, 3, 17, 17, 60, 400], 60)]
    for switch in (0.0, 1.0, 7.5):
        got = best_paths(texts, switch)
        for scores, spans in zip(texts, got):
            assert spans == best_path(scores, switch)
            alone = _spans(_walk(scores, switch))
            value = lambda path: sum(float(scores[a:b, k].sum(dtype=np.float64)) for a, b, k in path) - switch * (len(path) - 1)
            assert spans == alone or len(spans) == 1 and abs(value(spans) - value(alone)) < 1e-6
    assert best_paths([], 1.0) == []
