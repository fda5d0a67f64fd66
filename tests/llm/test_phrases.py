"""Phrase mining against plain counting of every phrase."""

import random
import re
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest

import blotter.llm.phrases as module
from blotter.llm.phrases import OP11_SQL, phrases

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def plain(rows, least, longest, top, inside):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    found = {}
    for (lang, w), a in f.items():
        if len(w) > 1 and a >= least:
            cut = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            found[lang, w] = a, f[lang, w[:cut[1]]], f[lang, w[cut[1]:]], cut[0]
    covered = set()
    for (lang, w), (a, *_) in found.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                sub = w[i:i + size]
                if Fraction(100 * a) >= inside * f[lang, sub]:
                    covered.add((lang, sub))
    out = []
    for name in sorted(total):
        best = sorted(((-score, -a, " ".join(w).encode(), l, r) for (lang, w), (a, l, r, score) in found.items()
                       if lang == name and (lang, w) not in covered))[:top]
        out += [(name, i + 1, p.decode(), -a, l, r, total[name], -score) for i, (score, a, p, l, r) in enumerate(best)]
    return out


def corpus(seed, n=120):
    rnd = random.Random(seed)
    words = ["new", "York", "city", "of", "the", "São", "Paulo", "a", "b", "c'd", "é", "x-y", "“q”", " ", " "]
    rows = []
    for _ in range(n):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r", "\x0b", " \x0c", ";", " "])
                       for _ in range(rnd.randint(0, 60)))
        if rnd.random() < .3:
            text += " the city of New York the city of new york"
        rows.append((text, rnd.choice(["en", "en", "en", "fr", None, ""])))
    return rows


def run(spark, rows, **kw):
    data = [(i, t, lang, 1, 2, 3) for i, (t, lang) in enumerate(rows)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, phrase int, items int, f int")
    out = phrases(df.repartition(3), **kw)
    assert out.columns == COLUMNS
    return sorted((r.lang, *r[1:]) for r in out.collect())


@pytest.mark.parametrize("least, longest, top, inside, block", [
    (2, 4, 2000, 80, 1 << 17), (3, 4, 15, 50, 60), (1, 3, 2000, 100, 1), (8, 2, 5, 80, 300), (4, 5, 2000, 10, 300)])
def test_equals_plain_counting(spark, monkeypatch, least, longest, top, inside, block):
    monkeypatch.setattr(module, "BLOCK_WORDS", block)
    rows = corpus(least) + [(None, "en"), ("", None), (" \t. ,", "fr"), ("one", "de"), ("Rare two", "de"),
                            ("a a a a a a a a", "zz"), ("same same, same same", "und")] * 2
    got = run(spark, rows, least=least, longest=longest, top=top, inside=inside)
    want = plain(rows, least, longest, top, inside)
    assert got == sorted(want) and (least > 4 or len(got) > 10)


def test_saturated_bitmap_only_costs_time(spark, monkeypatch):
    monkeypatch.setattr(module, "MAX_BITS", 6)
    monkeypatch.setattr(module, "MIN_BITS", 6)
    rows = corpus(5)
    assert run(spark, rows, least=3) == sorted(plain(rows, 3, 4, 2000, 80))


def test_one_long_piece(spark):
    rnd = random.Random(2)
    rows = [(" ".join(rnd.choice("abcdefghij") for _ in range(200_000)), "xx"), ("a b c d", "xx")]
    got = run(spark, rows, least=30)
    assert got == sorted(plain(rows, 30, 4, 2000, 80)) and len(got) > 1000


def test_exact_beyond_64_bits(spark):
    """2000000 * a passes 64 bits: the score is exact all the same."""
    a, l, r = 7 * 10 ** 17 + 1, 10 ** 18 + 3, 9 * 10 ** 17 + 7
    score = spark.sql(f"SELECT CAST(2000000 AS DECIMAL(7,0)) * CAST({a}L AS DECIMAL(19,0)) DIV "
                      f"(CAST({l}L AS DECIMAL(19,0)) + CAST({r}L AS DECIMAL(19,0))) AS s").first().s
    assert score == 2000000 * a // (l + r)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, None), ("", "en"), (". , ;", "en")]) == []


def test_sql_agrees():
    rows = corpus(11, 900)
    con = duckdb.connect()
    con.execute('CREATE TABLE documents ("text" VARCHAR, lang VARCHAR)')
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cur = con.execute(OP11_SQL)
    assert [d[0] for d in cur.description] == COLUMNS
    assert sorted(cur.fetchall()) == sorted(plain(rows, 30, 4, 2000, 80))


def test_bitmap_holds_every_frequent_hash(spark):
    words = [f"w{i} é" for i in range(3000)]
    keys = module._hashes("en", words, np.arange(3000).reshape(-1, 1))
    assert len(set(keys.tolist())) == 3000 and keys.min() >= 0
    maybe = module._filter(spark.createDataFrame([(int(k),) for k in keys[:500]], "key long"))
    assert maybe.has(keys[:500]).all() and maybe.has(keys[500:]).mean() < .1
    pairs = np.array([[1, 2], [2, 1], [1, 1]])
    assert len(set(module._hashes("en", words, pairs).tolist())) == 3
    assert module._hashes("fr", words, pairs)[0] != module._hashes("en", words, pairs)[0]


def test_shared_hashes_only_cost_time(spark, monkeypatch):
    monkeypatch.setattr(module, "HASH_BITS", 7)
    rows = corpus(6)
    assert run(spark, rows, least=3) == sorted(plain(rows, 3, 4, 2000, 80))


def test_a_block_is_a_million_words(spark, monkeypatch):
    """Each different word and phrase of a block is handled once, so the blocks of a task are few, and bounded."""
    rows = [("Alpha beta, gamma\x0bdelta " * 10_000, "xx")] * 8 + [(" \n.;", "yy"), (None, "zz")]
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    blocks = module._first(docs).toArrow().to_batches()
    lang, words, slots, items, singles = list(module._unpacked(blocks, 1))[0]
    assert sum(b.num_rows for b in blocks) == 1 and lang == "xx" and len(items) == 320_000
    assert sorted(words) == ["alpha", "beta", "delta", "gamma"] and len(singles) == 4
    assert [words[i] for i in items[:5].tolist()] == ["alpha", "beta", "gamma", "delta", "alpha"]
    assert np.diff(slots[:5]).tolist() == [1, 2, 2, 1]
    monkeypatch.setattr(module, "BLOCK_WORDS", 40_000)
    assert sum(b.num_rows for b in module._first(docs).toArrow().to_batches()) == 8
