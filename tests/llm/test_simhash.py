"""SimHash fingerprints and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

import blotter.llm.simhash as simhash
from blotter.llm.simhash import _joined, fingerprint, simhash_duplicates


def plain_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def classes(rows, distance=4):
    """Smallest id reachable, by all pairs."""
    known = [(d, plain_fingerprint(t)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in known}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d
    for i, (a, x) in enumerate(known):
        for b, y in known[:i]:
            if (x ^ y).bit_count() <= distance:
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {d: root(d) for d in parent}


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(14):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 40, 300, 900]))]
        for _ in range(rnd.randint(1, 9)):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 5])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append(" ".join(copy).upper() if rnd.random() < .2 else " \t".join(copy))
    rnd.shuffle(rows)
    return [(i * 3 + 2, t) for i, t in enumerate(rows)]


ODD = [(1, None), (4, ""), (7, " \n\t"), (None, "w1 w2 w3 w4"), (10, "same text"), (13, "same text"),
       (16, "Same  TEXT"), (16, "Same  TEXT"), (19, "É a b c"), (22, "é a b c"), (-5, "same text")]


def check(docs_of, rows):
    got = simhash_duplicates(docs_of(rows)).collect()
    want = classes(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint) for r in got) == sorted(
        (d is None, d or 0, f"{plain_fingerprint(t):016x}") for d, t in rows)
    assert all(r.component_id == want.get(r.doc_id) for r in got)
    return want


@pytest.mark.parametrize("block", [2, 1024])
def test_classes_equal_brute_force(docs_of, monkeypatch, block):
    """With blocks of two, every variant that anything shares takes the way of the large ones."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rows = corpus(block) + ODD
    want = check(docs_of, rows)
    assert 20 < sum(d != c for d, c in want.items()) < len(want) - 10
    assert want[1] == want[4] == want[7] == 1 and want[10] == want[16] == -5


def test_repeated_id_has_the_links_of_all_its_texts(docs_of):
    rows = [(5, "one two three four five"), (3, "one two three four five"), (5, "six seven eight nine"),
            (2, "six seven eight nine"), (9, "ten eleven twelve")]
    assert check(docs_of, rows) == {5: 2, 3: 2, 2: 2, 9: 9}


def test_every_distance_up_to_the_bound_is_found(spark, monkeypatch):
    """Planted fingerprints at each distance, against all pairs."""
    rnd = np.random.default_rng(3)
    base = [int(x) for x in rnd.integers(0, 1 << 63, 60)]
    fps = list(base)
    for x in base:
        for bits in (1, 3, 4, 5):
            flips = rnd.choice(64, bits, replace=False)
            fps.append(x ^ sum(1 << int(b) for b in flips))
    rows = [(i, int(np.uint64(x).astype(np.int64))) for i, x in enumerate(fps)]
    texts = spark.createDataFrame(rows, "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, words: docs.select("doc_id", "fp"))
    got = {r.doc_id: r.component_id for r in simhash_duplicates(texts).collect()}
    parent = list(range(len(fps)))

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d
    for i, x in enumerate(fps):
        for j in range(i):
            if ((x ^ fps[j]) & (2 ** 64 - 1)).bit_count() <= 4:
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    assert got == {i: root(i) for i in range(len(fps))}


def test_long_text_and_words(docs_of):
    rnd = random.Random(1)
    long = " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(150_000))
    assert fingerprint(long) == plain_fingerprint(long)
    assert fingerprint("\x00 \x1c  \ud800") == plain_fingerprint_bytes("\x00 \x1c  \ud800")


def plain_fingerprint_bytes(text):
    words = text.encode("utf-8", "surrogatepass").split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > 1)


def test_empty_table(docs_of):
    assert simhash_duplicates(docs_of([])).columns == ["doc_id", "fingerprint", "component_id"]
    assert simhash_duplicates(docs_of([])).collect() == []


def test_only_distances_the_segments_can_find(docs_of):
    with pytest.raises(ValueError):
        simhash_duplicates(docs_of([]), distance=6)


def test_joined():
    one, two = np.array([5, 1, 7, 3]), np.array([4, 5, 1, 2])
    u, v = _joined(np.arange(10) * 10, one, two)
    assert sorted(zip(u.tolist(), v.tolist())) == [(30, 20), (40, 10), (50, 10), (70, 10)]
