"""Source mixing against a plain statement of the rules."""

import hashlib
import random
from fractions import Fraction

import pytest

from blotter.llm import mixing
from blotter.llm.mixing import mixture, placements


def plain_targets(sizes):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + ([None] if None in sizes else [])
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [n for n in names if n not in capped]
        left = total - sum(capped.values())
        share = {n: Fraction(left * weight[n], sum(weight[m] for m in rest)) for n in rest}
        over = [n for n in rest if share[n] > 3 * sizes[n]]
        if not over:
            return capped | share
        capped |= {n: Fraction(3 * sizes[n]) for n in over}


def corpus(seed, n=300):
    rnd = random.Random(seed)
    names = ["src1", "src10", "src2", None, "Ä", "zz", ""]
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 5, 40, 400])), None, rnd.choices(names, [30, 9, 3, 1, 1, 1, 1])[0])
            for i in range(n)]
    return rows + [(n, None, None, "src1"), (None, "a b c", None, "src1"), rows[0], (n + 1, "x " * 50000, None, "zz")]


@pytest.mark.parametrize("seed, bucket", [(1, 4096), (2, 16), (3, 16)])
def test_mixture(docs_of, monkeypatch, seed, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    rows = corpus(seed)
    docs = docs_of(rows)
    got = mixture(docs.repartition(5), carry=("doc_id", "text", "source", "bucket")).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = plain_targets(sizes)
    taken = {}
    for r in got:
        source = r.row.source
        assert r.size == len((r.row.text or "").split()) and r.source_size == sizes[source]
        assert r.target == pytest.approx(float(want[source]))
        assert 0 <= r.taken <= 3 * r.size
        assert (r.positions is None) == (r.taken == 0)
        taken[source] = taken.get(source, 0) + r.taken
    for source, total in taken.items():
        assert abs(total - want[source]) <= 0.5
    again = mixture(docs.repartition(2)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.size, r.taken, r.positions or [])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_positions_follow_the_schedule(docs_of):
    """Passes of a source in hash order start where its demand reaches the words before them."""
    rows = [(i, "w " * (3 + i % 7), None, "abc"[i % 3]) for i in range(240)]
    got = {r.doc_id: r for r in mixture(docs_of(rows)).collect()}
    for s, ramp in zip("abc", (-0.5, 0.0, 0.5)):
        mine = sorted((d for d, _, _, x in rows if x == s), key=lambda d: hashlib.md5(str(d).encode()).hexdigest())
        before, size, target = 0, got[mine[0]].source_size, got[mine[0]].target
        for d in mine:
            for n, t in enumerate(got[d].positions or []):
                assert 0 <= t <= 1
                demand = t + ramp * (t * t - t)
                assert demand * target == pytest.approx(n * size + before, abs=1e-6)
            before += got[d].size
    placed = placements(mixture(docs_of(rows))).collect()
    assert [r.position for r in placed] == sorted(r.position for r in placed)
    total = {}
    for r in placed:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.words
    assert total == {d: r.taken for d, r in got.items() if r.taken}


def test_empty_and_wordless(docs_of):
    assert mixture(docs_of([])).count() == 0
    got = mixture(docs_of([(1, None, None, "a"), (2, " ", None, None)])).collect()
    assert [(r.target, r.taken, r.positions) for r in got] == [(0.0, 0, None)] * 2
