"""Token ids, packing and token files against the library's own encoding of whole texts."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm import idcoder, token_files
from blotter.llm.packing import assign, pack, rooms
from blotter.llm.token_files import read_ids, write_ids
from blotter.llm.tokens import Encoder, public_path

TEXTS = ["I'll don't  it's over.", "ça é  x y", "a\u0085b ΑΣ İ 'S 's", "<|endoftext|> a<|startoftext|>b", "", None, " \n",
         "x 're y'll 123 ½²", "a ́b", "x0 0y ٠ ０ x.. y.). é. z.", "same words same words", "same words same words",
         "long " * 5000 + "end", "x" * 3000, "\U0001F602 a\U0001F602b 0"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_path())


def plain(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def test_words_encode_like_whole_texts(library):
    got = Encoder(public_path()).encode(TEXTS)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [plain(library, t) for t in TEXTS]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text_encodes_like_the_library(text):
    enc = Encoder.__dict__.get("_shared") or Encoder(public_path())
    Encoder._shared = enc
    want = enc.tokenizer.encode(text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids
    assert np.frombuffer(enc.encode([text.encode("utf-8", "replace").decode()], None)[0], "<u4").tolist() == want


def test_cache_bound_does_not_change_ids(library, monkeypatch):
    import blotter.llm.tokens as tokens
    monkeypatch.setattr(tokens, "CACHED_WORDS", 12)
    got = Encoder(public_path()).encode(TEXTS)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [plain(library, t) for t in TEXTS]


def test_signs_after_a_plain_word_make_no_new_word(library):
    enc = Encoder(public_path())
    text = "plain plain$$$ Plain&&& plain,;: \u00e9t\u00e9*** stra\u00dfe!?"
    assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == plain(library, text)
    assert set(enc.cache) - {b""} == {"plain".encode(), "\u00e9t\u00e9".encode(), "stra\u00dfe".encode()}
    odd = ["x'$ don't$ 's$ it'll, a'", "e\u0301$$ \ufb00$$ \u00c9,, \u00bax$ \u00f1\u0303! \u00d7\u00f7$ a\u0301", "0$ a0$ $$$ $a$ a$a$ <| a<| a$<|endoftext|> |>,",
           "a\u00a0b$ a\u2003,", "a\x1fb$ \x00$ a\x7f$ _ a_$", " \t", "\u00df\u00ff\u00f6\u00f8\u00e0~~"]
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(odd)] == [plain(library, t) for t in odd]


def test_other_rules_take_the_whole_tokenizer(library, tmp_path):
    import json
    rules = json.loads(library.to_str())
    rules["normalizer"] = {"type": "NFC"}
    path = str(tmp_path / "other.json")
    (tmp_path / "other.json").write_text(json.dumps(rules))
    enc = Encoder(path)
    want = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in ("plain$$ words,", "\u00e9t\u00e9 0")]
    assert enc.plain is None
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(["plain$$ words,", "\u00e9t\u00e9 0"], None)] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=40))
def test_assignment_fills_every_sequence(lengths):
    pieces, cost = assign(lengths)
    size = rooms(sum(lengths), 2048)
    assert sorted(size.tolist()) == sorted(s for s in size.tolist() if s <= 2048)
    assert all(s == 2048 or s & (s - 1) == 0 for s in size.tolist())
    used = {}
    for doc, start, n, s, offset in pieces:
        assert n > 0
        used.setdefault(s, []).append((offset, n))
    for s, parts in used.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == size[s]
    for doc, n in enumerate(lengths):
        mine = sorted((start, k) for d, start, k, _, _ in pieces if d == doc)
        assert sum(k for _, k in mine) == n and all(a + k == b for (a, k), (b, _) in zip(mine, mine[1:]))


def test_costs_are_balanced():
    rnd = random.Random(1)
    _, cost = assign([rnd.randint(1, 1500) for _ in range(600)])
    full = cost[cost > 2048]
    assert full.max() / full.min() < 1.35


def test_pack_covers_all_ids(docs_of, library):
    texts = [*TEXTS, "again " * 900] * 3
    docs = docs_of([(None if i == 4 else i // 2, t) for i, t in enumerate(texts)]).repartition(3)
    rows = pack(docs, group_tokens=3000).collect()
    want = sorted((len(plain(library, t)), zlib.crc32(np.array(plain(library, t), "<u4").tobytes())) for t in texts)
    assert sum(len(r.ids) // 4 for r in rows) == sum(n for n, _ in want)
    by_seq = {}
    for r in rows:
        assert r.length * 4 == len(r.ids) and r.start + r.length <= r.doc_tokens
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_tokens))
    for parts in by_seq.values():
        at = 0
        for offset, n, total in sorted(parts):
            assert offset == at
            at += n
        assert at == total <= 2048


def test_pack_empty(docs_of):
    assert pack(docs_of([])).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 70000), max_size=300), st.integers(1, 64))
def test_coder_round_trip(ids, block):
    ids = np.array(ids, np.int64)
    assert (idcoder.decode(idcoder.encode(ids, block)) == ids).all()


def test_coder_compresses_and_detects_damage():
    rng = np.random.default_rng(5)
    ids = np.tile(rng.integers(0, 49408, 300), 60)
    frame = idcoder.encode(ids)
    assert len(frame) < len(ids)  # under one byte an id for repeated text
    assert (idcoder.decode(frame) == ids).all()
    broken = bytearray(frame)
    broken[len(broken) // 2] ^= 255
    with pytest.raises((ValueError, IndexError)):
        idcoder.decode(bytes(broken))
    with pytest.raises(ValueError):
        idcoder.encode(np.array([1 << 24]))


def test_blocks_are_independent():
    ids = np.arange(5000) % 97
    one = idcoder.encode(ids[:4096])
    both = idcoder.encode(ids)
    assert one[9 + 12:] in both


def mixed_ids(n, top=49408):
    """Ids of a fixed formula: some seldom, some often, many after the same others."""
    i = np.arange(n, dtype=np.int64)
    return np.where(i * 2654435761 % 97 < 40, i * i % top, i * i % 23)


#: number of ids, block, ids below, CRC-32 of the frame
FRAMES = [(0, 4, 9, 2215959877), (1, 4, 9, 1131074525), (5000, 64, 49408, 2515693669), (9000, 4096, 16777216, 871264836), (3000, 3000, 70000, 4025471130)]


def test_frames_keep_their_bytes():
    """Files written earlier are still read: frames are what the first version of the coder wrote."""
    for n, block, top, crc in FRAMES:
        frame = idcoder.encode(mixed_ids(n, top), block)
        assert zlib.crc32(frame) == crc and (idcoder.decode(frame) == mixed_ids(n, top)).all()


def test_a_lane_is_small():
    """A lane's ids and confidences are one number a cell, its nibbles' bounds 16 bits each."""
    held = [v for v in vars(idcoder._Model(64)).values() for v in (v if isinstance(v, list) else [v])]
    assert sum(v.nbytes for v in held) < 64 * 45_000


def test_any_damage_is_a_value_error():
    frame = idcoder.encode(mixed_ids(3000), 500)
    for at in range(9 + 12 * 6, len(frame), 97):
        broken = bytearray(frame)
        broken[at] ^= 1 << at % 8
        with pytest.raises(ValueError):
            idcoder.decode(bytes(broken))


def test_files_round_trip(spark, docs_of, library, tmp_path):
    rows = [(i * 7 % 31, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (2, "same id"), (2, "same id")]
    path = str(tmp_path / "ids")
    write_ids(docs_of(rows).repartition(4), path, frame_ids=1000)
    got = read_ids(spark, path).collect()
    want = sorted(((-1 if d is None else d), t or "") for d, t in rows)
    seen = sorted(((-1 if r.doc_id is None else r.doc_id), r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got)
    at = 0
    assert [d for d, _, _ in seen] == [d for d, _ in want]
    by_id = {}
    for d, t in want:
        by_id.setdefault(d, []).append(plain(library, t))
    for d, start, ids in sorted(seen, key=lambda x: x[1]):
        assert start == at and ids in by_id[d]
        by_id[d].remove(ids)
        at += len(ids)
    write_ids(docs_of([]), str(tmp_path / "none"))
    assert read_ids(spark, str(tmp_path / "none")).count() == 0


def test_ranges_are_cut_without_whole_texts(spark, docs_of):
    """The sample for the cuts goes to the driver, so it holds the first signs of texts alone."""
    rnd = random.Random(4)
    texts = ["same first signs of " + "all texts " * 30 + str(i) for i in range(40)] + ["", None, "\u00e9" * 20, "\U0001F602" * 17, "z", "same"]
    rows = [(rnd.choice([None, 1, 1, 1, 2, 3, -4]), t) for t in texts * 3]
    got = token_files.in_order(docs_of(rows).repartition(5))
    assert "text ASC" not in got._jdf.queryExecution().executedPlan().toString().split("rangepartitioning(")[1].split("\n")[0]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())
    assert [tuple(r) for r in got.collect()] == sorted(rows, key=key)


def test_a_task_takes_few_rows_and_leaves_nothing(spark, monkeypatch):
    """A worker outlives its task: no words are kept, and what is free is given back."""
    import types

    import pyarrow as pa
    import pyspark

    from blotter.llm import common, packing, tokens
    given, sizes = [], []
    monkeypatch.setattr(common, "give_back_memory", lambda: given.append(1))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(5000)), "text": [f"word{i} again" for i in range(5000)]})
    for some in common.slices(iter([batch, batch.slice(0, 3)])):
        sizes.append(some.num_rows)
    assert sizes == [2048, 2048, 904, 3] and len(given) == 2

    monkeypatch.setattr(packing, "id_and_text", lambda docs: docs)
    monkeypatch.setattr(pyspark.TaskContext, "get", lambda: types.SimpleNamespace(partitionId=lambda: 0))
    docs = types.SimpleNamespace(sparkSession=spark, mapInArrow=lambda run, schema: run)
    rows = sum(b.num_rows for b in packing.pack(docs)(iter([batch])))
    known = tokens.encoder(tokens.public_path())
    assert rows >= 5000 and not (known.cache or known.older or known.signs)
