"""Quality rules: base counts of a text and a hashed n-gram logistic regression.

The model sees each word's hashed identity, its inner character n-grams and pairs of
neighbouring words, each averaged over the text, case kept.  It is fitted on a bounded sample
of the labelled quality rows, and calibrated by Platt's method on a fifth of that sample kept
out of the fit.  Texts are counted and scored whole, in Arrow batches.  A document is kept if
it passes the base rules and its calibrated probability of being good reaches ``THRESHOLD``.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import arrow_schema, encoded, give_back_memory, id_and_text, map_batches, slices, table
from blotter.llm.linear import (Rows, WordTable, batches_of, fit_logistic, fit_platt, grams_of,
                                labelled_sample, sigmoid)

ROWS_PER_CLASS = 2000   # bound of the training sample
MASK = (1 << 17) - 1    # feature space of words with their n-grams, and of word pairs
SIZES = (1, 2, 3, 4)
WORD_BLOCK = 16_384     # words whose features make one block of the fit
THRESHOLD = 0.5
MIN_WORDS = 50
REPEAT_PERCENT = 50
PENALTY = 1e-6
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\f\r"
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")
MODEL = "words binary, pairs binary, intercept double, slope double, shift double"
_SHIFT = 21             # bits of a word's number in a window key


def own_feature(words: list[bytes]) -> np.ndarray:
    """The feature of each word's identity."""
    return np.array([zlib.crc32(b"\x01" + w) & MASK for w in words], np.int32)


def word_features(words: list[bytes]):
    """Per feature of the words: the word's number, the feature and its value.  A word's identity
    and its n-grams together have half the weight each."""
    owner, gram = grams_of(words, SIZES, MASK)
    share = 0.5 / np.bincount(owner, minlength=len(words))[owner]
    every = np.arange(len(words), dtype=np.int32)
    owner, index = np.concatenate([owner, every]), np.concatenate([gram, own_feature(words)])
    return owner, index, np.concatenate([share, np.full(len(words), 0.5)]).astype(np.float32)


def word_table(weights: np.ndarray | None) -> WordTable:
    """A hash and a score for each word."""
    def values(words):
        out = np.zeros((len(words), 2), np.float32)
        out[:, 0] = [zlib.crc32(w) & 0xFFFFFF for w in words]  # exact as a float
        if weights is not None:
            owner, index, value = word_features(words)
            out[:, 1] = np.bincount(owner, weights[index] * value, len(words))
        return out

    return WordTable(values, 2)


def pair_features(hashes: np.ndarray) -> np.ndarray:
    """Hashed features of the pairs of neighbouring words."""
    h = hashes.astype(np.uint32)
    mixed = (h[:-1] * np.uint32(0x9E3779B1)) ^ (h[1:] * np.uint32(0x85EBCA77))
    return ((mixed ^ (mixed >> np.uint32(15))) & np.uint32(MASK)).astype(np.int32)


def repeat_words(numbers: np.ndarray) -> int:
    """Words covered by a three-word window that occurs at least twice."""
    if len(numbers) < 4:
        return 0
    if numbers.max() >> _SHIFT:
        numbers = np.unique(numbers, return_inverse=True)[1]
    if numbers.max() >> _SHIFT:  # over two million different words in one text
        key = np.unique(np.stack([numbers[:-2], numbers[1:-1], numbers[2:]], 1), axis=0, return_inverse=True)[1].ravel()
    else:
        key = numbers[:-2] << 2 * _SHIFT | numbers[1:-1] << _SHIFT | numbers[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(len(numbers), bool)
    for shift in range(3):
        covered[shift:len(key) + shift] |= twice
    return int(covered.sum())


def dup_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in raw:
        return 0
    lines = [line for line in raw.split(b"\n") if line.strip(SPACE)]
    return len(lines) - len(set(lines))


def base_counts(raw: bytes, text: str | None, words: list[bytes], numbers: np.ndarray) -> tuple[int, ...]:
    chars = len(text or "") - (len(raw) - len(raw.translate(None, SPACE)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return len(words), chars, symbols, dup_lines(raw), repeat_words(numbers)


def failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > REPEAT_PERCENT * n_words


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, keep=None):
    """(word weights, pair weights, intercept, slope, shift) or None if a class has no row.

    The bags of the bounded sample meet in one task, so the driver holds the model alone.
    """

    def bag(cols):
        out = {"doc_id": cols["doc_id"], "at": cols["at"], "y": cols["y"], "weight": cols["weight"], "n": [],
               "words": [], "counts": [], "pairs": [], "pair_counts": []}
        seen = word_table(None)
        for text in cols["text"]:
            words = encoded(text).split()
            counts = Counter(words)
            seen.learn([counts])
            pair, pair_counts = np.unique(pair_features(seen.rows[seen.numbers(words), 0]), return_counts=True)
            out["n"].append(len(words))
            out["words"].append(list(counts))
            out["counts"].append(list(counts.values()))
            out["pairs"].append(pair)
            out["pair_counts"].append(pair_counts.astype(np.int32))
        return out

    def learn(batches):
        rows = list(batches)
        model = fit_bags(rows) if rows else None
        give_back_memory()  # the worker lives on; it keeps nothing of the sample
        if model:
            row = (model[0].tobytes(), model[1].tobytes(), *map(float, model[2:]))
            yield pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, schema)], schema=schema)

    schema = arrow_schema(docs.sparkSession, MODEL)
    # "at" holds the order of the table, for rows of one id
    sample = labelled_sample(docs, labels, "quality", rows_per_class, keep).withColumn(
        "at", F.monotonically_increasing_id())
    bags = map_batches(sample, bag, "doc_id long, at long, y int, weight double, n int, words array<binary>, "
                                    "counts array<int>, pairs array<int>, pair_counts array<int>")
    found = bags.repartition(1).mapInArrow(learn, MODEL).collect()
    if not found:
        return None
    words, pairs, *rest = found[0]
    return np.frombuffer(words, np.float32), np.frombuffer(pairs, np.float32), *rest


def fit_bags(batches: list[pa.RecordBatch]):
    """The model of ``fit`` from the sample's bags, in whatever order they come; empties the list."""
    rows = pa.Table.from_batches(batches)
    batches.clear()
    order = np.lexsort((rows["at"].to_numpy(), rows["doc_id"].to_numpy()))

    def column(name):  # one column at a time leaves the table, so that none but it is held twice
        nonlocal rows
        found, rows = rows[name], rows.drop_columns(name)
        return found.combine_chunks().take(pa.array(order))

    y, weight, n = (column(c).to_numpy().astype(float) for c in ("y", "weight", "n"))
    if len(set(y)) < 2:
        return None

    def shares(counts, per_row, lengths):
        return (column(counts).flatten().to_numpy() / np.repeat(np.maximum(per_row, 1), lengths)).astype(np.float32)

    words = column("words")
    lengths, coded = words.value_lengths().to_numpy(), words.flatten().dictionary_encode()
    del words
    outer = Rows(lengths, coded.indices.to_numpy(), shares("counts", n, lengths), len(coded.dictionary))
    words, blocks = [], []  # of few words each, so that no array is long and none is held twice
    for at in range(0, len(coded.dictionary), WORD_BLOCK):
        words = coded.dictionary[at:at + WORD_BLOCK].to_pylist()
        blocks.append(Rows.of_owners(*word_features(words), len(words), MASK + 1))
    del words, coded
    give_back_memory()
    index = column("pairs")
    lengths = index.value_lengths().to_numpy()
    pairs = Rows(lengths, index.flatten().to_numpy(), shares("pair_counts", n - 1, lengths), MASK + 1)
    del rows, index
    give_back_memory()

    def times(w):
        inner = [block.times(w[:MASK + 1]) for block in blocks] or [np.empty(0)]
        return outer.times(np.concatenate(inner)) + pairs.times(w[MASK + 1:])

    def transposed_times(r):
        words, inner, at = outer.transposed_times(r), np.zeros(MASK + 1), 0
        for block in blocks:
            inner += block.transposed_times(words[at:at + block.shape[0]])
            at += block.shape[0]
        return np.concatenate([inner, pairs.transposed_times(r)])

    aside = np.arange(len(y)) % 5 == 4 if len(y) >= 50 else np.zeros(len(y), bool)
    w, b = fit_logistic(times, transposed_times, 2 * (MASK + 1), y, np.where(aside, 0, weight), PENALTY, steps=60)
    z = times(w) + b
    tune = aside if aside.any() and len(set(y[aside])) == 2 else ~aside
    slope, shift = fit_platt(z[tune], y[tune], weight[tune])
    return w[:MASK + 1].astype(np.float32), w[MASK + 1:].astype(np.float32), b, slope, shift


def _scorer(source: DataFrame, labels: DataFrame, threshold: float, rows_per_class: int, keep):
    """A function from texts to columns ``NAMES``, fitted and ready to be sent to tasks, and one that
    drops the words it has met."""
    # two weight vectors of fixed size
    shared = source.sparkSession.sparkContext.broadcast(fit(source, labels, rows_per_class, keep))
    state: dict = {}

    def score(texts):
        if "words" not in state:
            state["words"] = word_table(shared.value[0] if shared.value else None)
        known = state["words"]
        out = {n: [] for n in NAMES}
        for some in batches_of(texts):
            split = [encoded(t).split() for t in some]
            known.learn(split)
            for text, words in zip(some, split):
                numbers = known.numbers(words)
                counts = base_counts(encoded(text), text, words, numbers)
                bad = failed(counts[0], counts[4])
                p = None
                if shared.value:
                    _, pair_weights, b, slope, shift = shared.value
                    values = known.rows[numbers]
                    z = b + (float(values[:, 1].mean(dtype=np.float64)) if words else 0.0)
                    z += pair_weights[pair_features(values[:, 0])].mean(dtype=np.float64) if len(words) > 1 else 0.0
                    p = float(sigmoid(slope * z + shift))
                for name, value in zip(NAMES, (*counts, bad, p, not bad and (p is None or p >= threshold))):
                    out[name].append(value)
        return out

    return score, state.clear


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                  rows_per_class: int = ROWS_PER_CLASS, keep=None) -> DataFrame:
    """Base counts, their verdict, the calibrated score and the final verdict of every row.

    A null or blank text has zero counts and fails.  Without labelled rows of both classes there
    is no model: the score is null and the base rules decide alone.  Repeated rows and null ids
    are scored like any other; texts of any length are read whole; a score at the threshold is kept;
    an empty table gives an empty result; only ``doc_id`` and ``text`` (and ``doc_id, quality`` of
    ``labels``) are read.
    """
    source = id_and_text(docs)
    score, _ = _scorer(source, labels, threshold, rows_per_class, keep)
    return map_batches(source, lambda cols: {"doc_id": cols["doc_id"], **score(cols["text"])},
                       "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                       "n_repeat_words long, base_failed boolean, score double, kept boolean")


def kept_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                   rows_per_class: int = ROWS_PER_CLASS, keep=None) -> DataFrame:
    """The rows of ``docs``, all columns, that ``quality_rules`` keeps; nothing is joined."""
    score, forget = _scorer(id_and_text(docs), labels, threshold, rows_per_class, keep)

    def run(batches):
        for some in slices(batches):
            yield some.filter(pa.array(score(some.column("text").to_pylist())["kept"], pa.bool_()))
            del some
        forget()
        give_back_memory()

    return docs.mapInArrow(run, docs.schema)


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All documents, with the model learned from the quality labels."""
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
