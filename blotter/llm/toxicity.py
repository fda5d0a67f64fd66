"""Toxicity: a character n-gram linear classifier with naive Bayes scaled features.

A document's feature for an n-gram is the number of its distinct words that hold it, times the
n-gram's log-count ratio r = log(p / q) between toxic and other documents (Wang and Manning,
2012).  A ratio counts only if it lies ``Z`` standard errors from zero; all others are zero, so
a long clean text gathers no noise.  A logistic regression on these features gives the score.
n-grams stay inside words (with marks at the ends), are lower-cased and hashed; whole texts are
scored in Arrow batches.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import id_and_text, id_remainder, map_batches, table
from blotter.llm.linear import Rows, WordTable, batches_of, fit_logistic, grams_of, labelled_sample, sigmoid

ROWS_PER_CLASS = 4000   # bound of the training sample
MASK = (1 << 20) - 1
SIZES = (2, 3, 4, 5, 6)
Z = 2.0                 # an n-gram of no other document counts from 8 toxic ones on, 4000 a class
SMOOTHING = 1.0
PENALTY = 1e-4
THRESHOLD = 0.3


def words_of(text: str | None) -> set[bytes]:
    return set((text or "").lower().encode("utf-8", "surrogatepass").split())


def log_count_ratios(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> dict[int, float]:
    """Significant log-count ratios, from the number of documents of each class with an n-gram."""
    a, b = pos + SMOOTHING, neg + SMOOTHING
    r = np.log(a / (n_pos + 2 * SMOOTHING)) - np.log(b / (n_neg + 2 * SMOOTHING))
    some = np.flatnonzero(np.abs(r) >= Z * np.sqrt(1 / a + 1 / b))
    return dict(zip(some.tolist(), r[some].tolist()))


def _once(owner: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen columns (not negative) of each word, each once."""
    chosen = column >= 0
    key = np.unique(owner[chosen].astype(np.int64) << 32 | column[chosen])
    return key >> 32, key & 0xFFFFFFFF


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, keep=None):
    """(n-gram weights on counts, intercept); no weights and the base rate if a class is missing,
    None without labelled rows."""

    def bag(cols):
        return {"doc_id": cols["doc_id"], "y": cols["y"], "weight": cols["weight"],
                "words": [sorted(words_of(t)) for t in cols["text"]]}

    sample = labelled_sample(docs, labels, "toxic", rows_per_class, keep)
    rows = map_batches(sample, bag, "doc_id long, y int, weight double, words array<binary>").toArrow()
    rows = rows.take(np.argsort(rows["doc_id"].to_numpy(), kind="stable"))
    y, weight = rows["y"].to_numpy().astype(float), rows["weight"].to_numpy()
    if not len(y):
        return None
    if len(set(y)) < 2:
        return {}, 4.0 if y[0] else -4.0
    pos, neg = np.zeros(MASK + 1, np.int32), np.zeros(MASK + 1, np.int32)
    for words, label in zip(rows["words"], y):
        (pos if label else neg)[np.unique(grams_of(words.as_py(), SIZES, MASK)[1])] += 1
    ratios = log_count_ratios(pos, neg, int(y.sum()), int(len(y) - y.sum()))
    del pos, neg
    column = np.full(MASK + 1, -1, np.int32)
    column[list(ratios)] = np.arange(len(ratios))
    scale = np.array(list(ratios.values()))
    index, lengths = [], []
    for words in rows["words"]:
        owner, gram = grams_of(words.as_py(), SIZES, MASK)
        index.append(_once(owner, column[gram])[1])
        lengths.append(len(index[-1]))
    index = np.concatenate(index)
    x = Rows(lengths, index, scale[index], len(ratios))
    w, b = fit_logistic(x.times, x.transposed_times, len(ratios), y, weight, PENALTY)
    return dict(zip(ratios, (w * scale).tolist())), float(b)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
             rows_per_class: int = ROWS_PER_CLASS, keep=None) -> DataFrame:
    """``doc_id, score, predicted`` of every row; ``keep`` restricts the labelled ids to learn from.

    A null or blank text has no features and gets the score of the intercept.  Without labelled
    rows the score is 0.5 throughout.  Repeated rows and null ids are scored like any other; texts of
    any length are read whole; a score at the threshold is predicted 1; an empty table gives an empty result; only ``doc_id`` and ``text`` (``doc_id, toxic`` of
    ``labels``) are read.
    """
    source = id_and_text(docs)
    model = fit(source, labels, rows_per_class, keep)
    shared = source.sparkSession.sparkContext.broadcast(model)  # some thousand n-grams at most
    state: dict = {}

    def score(cols):
        if shared.value is None:
            p = [0.5] * len(cols["doc_id"])
        else:
            weights, b = shared.value
            if "words" not in state:
                place = np.full(MASK + 1, -1, np.int32)
                place[list(weights)] = np.arange(len(weights))
                value = np.array([*weights.values(), 0.0])

                def values(words):
                    owner, gram = grams_of(words, SIZES, MASK)
                    owner, column = _once(owner, place[gram])
                    return np.bincount(owner, value[column], len(words))[:, None]

                state["words"] = WordTable(values, 1)
            known = state["words"]
            z = []
            for some in batches_of(cols["text"]):
                split = [words_of(t) for t in some]
                known.learn(split)
                z += [known.rows[known.numbers(words), 0].sum(dtype=np.float64) for words in split]
            p = sigmoid(np.array(z) + b).tolist()
        return {"doc_id": cols["doc_id"], "score": p, "predicted": [int(x >= threshold) for x in p]}

    return map_batches(source, score, "doc_id long, score double, predicted int")


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Learned on the labels whose id's remainder modulo 4 is not 2."""
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                      keep=id_remainder(4) != 2)
    return scored.select("doc_id", F.coalesce(id_remainder(4) == 2, F.lit(False)).alias("held_out"),
                         "score", "predicted")
