"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text (lengths, shares of character classes, repetition, lines) are cut into
quantile bins; trees grow level by level on gradient histograms with second-order gains.  The
forest is flattened into five arrays, and a batch walks all trees at once, one numpy step a
level.  Trees are grown on the driver, on a bounded sample of labelled rows' statistics (a few
dozen numbers a row); every text is scored whole, in Arrow batches.
"""

from __future__ import annotations

from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import encoded, id_and_text, id_remainder, map_batches, table
from blotter.llm.linear import labelled_sample, sigmoid

ROWS_PER_CLASS = 4000   # bound of the training sample
TREES, DEPTH, BINS = 60, 4, 64
RATE, SHRINK, MIN_HESSIAN = 0.15, 1.0, 2.0
THRESHOLD = 0.3

_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "beyond_ascii": range(128, 256),
    "space": b" \t\x0b\f\r", "line": b"\n", "stop": b".,;:", "shout": b"!?", "bar": b"|", "quote": b"\"'",
    "symbol": b"#*$%&<>=@^~+\\/_", "bracket": b"()[]{}",
}
_CLASS = np.full(256, len(_CLASSES))
for _n, _bytes in enumerate(_CLASSES.values()):
    _CLASS[list(_bytes)] = _n
N_CLASSES = len(_CLASSES) + 1
STATISTICS = [*_CLASSES, "other", "words", "mean_word", "longest_word", "distinct_words", "twins", "richness",
              "lines", "repeated_lines", "words_per_line", "entropy"]


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one whole text; all zero without a word."""
    out = np.zeros(len(STATISTICS))
    raw = encoded(text)
    words = raw.split()
    if not words:
        return out
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = count / len(raw)
    out[:N_CLASSES] = np.bincount(_CLASS, share, N_CLASSES)
    sizes = list(map(len, words))
    distinct = set(words)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    seen = share[share > 0]
    out[N_CLASSES:] = (
        np.log1p(len(words)), sum(sizes) / len(words), np.log1p(max(sizes)), len(distinct) / len(words),
        sum(map(eq, words, words[1:])) / len(words), len(distinct) / (len(words) ** 0.75),
        np.log1p(len(lines)), 1 - len(set(lines)) / len(lines), np.log1p(len(words) / len(lines)),
        -(seen * np.log2(seen)).sum())
    return out


class Forest:
    """Trees in flat arrays: split feature (-1 at a leaf), threshold, children and leaf value."""

    def __init__(self, base: float, feature, threshold, left, right, value, roots):
        self.base, self.roots = base, np.array(roots, np.int64)
        self.feature, self.left, self.right = (np.array(x, np.int64) for x in (feature, left, right))
        self.threshold, self.value = np.array(threshold, float), np.array(value, float)

    def raw(self, x: np.ndarray) -> np.ndarray:
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        while (self.feature[node] >= 0).any():
            f = self.feature[node]
            go_left = x[row, np.maximum(f, 0)] <= self.threshold[node]
            node = np.where(f < 0, node, np.where(go_left, self.left[node], self.right[node]))
        return self.base + self.value[node].sum(axis=1)


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Boosted trees for logistic loss on histograms of quantile bins."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(width)], 1)
    weight = weight / weight.mean()
    rate = min(max(float((weight * y).sum() / weight.sum()), 1e-3), 1 - 1e-3)
    base = float(np.log(rate / (1 - rate)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf() -> int:
        for column, empty in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1), (value, 0.0)):
            column.append(empty)
        return len(feature) - 1

    z = np.full(n, base)
    offset = np.arange(width) * BINS
    for _ in range(trees):
        p = sigmoid(z)
        g, h = weight * (p - y), weight * p * (1 - p)
        at = np.full(n, leaf())
        roots.append(at[0])
        open_ = [at[0]]
        for level in range(depth + 1):
            place = {node: k for k, node in enumerate(open_)}
            k = np.array([place.get(a, -1) for a in range(at.max() + 1)])[at]
            live = np.flatnonzero(k >= 0)
            if not len(live):
                break
            key = (k[live, None] * width * BINS + offset + binned[live]).ravel()
            size = len(open_) * width * BINS
            hist = [np.bincount(key, np.repeat(v[live], width), size).reshape(len(open_), width, BINS).cumsum(axis=2)
                    for v in (g, h)]
            total = [v[:, :1, -1:] for v in hist]
            score = lambda a, b: a * a / (b + SHRINK)
            gain = (score(hist[0], hist[1]) + score(total[0] - hist[0], total[1] - hist[1]) - score(*total))
            gain[(hist[1] < MIN_HESSIAN) | (total[1] - hist[1] < MIN_HESSIAN)] = 0
            gain[:, :, -1] = 0
            following = []
            for i, node in enumerate(open_):
                value[node] = float(-RATE * total[0][i, 0, 0] / (total[1][i, 0, 0] + SHRINK))
                j, cut = np.unravel_index(gain[i].argmax(), gain[i].shape)
                if level == depth or gain[i, j, cut] <= 1e-6 or cut >= len(edges[j]):
                    continue
                feature[node], threshold[node] = int(j), float(edges[j][cut])
                left[node], right[node] = leaf(), leaf()
                mine = live[k[live] == i]
                at[mine] = np.where(binned[mine, j] <= cut, left[node], right[node])
                following += [left[node], right[node]]
            open_ = following
            if not open_:
                break
        z += np.array(value)[at]
    return Forest(base, feature, threshold, left, right, value, roots)


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, keep=None) -> Forest | None:
    sample = labelled_sample(docs, labels, "quality", rows_per_class, keep)

    def measure(cols):
        return {"doc_id": cols["doc_id"], "y": cols["y"], "weight": cols["weight"],
                "x": [statistics(t).tolist() for t in cols["text"]]}

    rows = map_batches(sample, measure, "doc_id long, y int, weight double, x array<double>").toArrow()
    if not len(rows):
        return None
    rows = rows.take(np.argsort(rows["doc_id"].to_numpy(), kind="stable"))
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
    return grow(x, rows["y"].to_numpy().astype(float), rows["weight"].to_numpy())


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                   rows_per_class: int = ROWS_PER_CLASS, keep=None) -> DataFrame:
    """``doc_id, score, predicted`` of every row; ``keep`` restricts the labelled ids to learn from.

    Null, empty and blank texts have all statistics zero and are scored from them.  Without
    labelled rows the score is 0.5 throughout.  Repeated rows and null ids are scored like any
    other; texts of any length are read whole; a score at the threshold is predicted 1; an empty table gives an empty result; only ``doc_id`` and ``text`` (``doc_id,
    quality`` of ``labels``) are read.
    """
    source = id_and_text(docs)
    shared = source.sparkSession.sparkContext.broadcast(fit(source, labels, rows_per_class, keep))

    def score(cols):
        n = len(cols["doc_id"])
        p = np.full(n, 0.5)
        if shared.value is not None:
            p = sigmoid(shared.value.raw(np.stack([statistics(t) for t in cols["text"]])))
        return {"doc_id": cols["doc_id"], "score": p.tolist(), "predicted": (p >= threshold).astype(int).tolist()}

    return map_batches(source, score, "doc_id long, score double, predicted int")


def op6_quality_trees(spark, sf_dir: str) -> DataFrame:
    """Learned on the labels whose id's remainder modulo 5 is not 0."""
    scored = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                            keep=id_remainder(5) != 0)
    return scored.select("doc_id", F.coalesce(id_remainder(5) == 0, F.lit(False)).alias("held_out"),
                         "score", "predicted")
