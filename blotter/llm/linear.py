"""Linear models over character n-grams of words: hashing, fitting and calibration.

A document is the bag of its words and a word the bag of the hashed n-grams inside it, so a
document's score is a sum of word scores: tasks score each distinct word once and keep it in a
cache of bounded size.  Models are fitted in one place (the driver, or a task) on a bounded
sample of labelled rows; what goes there is each sampled document's word counts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CACHED_WORDS = 300_000


def grams_of(words: list[bytes], sizes: tuple[int, ...], mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte n-grams of many words, each between two boundary marks, repeats included:
    the number of the word and the n-gram, in the order of the words."""
    raw = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), [len(w) + 2 for w in words])
    owners, grams = [], []
    for n in sizes:
        if len(raw) < n:
            continue
        h = np.full(len(raw) - n + 1, n, np.uint32)
        for j in range(n):
            h = (h ^ raw[j:len(raw) - n + 1 + j]) * np.uint32(0x01000193)
        inside = owner[:len(h)] == owner[n - 1:]
        h = h[inside]
        owners.append(owner[:len(inside)][inside])
        grams.append(((h ^ (h >> np.uint32(15))) & np.uint32(mask)).astype(np.int32))
    if not owners:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    owners, grams = np.concatenate(owners), np.concatenate(grams)
    order = np.argsort(owners, kind="stable")
    return owners[order], grams[order]


class WordTable:
    """Numbers of the words met so far and a row of values for each, within a bound.

    ``values(words)`` gives one row a word; it is called with the new words of a batch at once.
    """

    def __init__(self, values, width: int, bound: int = CACHED_WORDS):
        self.values, self.bound = values, bound
        self.number: dict[bytes, int] = {}
        self.rows = np.zeros((1024, width), np.float32)

    def learn(self, texts) -> None:
        """Make room for, and take in, the words of a batch of word collections."""
        new = set().union(*texts).difference(self.number)
        if len(self.number) + len(new) > self.bound:
            self.number.clear()
            new = set().union(*texts)
        new = list(new)
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            first = len(self.number)
            self.number.update(zip(part, range(first, first + len(part))))
            while len(self.rows) < first + len(part):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[first:first + len(part)] = self.values(part)

    def numbers(self, words) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


def batches_of(texts: list, size: int = 400_000):
    """Runs of texts of about ``size`` characters, so that a run's words stay bounded."""
    at, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= size:
            yield texts[at:i + 1]
            at, total = i + 1, 0
    if at < len(texts):
        yield texts[at:]


class Rows:
    """Sparse rows (index and value per entry) with the two products a linear model needs."""

    def __init__(self, lengths, index, value, width: int):
        self.row = np.repeat(np.arange(len(lengths), dtype=self._small(len(lengths))), lengths)
        self.index, self.value = np.asarray(index, np.int32), np.asarray(value, np.float32)
        self.shape = (len(lengths), width)

    @classmethod
    def of_owners(cls, owner, index, value, rows: int, width: int) -> Rows:
        """Rows given by the row number of each entry."""
        out = cls([], index, value, width)
        out.row, out.shape = np.asarray(owner).astype(cls._small(rows)), (rows, width)
        return out

    @staticmethod
    def _small(rows: int):
        """The type of a row's number: one is held for every entry."""
        return np.uint16 if rows <= 1 << 16 else np.int32

    def times(self, w: np.ndarray) -> np.ndarray:
        return self._sums(self.row, w.astype(np.float32), self.index, self.shape[0])

    def transposed_times(self, r: np.ndarray) -> np.ndarray:
        return self._sums(self.index, r.astype(np.float32), self.row, self.shape[1])

    def _sums(self, into, factor, of, size: int) -> np.ndarray:
        out = np.zeros(size)
        for at in range(0, len(self.value), 1 << 19):  # small temporaries for long columns
            part = slice(at, at + (1 << 19))
            out += np.bincount(into[part], self.value[part] * factor[of[part]], size)
        return out


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(times, transposed_times, width: int, y: np.ndarray, weight: np.ndarray,
                 penalty: float, steps: int = 150) -> tuple[np.ndarray, float]:
    """L2-penalised logistic regression by Adam on the whole sample; (weights, intercept)."""
    w, b = np.zeros(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    weight = weight / weight.sum()
    for t in range(1, steps + 1):
        error = weight * (sigmoid(times(w) + b) - y)
        g = np.append(transposed_times(error) + penalty * w, error.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        step = 0.2 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-10)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def fit_platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that turn raw scores into probabilities (Platt's smoothed targets)."""
    pos, neg = (y == 1).sum(), (y == 0).sum()
    if not pos or not neg:
        return 1.0, 0.0
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    mean, spread = z.mean(), z.std() or 1.0
    x, a, b = (z - mean) / spread, 1.0, 0.0
    for _ in range(100):  # Newton steps on two parameters
        p = sigmoid(a * x + b)
        g = np.array([(weight * (p - target) * x).sum(), (weight * (p - target)).sum()])
        h = weight * p * (1 - p) + 1e-9
        hess = np.array([[(h * x * x).sum(), (h * x).sum()], [(h * x).sum(), h.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return a / spread, b - a * mean / spread


def smallest_hashes(rows: DataFrame, by: str, n: int) -> DataFrame:
    """``rows`` (``doc_id`` and ``by``) of the ``n`` ids with the smallest hashes for each value of
    ``by``, with ``_all``, the number of rows of that value.

    Only hashes below four times the share that is wanted go on to be ranked, so a value's
    ranking holds a few times ``n`` rows however many it has.  (It may then miss the bound by
    chance, with a probability that vanishes as ``n`` grows, and gives a few rows less.)
    """
    share = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 62) - 1)) / F.lit(float(1 << 62))
    size = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_all"))
    order = Window.partitionBy(by).orderBy("_share", "doc_id")
    return (rows.withColumn("_share", share).join(size, by).where(F.col("_share") * F.col("_all") <= 4.0 * n)
            .withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n", "_share"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows_per_class: int,
                    keep=None) -> DataFrame:
    """``doc_id, y, weight, text`` of at most ``rows_per_class`` labelled documents of each class.

    The rows with the smallest hash of their id are taken (the same ones whenever the tables are
    the same); ``weight`` is how many labelled rows each stands for.  ``keep`` restricts the ids
    that may be learned from.  The sample has a fixed bound, so it may be broadcast.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .where("doc_id IS NOT NULL AND y IN (0, 1)"))
    if keep is not None:
        known = known.where(keep)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    taken = (smallest_hashes(known, "y", rows_per_class)
             .withColumn("weight", F.greatest(F.lit(1.0), F.col("_all") / F.lit(float(rows_per_class)))))
    return (docs.join(F.broadcast(taken.select("doc_id", "y", "weight")), "doc_id")
            .select("doc_id", "y", "weight", "text"))
