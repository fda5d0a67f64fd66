"""Language identification with spans of mixed-language text.

A word's script (the range its first letter lies in) narrows the languages it may belong to;
its character n-grams give each of those a naive Bayes score.  Viterbi over the words, with a
penalty for each switch, labels spans.  A text in which no language gains more than half a
penalty over the best one anywhere cannot have a switch on its best path (m stretches of other
languages gain at most m halves and cost at least m - 1 penalties; one alone loses to the best
language), so its one span needs no dynamic programme; the others are traced word by word.

Counts of n-grams by language come from a sample of at most ``ROWS_PER_LANG`` texts a language;
every text is labelled whole, in Arrow batches.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import encoded, id_remainder, map_batches, table
from blotter.llm.linear import WordTable, batches_of, grams_of, smallest_hashes

ROWS_PER_LANG = 800     # bound of the training sample, for each language
MASK = (1 << 16) - 1
SIZES = (1, 2, 3, 4)
SMOOTHING = 0.5
SCRIPT_SHARE = 0.01     # a language uses a script if it writes so many of its words in it
SWITCH = 12.0           # penalty of a switch, in nats
UNKNOWN = "und"

#: first code points of the script ranges, and their names (fixed values)
SCRIPTS = [(0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "southeast_asian"), (0x10A0, "georgian"),
           (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
           (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"),
           (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"),
           (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB07, "other"),
           (0xFF21, "latin"), (0xFF5B, "other"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"),
           (0x20000, "han"), (0x32000, "other")]
_STARTS = [start for start, _ in SCRIPTS]
_LETTER = re.compile(r"[^\W\d_]")


def script_of(word: str) -> str | None:
    """Script of the first letter; None without a letter."""
    found = _LETTER.search(word)
    if not found:
        return None
    return SCRIPTS[bisect_right(_STARTS, ord(found[0])) - 1][1]


def lowered(word: bytes) -> bytes:
    return word.decode("utf-8", "replace").strip(".,;:!?\"'()[]").lower().encode()


class Model:
    """Log-probabilities of hashed n-grams by language, and the languages of each script."""

    def __init__(self, counts: dict[tuple[str, bytes], int]):
        self.langs = sorted({lang for lang, _ in counts})
        place = {lang: i for i, lang in enumerate(self.langs)}
        table_ = np.full((MASK + 1, len(self.langs)), SMOOTHING)
        written = {}
        spoken = []
        for (lang, word), n in counts.items():
            script = script_of(word.decode("utf-8", "replace"))
            if script is not None:
                written.setdefault(script, np.zeros(len(self.langs)))[place[lang]] += n
                spoken.append((word, place[lang], n))
        for at in range(0, len(spoken), 20_000):
            words, langs, n = map(list, zip(*spoken[at:at + 20_000]))
            owner, gram = grams_of(words, SIZES, MASK)
            np.add.at(table_, (gram, np.array(langs)[owner]), np.array(n)[owner])
        self.log = np.log(table_ / table_.sum(axis=0)).astype(np.float32)
        total = sum(written.values(), np.zeros(len(self.langs)))
        self.scripts = {s: n >= SCRIPT_SHARE * np.maximum(total, 1) for s, n in written.items()}

    def values(self, words: list[bytes]) -> np.ndarray:
        """Score of each language for each word, at most 0; all 0 for a word without a letter."""
        owner, gram = grams_of([lowered(w) for w in words], SIZES, MASK)
        out = np.stack([np.bincount(owner, self.log[gram, k], len(words)) for k in range(len(self.langs))], axis=1)
        scripts = [script_of(w.decode("utf-8", "replace")) for w in words]
        for script in set(scripts):
            mine = np.array([s == script for s in scripts])
            allowed = self.scripts.get(script)
            if script is None:
                out[mine] = 0
            elif allowed is not None and allowed.any() and not allowed.all():
                out[np.ix_(mine, ~allowed)] = out[mine][:, allowed].min(axis=1, keepdims=True) - 2 * SWITCH
        return out - out.max(axis=1, keepdims=True)


def best_path(scores: np.ndarray, switch: float = SWITCH) -> list[tuple[int, int, int]]:
    """Spans ``(first word, end, language)`` of the best path; ties go to staying and to the
    earlier language."""
    return best_paths([scores], switch)[0]


#: So many of a batch's longest texts are walked one by one: numpy's steps pay for several texts at once.
ALONE = 6


def best_paths(texts: list[np.ndarray], switch: float = SWITCH) -> list[list[tuple[int, int, int]]]:
    """The best path of each text.

    A text in which no run of words gains more than half the penalty in another language than its
    best one has a single span.  The others are walked word by word, all at the same position in one step
    of numpy, longest first, so that the texts that go on are always the first ones."""
    out: list = [_one_span(scores, switch) for scores in texts]
    open_ = sorted((i for i, spans in enumerate(out) if spans is None), key=lambda i: -len(texts[i]))
    for i in open_[:ALONE]:
        out[i] = _spans(_walk(texts[i], switch))
    if rest := open_[ALONE:]:
        for i, path in zip(rest, _walk_together([texts[i] for i in rest], switch)):
            out[i] = _spans(path)
    return out


def _one_span(scores: np.ndarray, switch: float) -> list[tuple[int, int, int]] | None:
    total = scores.sum(axis=0, dtype=np.float64)
    top = int(total.argmax())
    gain = np.cumsum(scores - scores[:, [top]], axis=0, dtype=np.float64)
    gain = np.concatenate([np.zeros((1, scores.shape[1])), gain])
    if (gain - np.minimum.accumulate(gain, axis=0)).max() <= switch / 2:
        return [(0, len(scores), top)]
    return None


def _walk(scores: np.ndarray, switch: float) -> np.ndarray:
    langs = range(scores.shape[1])
    now, back = scores[0].tolist(), []
    for row in scores[1:].tolist():
        best = max(now)
        came = now.index(best)
        moved = best - switch
        back.append([k if now[k] >= moved else came for k in langs])
        now = [(now[k] if now[k] >= moved else moved) + row[k] for k in langs]
    at = now.index(max(now))
    path = [at]
    for step in reversed(back):
        at = step[at]
        path.append(at)
    return np.array(path[::-1])


def _walk_together(texts: list[np.ndarray], switch: float) -> list[np.ndarray]:
    """``_walk`` of texts that come by falling length."""
    sizes = np.array([len(t) for t in texts])
    first = np.cumsum(sizes) - sizes
    scores = np.concatenate(texts).astype(np.float64)
    langs = np.arange(scores.shape[1])
    back = np.zeros(scores.shape, np.int32)
    going = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # texts longer than each position
    now = scores[first]
    for t in range(1, sizes[0]):
        n = going[t]
        at, before = first[:n] + t, now[:n]
        moved = before.max(axis=1, keepdims=True) - switch
        stay = before >= moved
        back[at] = np.where(stay, langs, before.argmax(axis=1)[:, None])
        now[:n] = np.where(stay, before, moved) + scores[at]
    state = now.argmax(axis=1)
    path = np.empty(len(scores), np.int64)
    path[first + sizes - 1] = state
    for t in range(sizes[0] - 1, 0, -1):
        n = going[t]
        state[:n] = back[first[:n] + t, state[:n]]
        path[first[:n] + t - 1] = state[:n]
    return np.split(path, first[1:])


def _spans(path: np.ndarray) -> list[tuple[int, int, int]]:
    cuts = [0, *(np.flatnonzero(path[1:] != path[:-1]) + 1).tolist(), len(path)]
    return [(a, b, int(path[a])) for a, b in zip(cuts, cuts[1:])]


def fit(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG) -> Model | None:
    """``docs`` with ``doc_id, text, lang``: only rows that may be learned from."""
    docs = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    named = docs.select("doc_id", "lang").where("doc_id IS NOT NULL")
    taken = smallest_hashes(named, "lang", rows_per_lang).select("doc_id", "lang").distinct()
    sample = docs.join(F.broadcast(taken), ["doc_id", "lang"])  # rows_per_lang ids a language

    def count(cols):
        bags: dict[str, Counter] = {}
        for lang, text in zip(cols["lang"], cols["text"]):
            bags.setdefault(lang, Counter()).update(map(lowered, encoded(text).split()))
        flat = [(lang, w, n) for lang, bag in bags.items() for w, n in bag.items() if w]
        return dict(zip(("lang", "word", "n"), map(list, zip(*flat)))) if flat else {"lang": [], "word": [], "n": []}

    rows = (map_batches(sample.select("lang", "text"), count, "lang string, word binary, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow())
    counts = {(lang, w): n for lang, w, n in zip(*(rows[c].to_pylist() for c in ("lang", "word", "n")))}
    return Model(counts) if counts else None


def languages(docs: DataFrame, learn_from: DataFrame, rows_per_lang: int = ROWS_PER_LANG,
              switch: float = SWITCH) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` of every row of ``docs``.

    ``spans`` are word ranges ``(start, end, lang)`` in order, covering all words.  ``lang_pred``
    is the language with the most words that have a letter; ``score`` is its share of them times
    its posterior over the whole text.  A text that is null or has no letter is ``und`` with
    score 0 and no spans, and so is every text if there is nothing to learn from.  Rows of
    ``learn_from`` (``doc_id, text, lang``) without a language or text teach nothing.  Repeated
    rows and null ids are labelled like any other; a text of any length is read whole; ties go to
    the language that comes first by code point; other columns are not read.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = source.sparkSession.sparkContext.broadcast(  # a table of fixed size a language
        fit(learn_from.select("doc_id", "text", "lang"), rows_per_lang))
    state: dict = {}

    def label(cols):
        model = shared.value
        out = {"doc_id": cols["doc_id"], "lang_pred": [], "score": [], "spans": []}
        if model is not None and "words" not in state:
            state["words"] = WordTable(model.values, len(model.langs))
        for some in batches_of(cols["text"]):
            split = [encoded(t).split() if model is not None and t and _LETTER.search(t) else None for t in some]
            if model is not None:
                state["words"].learn([w for w in split if w])
            known = state.get("words")
            scored = [known.rows[known.numbers(words)] for words in split if words is not None]
            paths = iter(zip(scored, best_paths(scored, switch)))
            for words in split:
                one(next(paths) if words is not None else None, model, out)
        return out

    def one(walked, model, out):
        lang, score, spans = UNKNOWN, 0.0, []
        if walked is not None:
            scores, path = walked
            spoken = np.append(0, np.cumsum((scores != 0).any(axis=1) if len(model.langs) > 1
                                            else np.ones(len(scores), bool)))
            share = np.zeros(len(model.langs))
            for a, b, k in path:
                share[k] += spoken[b] - spoken[a]
            if not share.any():  # no word tells the languages apart
                for a, b, k in path:
                    share[k] += b - a
            best = int(share.argmax())
            total = scores.sum(axis=0, dtype=np.float64)
            weight = np.exp(total - total.max())
            lang = model.langs[best]
            score = float(share[best] / share.sum() * (weight[best] / weight.sum() if len(path) == 1 else 1.0))
            spans = [{"start": a, "end": b, "lang": model.langs[k]} for a, b, k in path]
        out["lang_pred"].append(lang)
        out["score"].append(score)
        out["spans"].append(spans)

    return map_batches(source, label, "doc_id long, lang_pred string, score double, "
                                      "spans array<struct<start:int,end:int,lang:string>>")


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """Learned from the documents whose id's remainder modulo 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    labelled = languages(docs, docs.where(id_remainder(4) != 2))
    return labelled.select("doc_id", F.coalesce(id_remainder(4) == 2, F.lit(False)).alias("held_out"),
                           "lang_pred", "score", F.size("spans").alias("n_spans"))
