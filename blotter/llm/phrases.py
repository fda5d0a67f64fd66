"""Phrase mining by sorted occurrence relations (SETM), cohesion scores and their best phrases.

1. One pass over the texts writes the first relation, blocks of occurrences ``(slot, item)`` sorted by
   slot.  Slots number the words of a block; between two pieces a slot stays free, so an adjacent
   position in the same piece is the next slot, and nothing else is.  Items point into the
   block's phrases.
2. Group-count: a block counts its phrases, Spark sums the counts, first by a hash of language and
   phrase, as most phrases are rare and hashes are short, then by the phrases themselves where the hash
   has the least number.  Phrases that share a hash only pass the first sum; the second is exact.
3. Semi-join: occurrences of infrequent phrases leave their relation before it is extended.  The
   frequent hashes reach the blocks as a bitmap of bounded size; what it lets through by mistake is
   counted exactly like the rest, and falls to the count.
4. Merge-join: two frequent phrases on adjacent slots of a block are an occurrence of the next length; both
   sides are sorted, so the join is one scan.  The new relation is written, and so on up to the
   longest length.
5. Frequent phrases are joined with the counts of their parts at every cut, and those inside a
   longer phrase that is nearly as frequent are dropped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import Scratch, arrow_schema, encoded, table

SEED = 42
#: words of a block, about (texts are gathered by their bytes, a longer text makes a longer block): the more, the
#: fewer times a word or phrase is hashed, shuffled and counted
BLOCK_WORDS = 1 << 20
WORD_BYTES = 6
#: bits of a phrase's hash
HASH_BITS = 40
#: bits of the bitmap for each frequent hash, and its size at most (2**26 bits are 8 MB)
BITS_PER_PHRASE = 32
MAX_BITS = 26
MIN_BITS = 12

#: stops end a piece; the bytes of whitespace that do not end one separate words
STOPS = b".,;:!?\n\x0b\x0c\r"
END = b"."
_TO_END = bytes.maketrans(STOPS, END * len(STOPS))

#: ``words``: the block's words, one a space; ``slots`` (as steps), ``items``: occurrences; ``phrases``: the
#: numbers of each phrase's words.  Each is compressed, so that many blocks fit into a batch of rows.
BLOCK = "lang string, words binary, slots binary, items binary, phrases binary"
COUNTS = "lang string, phrase string, f long"


class _Block:
    """Texts of one language while they are read."""

    def __init__(self):
        self.texts: list[bytes] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        self.texts.append(text)
        self.size += len(text) + 1

    def row(self, lang: str):
        """The block's row (none without a word): its different words are told apart at once."""
        pieces = END.join(self.texts).lower().translate(_TO_END).replace(END, b" . ")
        tokens = pc.ascii_split_whitespace(pa.array([pieces], pa.large_binary()).view(pa.large_string()))
        coded = tokens.values.view(pa.large_binary()).dictionary_encode()
        known = coded.dictionary.to_pylist()
        word = np.array([w != END and w != b"" for w in known], bool)  # a first or last token may be empty
        items = (np.cumsum(word, dtype=np.int32) - 1)[coded.indices.to_numpy()]
        slots = np.flatnonzero(word[coded.indices.to_numpy()]).astype(np.int32)
        words = [w for w, is_word in zip(known, word.tolist()) if is_word]
        return _row(lang, b" ".join(words), slots, items[slots], np.arange(len(words))) if words else None


def _row(lang: str, words: bytes, slots: np.ndarray, items: np.ndarray, phrases: np.ndarray):
    """A row of ``BLOCK``; its occurrences are sorted by slot."""
    from zstandard import ZstdCompressor
    pack = ZstdCompressor(level=1).compress
    numbers = np.diff(slots, prepend=0), items, phrases
    return (lang, pack(words), *(pack(n.astype(np.int32).tobytes()) for n in numbers))


def _first(docs: DataFrame) -> DataFrame:
    """The relation of single words, from ``lang, text``."""
    schema = arrow_schema(docs.sparkSession, BLOCK)

    def run(batches):
        open_: dict[str, _Block] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()):
                if not text:
                    continue
                block = open_.setdefault(lang, _Block())
                block.add(text)
                if sum(b.size for b in open_.values()) >= BLOCK_WORDS * WORD_BYTES:
                    largest = max(open_, key=lambda name: open_[name].size)
                    if row := open_.pop(largest).row(largest):
                        yield _batch([row], schema)
        for lang, block in open_.items():
            if row := block.row(lang):
                yield _batch([row], schema)

    return docs.select("lang", "text").mapInArrow(run, BLOCK)


def _batch(rows, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def _unpacked(batches, length: int):
    """Each block of the batches: language, words, slots, items, phrases (one row each)."""
    from zstandard import ZstdDecompressor
    unpack = ZstdDecompressor().decompress
    for batch in batches:
        for row in range(batch.num_rows):
            lang = batch.column(0)[row].as_py()
            words, *numbers = (unpack(batch.column(i)[row].as_buffer()) for i in range(1, 5))
            steps, items, phrases = (np.frombuffer(n, np.int32) for n in numbers)
            words = words.decode("utf-8", "surrogatepass").split(" ") if words else []
            yield lang, words, np.cumsum(steps, dtype=np.int32), items, phrases.reshape(-1, length)


def _texts(words: list[str], phrases: np.ndarray) -> list[str]:
    if phrases.shape[1] == 1:
        return words if len(phrases) == len(words) else [words[i] for i in phrases[:, 0].tolist()]
    return list(map(" ".join, zip(*([words[i] for i in column] for column in phrases.T.tolist()))))


def _hashes(lang: str, words: list[str], phrases: np.ndarray) -> np.ndarray:
    """A hash of ``HASH_BITS`` for each phrase, from the hashes of its words."""
    from xxhash import xxh64_digest, xxh64_intdigest
    seed = xxh64_intdigest(encoded(lang), SEED)
    of_word = np.frombuffer(b"".join([xxh64_digest(encoded(w), seed) for w in words]), ">u8").astype(np.uint64)
    h = np.zeros(len(phrases), np.uint64)
    for column in phrases.T:
        h = (h ^ of_word[column]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def _hashed(relation: DataFrame, length: int, least: int) -> DataFrame:
    """``key``: hashes whose phrases occur ``least`` times or more together."""
    schema = pa.schema([("key", pa.int64()), ("f", pa.int64())])

    def run(batches):
        for lang, words, _, items, phrases in _unpacked(batches, length):
            counts = np.bincount(items, minlength=len(phrases))
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(lang, words, phrases)), pa.array(counts, pa.int64())],
                                             schema=schema)

    return (relation.mapInArrow(run, "key long, f long").groupBy("key").agg(F.sum("f").alias("f"))
            .where(F.col("f") >= least).select("key"))


def _counted(relation: DataFrame, length: int, maybe) -> DataFrame:
    """Occurrences of each phrase whose hash ``maybe`` holds, by language: summed in each block, then
    over all."""
    schema = arrow_schema(relation.sparkSession, COUNTS)

    def run(batches):
        for lang, words, _, items, phrases in _unpacked(batches, length):
            some = np.flatnonzero(maybe.value.has(_hashes(lang, words, phrases)))
            counts = np.bincount(items, minlength=len(phrases))[some]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(_texts(words, phrases[some]), pa.string()),
                 pa.array(counts, pa.int64())], schema=schema)

    return relation.mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _totals(relation: DataFrame) -> DataFrame:
    """``lang, n``: all word occurrences, from the relation of single words."""
    schema = pa.schema([("lang", pa.string()), ("n", pa.int64())])

    def run(batches):
        for lang, _, _, items, _ in _unpacked(batches, 1):
            yield _batch([(lang, len(items))], schema)

    return relation.mapInArrow(run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


class _Filter:
    """Which hashes may be frequent: a bitmap (no frequent one is ever missing)."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def has(self, keys: np.ndarray) -> np.ndarray:
        spots = keys & ((1 << self.bits) - 1)
        return (self.words[spots >> 6] >> (spots & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def _filter(keys: DataFrame) -> _Filter:
    """The bitmap of the ``key``s: sized by their number, at most 2**MAX_BITS bits.  Spark sets its
    bits; the driver gets the words that have any, two longs each."""
    bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(max(1, keys.count()) * BITS_PER_PHRASE))))
    spot = F.col("key").bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    flag = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("spot", F.lit(64)).cast("int"))
    found = (keys.select(spot.alias("spot")).select(F.shiftright("spot", 6).alias("word"), flag.alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return _Filter(words, bits)


def _extended(relation: DataFrame, maybe, length: int) -> DataFrame:
    """The relation of the next length: the semi-join with the frequent phrases, then the merge-join
    of the relation with itself on adjacent slots.  ``maybe`` is a broadcast ``_Filter``."""
    schema = arrow_schema(relation.sparkSession, BLOCK)

    def run(batches):
        for lang, words, slots, items, phrases in _unpacked(batches, length):
            kept = maybe.value.has(_hashes(lang, words, phrases))
            stay = kept[items]
            slots, items = slots[stay], items[stay]
            left = np.flatnonzero(np.diff(slots) == 1)
            if not len(left):
                continue
            pair = items[left].astype(np.int64) * len(phrases) + items[left + 1]
            pairs, new = np.unique(pair, return_inverse=True)
            longer = np.concatenate([phrases[pairs // len(phrases)], phrases[pairs % len(phrases), -1:]], axis=1)
            used = np.zeros(len(words), bool)  # words no phrase holds any more leave the block
            used[longer] = True
            number = (np.cumsum(used) - 1)[longer]
            held = " ".join([words[i] for i in np.flatnonzero(used).tolist()]).encode("utf-8", "surrogatepass")
            yield _batch([_row(lang, held, slots[left], new, number)], schema)

    return relation.mapInArrow(run, BLOCK)


def frequent_phrases(docs: DataFrame, least: int, longest: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, length, f`` of the phrases of up to ``longest`` words that occur ``least`` times or
    more, and ``lang, n`` with the number of all word occurrences."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    relation = scratch.write(_first(docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text"))))
    totals = scratch.write(_totals(relation))
    found = []
    for length in range(1, longest + 1):
        keys = scratch.write(_hashed(relation, length, least))
        maybe = docs.sparkSession.sparkContext.broadcast(_filter(keys))
        counts = _counted(relation, length, maybe)
        found.append(scratch.write(counts.where(F.col("f") >= least).withColumn("length", F.lit(length))))
        longer = scratch.write(_extended(relation, maybe, length)) if length < longest else None
        scratch.drop(keys, relation)
        relation = longer
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out, totals


def phrases(docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, inside: int = 80) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best ``top`` phrases.

    Words (A-Z lowered) are runs without blank and tab inside the pieces that ``.,;:!?`` and line ends cut a
    text into.  Candidates are phrases of 2 to ``longest`` words that occur ``least`` times or more; each is
    scored ``floor(2000000 * a / (l + r))`` at its weakest cut (of equal scores the first), in exact decimals.  A
    candidate inside a longer one that has at least ``inside`` percent of its occurrences is dropped.  Ranks
    go by score, then occurrences, then the phrase's bytes, so there are no ties.

    A null language is ``und``; null, empty and blank texts have no words; equal rows count as often as they
    occur; a text of any length is one block at least, so a phrase is never cut.  An empty table gives an
    empty result.  Only ``lang`` and ``text`` are read.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    frequent, totals = frequent_phrases(docs, least, longest, scratch)
    candidates = frequent.where("length > 1").select("lang", "phrase", "length", F.col("f").alias("a"),
                                                      F.split("phrase", " ").alias("parts"))
    part = lambda start, size: F.array_join(F.slice("parts", start, size), " ")
    cuts = candidates.select("lang", "phrase", "a", "length", "parts",
                             F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"),
                       part(F.col("k") + 1, F.col("length") - F.col("k")).alias("rest"))
    counts = lambda phrase, f: frequent.select("lang", F.col("phrase").alias(phrase), F.col("f").alias(f))
    score = F.expr("CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) "
                   "DIV (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    weakest = (cuts.join(counts("first", "l"), ["lang", "first"]).join(counts("rest", "r"), ["lang", "rest"])
               .withColumn("score", score)
               .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))

    spans = F.expr("flatten(transform(sequence(2, length - 1), size -> transform(sequence(1, length - size + 1), "
                   "start -> array_join(slice(parts, start, size), ' '))))")
    covering = (candidates.where("length > 2").select("lang", "a", F.explode(spans).alias("phrase"))
                .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    nearly = F.expr(f"CAST(100 AS DECIMAL(3,0)) * CAST(longer AS DECIMAL(19,0)) >= "
                    f"CAST({int(inside)} AS DECIMAL(3,0)) * CAST(a AS DECIMAL(19,0))")
    left = (weakest.join(covering, ["lang", "phrase"], "left").where(~F.coalesce(nearly, F.lit(False)))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = left.withColumn("rank", rank).where(F.col("rank") <= top)
    return (best.join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op11_phrases(spark, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language of all documents."""
    return phrases(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k AS size, array_to_string(w[s:s + k - 1], ' ') AS phrase
  FROM worded, unnest([1, 2, 3, 4]) AS u(k), unnest(range(1, len(w) - k + 2)) AS v(s)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 30),
cut AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS score
  FROM cand c, unnest(range(1, c.size)) AS u(k)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
weakest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT c.lang, array_to_string(c.w[s:s + m - 1], ' ') AS phrase, max(c.a) AS longer
  FROM cand c, unnest(range(2, c.size)) AS u(m), unnest(range(1, c.size - m + 2)) AS v(s) GROUP BY 1, 2),
ranked AS (
  SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.phrase) AS rank,
         w.phrase, w.a, w.l, w.r, w.score
  FROM weakest w LEFT JOIN inner_ i USING (lang, phrase)
  WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * w.a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN totals USING (lang)
WHERE rank <= 2000
"""
