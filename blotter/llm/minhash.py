"""Near-duplicate documents: universal hash minima, banding, verification, components.

1. One pass over the texts hashes each document's distinct word shingles and keeps ``hashes``
   minima of universal hash functions (multiply-add-shift), the keys of their bands and a
   digest of the normalised text.  Rows and bands are chosen so that a pair exactly at the
   threshold misses every band with a probability of at most ``MISS``.
2. Exact copies fall together by digest; only the smallest id of each goes on.
3. A band bucket links its members to its smallest id (a star, never all pairs).  Each link is
   checked on the signatures, and what they leave on the full shingle sets.
4. Components of the confirmed links.  Where a family (documents held together by buckets)
   still spans several components, its members are compared across them in pairs of blocks of
   bounded size, again by signature first and by full sets after; a block pair returns only
   links that join something, which are merged into the components.

Whatever is joined holds ids, keys and signatures; texts move only for pairs that the
signatures could not rule out.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import Scratch, among, encoded, id_and_text, map_batches, table, without
from blotter.llm.components import components

HASHES = 320
MISS = 1e-5
SIGMAS = 5  # a pair at the threshold stays unless its signature errs by so many deviations
BLOCK = 256

_rng = np.random.default_rng(20140614)
_BYTE = _rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(0, 1 << 62)) * 4 + 5  # odd, so that it has an inverse modulo 2**64
_powers: dict[str, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    key = str(base)
    if key not in _powers or len(_powers[key]) < n:
        size = max(1 << 16, 1 << n.bit_length())
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        _powers[key] = np.multiply.accumulate(factors)
    return _powers[key][:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_hashes(text: str | None, words: int) -> tuple[np.ndarray, bytes]:
    """Sorted 64-bit hashes of the distinct shingles of the whole text, and the text with its
    words lowered (A-Z) and joined by single spaces.  A shingle's hash is a polynomial of its
    bytes, taken from prefix sums; fewer than ``words`` words make one shingle, none none."""
    norm = b" ".join(encoded(text).lower().split())
    if not norm:
        return np.empty(0, np.uint64), norm
    raw = np.frombuffer(norm, np.uint8)
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _powers_of(_BASE, len(raw)), out=prefix[1:])
    gaps = np.flatnonzero(raw == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.append(gaps, len(raw))
    n = max(1, len(starts) - words + 1)
    first, last = starts[:n], ends[min(words, len(ends)) - 1:]
    inverse = _powers_of(pow(_BASE, -1, 1 << 64), len(raw))
    return np.unique(_mix((prefix[last] - prefix[first]) * inverse[first])), norm


def bands_for(threshold: float, hashes: int = HASHES, miss: float = MISS) -> tuple[int, int]:
    """(bands, rows): the most rows a band can have with at most ``miss`` at the threshold."""
    rows = max(r for r in range(1, hashes + 1)
               if r == 1 or (1 - threshold ** r) ** (hashes // r) <= miss)
    return hashes // rows, rows


def _hash_functions(hashes: int):
    rng = np.random.default_rng(hashes)
    a = rng.integers(0, 1 << 63, hashes, np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], rng.integers(0, 1 << 63, hashes, np.uint64)[:, None]


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of each universal hash function over the shingles, as 32-bit numbers."""
    out = np.full(len(a), 0xFFFFFFFF, np.uint64)
    x = shingles >> np.uint64(32)
    for i in range(0, len(x), 1024):
        out = np.minimum(out, ((a * x[i:i + 1024] + b) >> np.uint64(32)).min(axis=1))
    return out.astype(np.uint32)


def _features(docs: DataFrame, words: int, hashes: int, bands: int, rows: int) -> DataFrame:
    a, b = _hash_functions(hashes)
    fold = np.random.default_rng(rows).integers(0, 1 << 63, rows, np.uint64) * np.uint64(2) + np.uint64(1)
    number = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def run(cols):
        out = {"doc_id": cols["doc_id"], "n_shingles": [], "digest": [], "bands": [], "signature": []}
        known: dict[str | None, tuple] = {}
        for text in cols["text"]:
            if text not in known:
                shingles, norm = shingle_hashes(text, words)
                row = (0, None, None, None)
                if len(shingles):
                    sig = signature(shingles, a, b)
                    keys = _mix((_mix(sig[:bands * rows].reshape(bands, rows).astype(np.uint64)) * fold)
                                .sum(axis=1, dtype=np.uint64) + number)
                    row = (len(shingles), hashlib.blake2b(norm, digest_size=16).digest(),
                           keys.view(np.int64).tolist(), sig.tobytes())
                known[text] = row
            for name, value in zip(("n_shingles", "digest", "bands", "signature"), known[text]):
                out[name].append(value)
        return out

    return map_batches(docs, run, "doc_id long, n_shingles long, digest binary, bands array<long>, "
                                  "signature binary")


def _alike(pairs: DataFrame, signatures: DataFrame, least: float) -> DataFrame:
    """The pairs ``(u, v)`` whose signatures agree in at least the share ``least``."""
    sides = (pairs.join(signatures.select(F.col("doc_id").alias("u"), F.col("signature").alias("su")), "u")
             .join(signatures.select(F.col("doc_id").alias("v"), F.col("signature").alias("sv")), "v"))

    def run(cols):
        out = {"u": [], "v": [], "share": []}
        if cols["u"]:
            one, two = (np.frombuffer(b"".join(cols[c]), np.uint32).reshape(len(cols["u"]), -1)
                        for c in ("su", "sv"))
            share = (one == two).mean(axis=1)
            keep = np.flatnonzero(share >= least)
            out = {"u": [cols["u"][i] for i in keep], "v": [cols["v"][i] for i in keep],
                   "share": share[keep].tolist()}
        return out

    return map_batches(sides.select("u", "v", "su", "sv"), run, "u long, v long, share double").distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, part: int, of: int) -> DataFrame:
    """The pairs with ``of * |intersection| >= part * |union|`` on their full shingle sets."""
    sides = (pairs.select("u", "v")
             .join(texts.select(F.col("doc_id").alias("u"), F.col("text").alias("tu")), "u")
             .join(texts.select(F.col("doc_id").alias("v"), F.col("text").alias("tv")), "v"))

    def run(cols):
        sets: dict[str, np.ndarray] = {}

        def of_text(text):
            if text not in sets:
                if len(sets) > 2000:
                    sets.clear()
                sets[text] = shingle_hashes(text, words)[0]
            return sets[text]

        out = {"u": [], "v": []}
        for u, v, tu, tv in zip(cols["u"], cols["v"], cols["tu"], cols["tv"]):
            if _linked(of_text(tu), of_text(tv), part, of):
                out["u"].append(u)
                out["v"].append(v)
        return out

    return map_batches(sides.select("u", "v", "tu", "tv"), run, "u long, v long")


def _across(members: DataFrame, least: float, words: int, part: int, of: int) -> DataFrame:
    """Links between different components of a family, enough to connect what they connect.

    ``members`` are ``family, size, doc_id, component, signature, text``.  They are dealt to
    blocks of about ``BLOCK``; each pair of blocks is one group, so a family of any size is spread
    over many tasks.  A group takes its pairs by falling signature agreement, checks those
    still apart on their full sets, and returns only links that join two parts.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK)).cast("int")
    dealt = (members.withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("family", "doc_id", "component", "signature", "text", "block",
                     F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))

    def compare(pdf):
        import pandas as pd
        sig = np.frombuffer(b"".join(pdf["signature"]), np.uint32).reshape(len(pdf), -1)
        ids, comp, block = (pdf[c].to_numpy() for c in ("doc_id", "component", "block"))
        texts, sets = pdf["text"].to_numpy(), {}
        i, j = pdf["i"].iat[0], pdf["j"].iat[0]
        pairs = []
        for x in np.flatnonzero(block == i):
            near = np.flatnonzero((comp != comp[x]) & (block == j) & ((ids > ids[x]) | (i != j)))
            share = (sig[near] == sig[x]).mean(axis=1) if len(near) else np.empty(0)
            pairs += [(s, x, y) for s, y in zip(share.tolist(), near.tolist()) if s >= least]
        parent = {c: c for c in comp.tolist()}

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        def shingles(k):
            if k not in sets:
                sets[k] = shingle_hashes(texts[k], words)[0]
            return sets[k]

        found = []
        for _, x, y in sorted(pairs, reverse=True):
            a, b = root(comp[x]), root(comp[y])
            if a != b and _linked(shingles(x), shingles(y), part, of):
                parent[max(a, b)] = min(a, b)
                found.append((ids[x], ids[y]))
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return dealt.groupBy("family", "i", "j").applyInPandas(compare, "u long, v long")


def _linked(one: np.ndarray, two: np.ndarray, part: int, of: int) -> bool:
    if of * min(len(one), len(two)) < part * max(len(one), len(two)):
        return False
    common = len(np.intersect1d(one, two, assume_unique=True))
    return common > 0 and of * common >= part * (len(one) + len(two) - common)


def near_duplicates(docs: DataFrame, words: int = 5, part: int = 80, of: int = 100,
                    hashes: int = HASHES) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Two documents are linked if ``of * |A & B| >= part * |A | B|`` for their sets of distinct
    ``words``-word shingles; ``component_id`` is the smallest id reachable over links, and the
    document with that id is kept.  Null, empty and blank texts have no shingles and no links.
    A repeated id is one document that has the links of all its texts; each of its rows is
    returned.  Rows with a null id take no part (``component_id`` null, ``kept`` false).  Texts of
    any length are read whole; a similarity at the threshold is a link.  An empty table gives an empty result; only ``doc_id`` and ``text`` are read.
    """
    threshold = part / of
    bands, rows = bands_for(threshold, hashes)
    least = threshold - SIGMAS * math.sqrt(threshold * (1 - threshold) / hashes)
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    source = id_and_text(docs)

    features = scratch.write(_features(source, words, hashes, bands, rows))
    known = features.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    copies = (known.groupBy("digest").agg(F.min("doc_id").alias("v"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("digest", "v"))
    copied = scratch.write(known.select("digest", F.col("doc_id").alias("u")).join(copies, "digest")
                           .where("u != v").select("digest", "u", "v").distinct())
    copy_links = copied.select("u", "v").distinct()
    # each digest goes on with its smallest id, and an id with its texts that are no copies; which rows
    # those are is found on ids and digests alone (``pair`` holds both)
    pair = lambda doc_id: F.concat("digest", F.unhex(F.lpad(F.hex(doc_id), 16, "0"))).alias("pair")
    dropped = scratch.write(copied.select(pair("u")))
    firsts = scratch.write(without(known.withColumn("pair", pair("doc_id")), dropped, "pair", scratch)
                           .select("doc_id", "bands", "signature"))
    banded = firsts.select("doc_id", F.explode("bands").alias("key"))
    shared = (banded.groupBy("key").agg(F.min("doc_id").alias("v"), F.count(F.lit(1)).alias("members"))
              .where("members > 1"))
    buckets = scratch.write(banded.join(shared, "key"))

    stars = scratch.write(buckets.where("doc_id != v").select(F.col("doc_id").alias("u"), "v").distinct())
    scratch.drop(buckets)
    candidates = scratch.write(stars.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct())
    signatures = scratch.write(among(firsts.select("doc_id", "signature"), candidates))
    alike = scratch.write(_alike(stars, signatures, least))
    texts = scratch.write(among(source, candidates))

    # the likeliest link of each document first; the others only where it left them apart
    best = alike.groupBy("u").agg(F.max_by("v", F.struct("share", F.bitwise_not("v"))).alias("v"))
    found = scratch.write(_confirmed(best, texts, words, part, of))
    label = components(found, scratch)
    rest = _labelled(_labelled(alike, label, "u", "cu"), label, "v", "cv").where("cu != cv")
    rest = rest.join(best, ["u", "v"], "left_anti")
    found = scratch.write(label.unionAll(_confirmed(rest, texts, words, part, of)))
    scratch.drop(label)
    label = components(found, scratch)

    # families of three and more that buckets hold together, not all in one component yet
    family = _labelled(candidates, components(stars, scratch), "doc_id", "family")
    family = scratch.write(_labelled(family, label, "doc_id", "component"))
    open_ = (family.groupBy("family").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("a"),
                                          F.max("component").alias("b"))
             .where("size > 2 AND a != b").select("family", "size"))
    members = family.join(open_, "family").join(signatures, "doc_id").join(texts, "doc_id")
    across = _across(members, least, words, part, of)
    links = scratch.write(label.unionAll(across).unionAll(copy_links))
    final = components(links, scratch)
    scratch.drop(firsts, texts, signatures, stars, alike, family)
    return (_labelled(features.select("doc_id", "n_shingles"), final, "doc_id", "component_id")
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def _labelled(df: DataFrame, label: DataFrame, on: str, name: str) -> DataFrame:
    """``df`` with the component of its column ``on`` (itself where ``label`` has none)."""
    right = label.select(F.col("u").alias(on), F.col("v").alias("_component"))
    return (df.join(right, on, "left").withColumn(name, F.coalesce("_component", on)).drop("_component"))


def op1_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity 0.85, over all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, part=85, of=100)
