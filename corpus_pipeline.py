"""Corpus pipeline: documents to packed training sequences in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
read again as the next one's ``docs``.  All but the last return the columns of ``docs``.  Rows
with a null id pass the near-duplicate stage (they can't be named as copies); an empty table
gives empty stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.common import WORD, Scratch, among, id_and_text, number_of_rows, table, whole_row, without
from blotter.llm.minhash import near_duplicates
from blotter.llm.mixing import mixture, placements
from blotter.llm.packing import pack
from blotter.llm.quality_rules import kept_documents
from blotter.llm.surrogates import replace_personal_data, session_key


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars``, where the table has it, follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the model learns from ``labels``."""
    return kept_documents(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five-word shingles, similarity 0.8): the one with the
    smallest id.  Of equal rows (id and text) one stays.  Different texts of a repeated id are
    compared like different documents; all but the one that sorts first come after all ids.  Ids may
    be any longs; rows with a null id pass, null and empty texts have no near-duplicates, texts of any
    length are compared whole, and columns of any name are carried along."""
    scratch = Scratch(spark, "dedup-stage")
    counts = docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).count()
    repeated = scratch.write(counts.where("count > 1").select("doc_id"))
    once, again = without(docs, repeated, scratch=scratch), among(docs, repeated)
    texts = (again.select(whole_row(again), F.col("doc_id").cast("long").alias("__id"),
                          F.col("text").cast("string").alias("__text")).dropDuplicates(["__id", "__text"]))
    first = F.row_number().over(Window.partitionBy("__id").orderBy("__text"))
    numbered = scratch.write(texts.withColumn("__n", first))
    keyed, later = _keyed(numbered, counts.select("doc_id"), scratch)
    both = id_and_text(once).unionAll(keyed.select("__key", "__text"))
    classes = near_duplicates(both, words=5, part=80, of=100).where("doc_id IS NOT NULL")
    if not number_of_rows(later):
        gone = classes.where("NOT kept")
    else:  # a later text's key is no id, so the first of a component is chosen anew
        classes = scratch.write(classes.join(later.select(F.col("__key").alias("doc_id"), F.lit(1).alias("later")),
                                             "doc_id", "left").select("doc_id", "component_id", F.coalesce(
                                                 "later", F.lit(0)).alias("later")))
        best = classes.groupBy("component_id").agg(F.min(F.struct("later", "doc_id")).alias("best"))
        gone = classes.join(best, "component_id").where("doc_id != best.doc_id")
    gone = scratch.write(gone.select("doc_id").distinct())
    return without(once, gone, scratch=scratch).unionAll(without(keyed, gone, "__key", scratch).select("__row.*"))


def _keyed(numbered: DataFrame, ids: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``numbered`` with a ``__key`` of its own for every text: the id for the first of an id, for a later one a
    hash that is no id and no other key (tried again with another salt until that holds), and these keys."""
    salt = 0
    while True:
        key = F.when(F.col("__n") == 1, F.col("__id")).otherwise(F.xxhash64("__id", "__text", F.lit(salt)))
        keyed = scratch.write(numbered.withColumn("__key", key))
        later = scratch.write(keyed.where("__n > 1").select("__key"))
        if not number_of_rows(later):
            return keyed, later
        clash = (later.groupBy("__key").count().where("count > 1").select("__key")
                 .unionAll(later.join(ids.toDF("__key"), "__key", "left_semi")))
        if clash.isEmpty():
            return keyed, later
        scratch.drop(keyed, later)
        salt += 1


def surrogate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates under the session's key.  All rows stay, null ids and equal rows
    too; null and empty texts stay as they are, long ones are read whole."""
    return _recounted(replace_personal_data(docs, session_key(spark)))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes, one row a pass over a document, in training order.  A pass that stops
    inside a document keeps its first words, with the white space after each."""
    placed = placements(mixture(docs, carry=tuple(docs.columns)))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col("row.text"), F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0)),
                               F.lit(1), F.col("words").cast("int")), "")
    text = F.when(F.col("words") < F.col("size"), cut).otherwise(F.col("row.text"))
    return _recounted(placed.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens; ids as their checksum."""
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                             "sequence_id", "offset", "sequence_tokens", "sequence_cost")


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", dedup_stage),
    ("surrogates", surrogate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: a fitted model and component search are no SQL; tests hold the stages against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; the tables between the stages are written to the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs, last = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        written = scratch.write(stage(spark, docs, sf_dir))
        scratch.drop(last)
        docs = last = written
    return STAGES[-1][1](spark, docs, sf_dir)
