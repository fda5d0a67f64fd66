import pytest
from pyspark.sql import functions as F

#: extra columns whose names operators use inside or return
CLASHING = ("row", "id", "key", "score", "size", "bucket", "digest", "bands", "signature", "u", "v", "component",
            "family", "target", "taken", "positions", "kind", "unit", "mentions", "words", "kept", "n_words", "pass",
            "_spot", "_n", "_partial", "before", "ids", "part", "frame", "start", "y", "weight", "e", "new", "between")


@pytest.fixture
def docs_of(spark):
    """A documents table from ``(doc_id, text[, lang, source])`` rows, with clashing extra columns."""
    def make(rows, extra=True):
        rows = [tuple(r) + (None, None, None, None)[:4 - len(r)] for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        df = df.withColumn("n_chars", F.char_length("text").cast("long"))
        return df.withColumns({c: F.lit(7) for c in CLASHING}) if extra else df
    return make


@pytest.fixture
def labels_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    return make
