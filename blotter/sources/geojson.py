"""GeoJSON areas.

A FeatureCollection file is one JSON document, read whole by one task
(``multiLine``); for one that is too large for that, ``separator`` names the text every
feature begins with, and the file is read in pieces between two of them by
as many tasks as it has blocks.  Newline-delimited features (one Feature per line) are read
splittably with ``lines=True``.  Coordinates are read as raw JSON text so
Polygon and MultiPolygon features can share one schema, then parsed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.operators.spatial import multipolygon

GEOMETRY = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("coordinates", T.StringType()),
])


def feature_schema(properties: Sequence[str]) -> T.StructType:
    props = T.StructType([T.StructField(p, T.StringType()) for p in properties])
    return T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", props),
        T.StructField("geometry", GEOMETRY),
    ])


#: How a feature begins where a writer puts no blanks; the usual ``separator``.
FEATURE_START = '{"type":"Feature"'


def read_features(spark: SparkSession, path: str, properties: Sequence[str],
                  lines: bool = False, separator: str | None = None) -> DataFrame:
    """One row per feature: ``properties`` struct and ``geometry`` struct.

    ``separator`` (:data:`FEATURE_START`, or the same with the file's own blanks) reads large
    collections in parallel; a file whose features do not all begin with it fails.
    """
    if lines:
        return spark.read.schema(feature_schema(properties)).json(path).select("properties", "geometry")
    if separator is not None:
        return _split_features(spark, path, properties, separator)
    return (spark.read.schema(collection_schema(properties)).option("multiLine", True).json(path)
            .select(F.explode("features").alias("f"))
            .select("f.properties", "f.geometry")
            .repartition(spark.sparkContext.defaultParallelism))  # one task has read it all


def _split_features(spark: SparkSession, path: str, properties: Sequence[str], separator: str) -> DataFrame:
    """Features from the text between separators.

    No JSON string can hold the separator (its quotes would be escaped), so what lies
    between two of them is one feature and the comma after it; the last one is followed by the
    end of the collection.  What stands before the first begins with a brace and ends with
    the opening of ``features``; else the features begin differently, which is an error and
    not an empty result.
    """
    pieces = spark.read.option("lineSep", separator).text(path)
    text = F.trim(F.regexp_replace("value", r"[\r\n\t]", " "))
    head = text.startswith("{")
    opens = text.rlike(r'"features" *: *\[ *$') | text.rlike(r'"features" *: *\[ *\]')
    wrong = F.concat(F.lit(f"no FeatureCollection whose features begin with {separator}: "), F.substring(text, 1, 200))
    feature = F.from_json(F.concat(F.lit(separator), text), feature_schema(properties), {"mode": "FAILFAST"})
    rows = pieces.where(text != "").select(
        F.when(head & ~opens, F.raise_error(wrong).cast(feature_schema(properties)))
        .when(~head, feature).alias("f"))
    return rows.where(F.col("f").isNotNull()).select("f.properties", "f.geometry")


def collection_schema(properties: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField("type", T.StringType()),
                         T.StructField("features", T.ArrayType(feature_schema(properties)))])


def features_from_text(texts: DataFrame, text_col: str, properties: Sequence[str]) -> DataFrame:
    """The features of FeatureCollections held as texts, one collection a row; a text that
    is no collection gives none."""
    parsed = F.from_json(text_col, collection_schema(properties))
    return (texts.select(F.explode(parsed["features"]).alias("f"))
            .select("f.properties", "f.geometry"))


def areas_from_features(features: DataFrame, keep: Sequence[str],
                        geom_col: str = "geometry") -> DataFrame:
    """Areas table: the kept properties as columns plus a MultiPolygon array."""
    return features.select(
        *[F.col(f"properties.{p}").alias(p) for p in keep],
        multipolygon(F.col("geometry.type"), F.col("geometry.coordinates")).alias(geom_col))


def area_dimension(features: DataFrame, code: str = "ntacode", name: str = "ntaname") -> DataFrame:
    """Q9: distinct (code, name) pairs of the features."""
    return (features.select(F.col(f"properties.{code}").alias(code),
                            F.col(f"properties.{name}").alias(name))
            .distinct())


def read_areas(spark: SparkSession, path: str, properties: Sequence[str],
               lines: bool = False, separator: str | None = None) -> DataFrame:
    return areas_from_features(read_features(spark, path, properties, lines, separator), properties)
