"""Complaint pipeline: integrate two complaint files, then the trend report.

    curated = curate_complaints(spark, historic_csv, current_csv)
    report = complaint_report(curated)       # dict of DataFrames

Stages run as one lineage; pass ``out`` to write the curated table
(partitioned by year) and start the report from it, so the report's several
branches read the table instead of re-running union and dedup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter import schemas
from blotter.functions.dates import month_start
from blotter.operators.integrate import (
    IncidentSource, IntegrateSpec, integrate_incidents, union_before_dedup)
from blotter.operators.profile import profile
from blotter.functions.categorical import is_known
from blotter.operators.trend import (
    category_group_trend, group_share, level_endpoints, level_trend, monthly_counts,
    monthly_trend)
from blotter.session import cut_lineage
from blotter.sources.files import read_csv_text, write_and_reload

# Texts that stand for a missing offence type (UNKNOWN is a type like any other).
NO_OFFENCE = ("(null)",)

COMPLAINT_SPEC = IntegrateSpec(
    key="CMPLNT_NUM", start_date="CMPLNT_FR_DT", end_date="CMPLNT_TO_DT",
    date_pattern="M/d/yyyy", columns=list(schemas.COMPLAINT_COLUMNS),
    schema=schemas.COMPLAINT_SCHEMA, date_col="Crime_Date",
    min_date=schemas.COMPLAINT_MIN_DATE, label_col="Crime_Year_Month", label_padded=False,
    source_col="source")


def complaint_sources(historic: DataFrame, current: DataFrame) -> list[IncidentSource]:
    """Historic file first: it wins when a complaint number is in both."""
    return [IncidentSource(historic, "historic", priority=0),
            IncidentSource(current, "current", priority=1)]


def curate_complaints(spark: SparkSession, historic_path: str, current_path: str,
                      out: str | None = None) -> DataFrame:
    hist = read_csv_text(spark, historic_path)
    curr = read_csv_text(spark, current_path)
    curated = (integrate_incidents(complaint_sources(hist, curr), COMPLAINT_SPEC)
               .withColumnsRenamed({"Latitude": "latitude", "Longitude": "longitude"}))
    if out is None:
        return curated
    # year-partitioned: a filter on `year` (kept as a column) skips whole folders
    return write_and_reload(curated.withColumn("year", F.year("Crime_Date")), out,
                            partition_by=["year"])


def complaint_union(spark: SparkSession, historic_path: str, current_path: str) -> DataFrame:
    """Both files as one table before dedup and before rows without a date are dropped."""
    sources = complaint_sources(read_csv_text(spark, historic_path), read_csv_text(spark, current_path))
    return union_before_dedup(sources, COMPLAINT_SPEC)


def union_profile(union: DataFrame) -> dict[str, DataFrame]:
    """Checks on the union: rows and NULLs, duplicate keys, dates with NULLs, and offence
    codes without a description."""
    checks = profile(union, key="CMPLNT_NUM", date_col="Crime_Date", code_pairs=("KY_CD", "OFNS_DESC"))
    return {f"union_{name}": df for name, df in checks.items()}


def complaint_report(curated: DataFrame, cut: bool = True) -> dict[str, DataFrame]:
    """The analysis tables: total trend, level grid and endpoints, offence
    groups, victim-group share, and the profile checks.

    The trend tables all come from one aggregation of the curated incidents
    to (month, level, offence, victim group) counts, a table of at most
    months × categories rows; with ``cut`` it is checkpointed, so the four
    trends never rescan the incidents.  The profile checks read the curated
    table itself: pass the written table (``curate_complaints(..., out=...)``,
    as the command line does), or each check re-runs the integration.
    """
    cube = (curated.where(F.col("Crime_Date").isNotNull())
            .groupBy(month_start("Crime_Date").alias("month"), "LAW_CAT_CD", "OFNS_DESC", "VIC_RACE")
            .agg(F.count(F.lit(1)).alias("n")))
    if cut:
        cube = cut_lineage(cube)
    levels = level_trend(cube, "month", "LAW_CAT_CD", weight="n")
    # report tables are months × series: ordering them is cheap (O1)
    return {
        "monthly_trend": monthly_trend(cube, "month", weight="n").orderBy("month"),
        "level_trend": levels.orderBy("month", "level"),
        "level_endpoints": level_endpoints(levels).orderBy("level"),
        "offence_group_trend": category_group_trend(cube, "month", "OFNS_DESC",
                                                    schemas.OFFENCE_GROUPS, weight="n",
                                                    sentinels=NO_OFFENCE)
        .orderBy("grp", "month"),
        "victim_share": group_share(cube, "month", "VIC_RACE", schemas.SHARE_GROUP,
                                    weight="n").orderBy("month"),
        "offence_type_counts": monthly_counts(cube.where(is_known("OFNS_DESC", NO_OFFENCE)), "month",
                                              by=["OFNS_DESC"], weight="n")
        .orderBy("OFNS_DESC", "month"),
        **profile(curated, key="CMPLNT_NUM", date_col="Crime_Date",
                  categorical=["LAW_CAT_CD", "OFNS_DESC", "VIC_RACE"], code_pairs=("KY_CD", "OFNS_DESC")),
    }
