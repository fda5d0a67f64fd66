"""Shooting pipeline: integrate two files, place in neighbourhoods, attach
income, then monthly trends per income band and before/after comparisons.

    shootings = integrate_shootings(spark, historic_csv, ytd_csv)
    located = locate_with_income(shootings, areas, incomes)
    report = shooting_report(shootings, located)
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter import schemas
from blotter.functions.categorical import INCOME_BANDS, band_of, boolean_flag
from blotter.functions.series import series_window, strict_moving_avg
from blotter.operators.compare import (
    SPLIT_DEFAULT, before_after, before_after_by_month, change_matrix)
from blotter.operators.enrich import enrich_area
from blotter.operators.integrate import IncidentSource, IntegrateSpec, integrate_incidents
from blotter.operators.profile import profile
from blotter.operators.spatial import locate
from blotter.operators.trend import add_trend_metrics, monthly_counts
from blotter.session import cut_lineage
from blotter.sources.files import read_csv_text, read_csv_typed
from blotter.sources.geojson import area_dimension, areas_from_features, read_features

# Incomes outside are listed by the lookup's profile.
INCOME_FENCES = (0.0, 500_000.0)

SHOOTING_SPEC = IntegrateSpec(key="incident_key", start_date="occur_date",
                              date_pattern="M/d/yyyy", date_col="occur_date_parsed",
                              source_col="source")


def shooting_sources(historic: DataFrame, ytd: DataFrame) -> list[IncidentSource]:
    """Year-to-date first (it wins ties); only the historic file is date-bounded."""
    return [
        IncidentSource(ytd, "ytd", priority=0, lower_names=True,
                       drop=schemas.SHOOTING_YTD_DROP, yes_no=["statistical_murder_flag"]),
        IncidentSource(historic, "historic", priority=1, lower_names=True,
                       drop=schemas.SHOOTING_HISTORIC_DROP,
                       date_bound=schemas.SHOOTING_HISTORIC_BOUND),
    ]


def integrate_shootings(spark: SparkSession, historic_path: str, ytd_path: str) -> DataFrame:
    """Both files read as text; the historic flag (``true``/``false``) is cast."""
    hist = read_csv_text(spark, historic_path)
    ytd = read_csv_text(spark, ytd_path)
    flag = "statistical_murder_flag"
    hist = hist.toDF(*[c.lower() for c in hist.columns])
    if flag in hist.columns:
        hist = hist.withColumn(flag, boolean_flag(flag))
    out = integrate_incidents(shooting_sources(hist, ytd), SHOOTING_SPEC)
    out = out.drop("occur_date").withColumnRenamed("occur_date_parsed", "occur_date")
    # canonical types for the named columns (the flag is already boolean);
    # every other column is kept as read
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schemas.SHOOTING_SCHEMA.fields
             if f.name in out.columns and f.name not in ("occur_date", flag)}
    return out.withColumns(typed)


def locate_with_income(incidents: DataFrame, areas, incomes: DataFrame,
                       cell_size: float | None = None,
                       area_names: DataFrame | None = None) -> DataFrame:
    """Place points in areas (strictly inside), attach income, drop -1 / NULL.

    ``areas``: an areas DataFrame or an :class:`~blotter.operators.spatial.AreaIndex`.
    ``area_names``: the areas' own (code, name) pairs, attached as
    ``neighborhood`` next to the lookup's name.
    """
    located = locate(incidents, areas, x="longitude", y="latitude", area_col="ntacode",
                     cell_size=cell_size)
    if area_names is not None:
        names = area_names.select("ntacode", F.col("ntaname").alias("neighborhood"))
        located = enrich_area(located, names, "ntacode")
    return enrich_area(located, incomes, "ntacode", value_col="income")


def read_neighbourhoods(spark: SparkSession, geojson_path: str, incomes_csv: str):
    """(areas, incomes, area names): the GeoJSON read once, its (code, name)
    dimension derived from the same features."""
    features = read_features(spark, geojson_path, ["ntacode", "ntaname"])
    areas = areas_from_features(features, ["ntacode"])
    names = area_dimension(features)
    incomes = read_csv_typed(spark, incomes_csv, schemas.INCOME_LOOKUP_SCHEMA)
    return areas, incomes, names


def read_area_names(spark: SparkSession, names_csv: str) -> DataFrame:
    """The (code, name) area dimension as written by the ``areas`` command."""
    return read_csv_typed(spark, names_csv, schemas.AREA_NAMES_SCHEMA)


def lookup_profile(incomes: DataFrame) -> dict[str, DataFrame]:
    """Checks on the hand-typed income lookup: NULLs, duplicate codes, and the
    income range with values beyond plausible fences."""
    return profile(incomes, key="ntacode", numeric={"income": INCOME_FENCES})


def shooting_report(integrated: DataFrame, located: DataFrame, split: date = SPLIT_DEFAULT,
                    drop_band: str = "High Income", cut: bool = True) -> dict[str, DataFrame]:
    """Trend and comparison tables: the total over all ``integrated`` incidents, the bands
    over the ``located`` ones.

    The located table is aggregated once to (band, month) counts; with ``cut``
    that small table is checkpointed to the shared checkpoint folder, so the
    outputs never re-run the spatial join.
    """
    banded = located.withColumn("band", band_of("income", INCOME_BANDS))
    counts = monthly_counts(banded, "occur_date", by=["band"])
    if cut:
        counts = cut_lineage(counts)
    total = monthly_counts(integrated, "occur_date")
    w = series_window("month", ["band"])
    bands = (counts.where(F.col("band").isNotNull())
             .select("band", "month", "cnt", strict_moving_avg("cnt", w).alias("ma12")))
    labels = [b.label for b in INCOME_BANDS]
    by_month = before_after_by_month(bands, split, labels=labels)
    # report tables are months × bands: ordering them is cheap
    return {
        "monthly_trend": add_trend_metrics(total).orderBy("month"),
        "band_trend": bands.orderBy("band", "month"),
        "before_after": before_after(bands, split, labels=labels).orderBy("band"),
        "before_after_by_month": by_month.orderBy("month_no", "band"),
        "change_matrix": change_matrix(bands, [x for x in labels if x != drop_band], split)
        .orderBy("month_no"),
    }
