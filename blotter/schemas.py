"""Canonical schemas and the reference's fixed domain values.

Column names are those of the public incident files the analysis reads.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import types as T

S, D, B = T.StringType(), T.DoubleType(), T.BooleanType()

# The complaint projection kept from both complaint files.
COMPLAINT_COLUMNS = (
    "CMPLNT_NUM", "CMPLNT_FR_DT", "CMPLNT_TO_DT", "ADDR_PCT_CD", "KY_CD", "OFNS_DESC",
    "LAW_CAT_CD", "BORO_NM", "SUSP_AGE_GROUP", "SUSP_RACE", "SUSP_SEX", "VIC_AGE_GROUP",
    "VIC_RACE", "VIC_SEX", "Latitude", "Longitude",
)

# Complaints keep every column as text except the coordinates.
COMPLAINT_SCHEMA = T.StructType(
    [T.StructField(c, D if c in ("Latitude", "Longitude") else S) for c in COMPLAINT_COLUMNS])

# Shooting columns dropped from each file before the union.
SHOOTING_HISTORIC_DROP = ("x_coord_cd", "y_coord_cd", "lon_lat")
SHOOTING_YTD_DROP = ("loc_classfctn_desc", "x_coord_cd", "y_coord_cd",
                     "new georeferenced column", "loc_of_occur_desc")

# Shooting columns the analysis names, with their canonical types (the date
# is parsed and the flag turned boolean by the integration rules).
SHOOTING_SCHEMA = T.StructType([
    T.StructField("incident_key", S),
    T.StructField("occur_date", T.DateType()),
    T.StructField("statistical_murder_flag", B),
    T.StructField("longitude", D),
    T.StructField("latitude", D),
])

INCOME_LOOKUP_SCHEMA = T.StructType([
    T.StructField("ntacode", S), T.StructField("ntaname", S), T.StructField("income", T.IntegerType())])
AREA_NAMES_SCHEMA = T.StructType([T.StructField("ntacode", S), T.StructField("ntaname", S)])

# Date rules of the reference analysis.
COMPLAINT_MIN_DATE = date(2015, 1, 1)
SHOOTING_HISTORIC_BOUND = (date(2015, 1, 1), date(2021, 12, 31))

# Offence types rolled into the five groups that are charted.
OFFENCE_GROUPS = {
    "Homicide": ["MURDER & NON-NEGL. MANSLAUGHTER"],
    "Assaults": ["ASSAULT 3 & RELATED OFFENSES", "FELONY ASSAULT"],
    "Robbery, Burglary, and Larceny": ["ROBBERY", "BURGLARY", "PETIT LARCENY", "GRAND LARCENY"],
    "Motor Vehicle Theft": ["PETIT LARCENY OF MOTOR VEHICLE", "GRAND LARCENY OF MOTOR VEHICLE"],
    "Drug Offense": ["DANGEROUS DRUGS", "UNDER THE INFLUENCE OF DRUGS", "CANNABIS RELATED OFFENSES"],
}

# Fixed value: the victim group whose share is followed.
SHARE_GROUP = "ASIAN / PACIFIC ISLANDER"
