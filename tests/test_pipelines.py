"""End-to-end pipelines over small hand-made files, and the sink modes (Q13)."""

import csv
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from blotter.plans.complaints import (
    complaint_report, complaint_union, curate_complaints, union_profile)
from blotter.plans.shootings import (
    integrate_shootings, locate_with_income, read_neighbourhoods, shooting_report)
from blotter.schemas import COMPLAINT_COLUMNS
from blotter.sources.files import read_csv_typed, write_table
from blotter.schemas import INCOME_LOOKUP_SCHEMA

from conftest import rows


def _write_csv(path, header, data):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(data)
    return str(path)


def _complaint(num, fr, to, level, ofns, race, extra="x"):
    row = {c: "" for c in COMPLAINT_COLUMNS}
    row.update(CMPLNT_NUM=num, CMPLNT_FR_DT=fr, CMPLNT_TO_DT=to, LAW_CAT_CD=level, OFNS_DESC=ofns,
               VIC_RACE=race, KY_CD="101", Latitude="40.7", Longitude="-73.9")
    return [row[c] for c in COMPLAINT_COLUMNS] + [extra]


def test_complaint_pipeline(spark, tmp_path):
    header = list(COMPLAINT_COLUMNS) + ["EXTRA_COL"]
    hist = _write_csv(tmp_path / "hist.csv", header, [
        _complaint("1", "01/05/2016", "", "FELONY", "ROBBERY", "ASIAN / PACIFIC ISLANDER"),
        _complaint("2", "", "02/03/2016", "MISDEMEANOR", "FELONY ASSAULT", "WHITE"),
        _complaint("3", "05/05/2014", "", "FELONY", "ROBBERY", "WHITE"),
        _complaint("4", "", "", "VIOLATION", "(null)", "UNKNOWN"),
    ])
    curr = _write_csv(tmp_path / "curr.csv", header, [
        _complaint("1", "01/06/2016", "", "MISDEMEANOR", "BURGLARY", "WHITE"),
        _complaint("5", "03/01/2016", "", "VIOLATION", "DANGEROUS DRUGS", ""),
    ])
    out = str(tmp_path / "curated")
    curated = curate_complaints(spark, hist, curr, out=out)
    assert rows(curated, "CMPLNT_NUM", "Crime_Date", "LAW_CAT_CD", "Crime_Year_Month") == [
        ("1", date(2016, 1, 5), "FELONY", "2016-1"),
        ("2", date(2016, 2, 3), "MISDEMEANOR", "2016-2"),
        ("5", date(2016, 3, 1), "VIOLATION", "2016-3"),
    ]
    assert {"latitude", "longitude"} <= set(curated.columns)
    report = complaint_report(curated)
    assert rows(report["monthly_trend"], "month", "cnt") == [
        (date(2016, 1, 1), 1), (date(2016, 2, 1), 1), (date(2016, 3, 1), 1)]
    assert rows(report["offence_group_trend"], "grp", "cnt") == [
        ("Assaults", 1), ("Drug Offense", 1), ("Robbery, Burglary, and Larceny", 1)]
    assert rows(report["victim_share"], "month", "part", "total") == [(date(2016, 1, 1), 1, 1)]
    assert report["level_trend"].count() == 9
    assert rows(report["offence_type_counts"], "OFNS_DESC", "cnt") == [
        ("DANGEROUS DRUGS", 1), ("FELONY ASSAULT", 1), ("ROBBERY", 1)]
    assert report["duplicate_keys"].count() == 0
    union = union_profile(complaint_union(spark, hist, curr))
    dates = union["union_date_range"].collect()[0]
    assert (dates["row_count"], dates["null_dates"]) == (6, 1)
    assert rows(union["union_duplicate_keys"]) == [("1", 2)]


def test_unknown_offence_type_is_kept(spark, tmp_path):
    header = list(COMPLAINT_COLUMNS)
    files = [_write_csv(tmp_path / f"{i}.csv", header, [
        _complaint(str(10 * i + k), "01/05/2016", "", "FELONY", ofns, "WHITE")[:-1]
        for k, ofns in enumerate(("ROBBERY", "UNKNOWN", "(null)", ""))]) for i in (1, 2)]
    curated = curate_complaints(spark, *files)
    report = complaint_report(curated)
    assert rows(report["offence_type_counts"], "OFNS_DESC", "cnt") == [("ROBBERY", 2), ("UNKNOWN", 2)]
    pairs = union_profile(complaint_union(spark, *files))["union_null_code_pairs"]
    assert rows(pairs) == [("101", None)]


def _shooting_files(tmp_path):
    hist = _write_csv(tmp_path / "sh_hist.csv",
                      ["INCIDENT_KEY", "OCCUR_DATE", "STATISTICAL_MURDER_FLAG", "X_COORD_CD",
                       "Y_COORD_CD", "Lon_Lat", "Longitude", "Latitude"], [
        ["1", "3/1/2019", "false", "1", "2", "p", "0.5", "0.5"],
        ["2", "5/1/2020", "true", "1", "2", "p", "2.5", "0.5"],
        ["3", "1/1/2014", "false", "1", "2", "p", "0.5", "0.5"],     # outside the bound
        ["4", "3/1/2021", "false", "1", "2", "p", "1.0", "0.5"],     # on the shared edge
    ])
    ytd = _write_csv(tmp_path / "sh_ytd.csv",
                     ["INCIDENT_KEY", "OCCUR_DATE", "STATISTICAL_MURDER_FLAG", "LOC_CLASSFCTN_DESC",
                      "X_COORD_CD", "Y_COORD_CD", "New Georeferenced Column", "LOC_OF_OCCUR_DESC",
                      "Longitude", "Latitude"], [
        ["2", "5/2/2020", "Y", "a", "1", "2", "g", "o", "2.5", "0.5"],
        ["5", "4/1/2022", "N", "a", "1", "2", "g", "o", "0.25", "0.75"],
        ["6", "4/1/2022", "Y", "a", "1", "2", "g", "o", "5.5", "0.5"],   # park area: income -1
    ])
    geo = tmp_path / "nta.geojson"
    feats = []
    for code, x0 in (("AA01", 0), ("BB02", 1), ("PK99", 5)):
        feats.append({"type": "Feature", "properties": {"ntacode": code, "ntaname": code},
                      "geometry": {"type": "MultiPolygon", "coordinates": [[[[x0, 0], [x0 + 1, 0],
                                   [x0 + 1, 1], [x0, 1], [x0, 0]]]]}})
    feats.append({"type": "Feature", "properties": {"ntacode": "CC03", "ntaname": "CC03"},
                  "geometry": {"type": "Polygon", "coordinates": [[[2, 0], [3, 0], [3, 1], [2, 1], [2, 0]]]}})
    geo.write_text(json.dumps({"type": "FeatureCollection", "features": feats}))
    inc = _write_csv(tmp_path / "inc.csv", ["ntacode", "ntaname", "income"],
                     [["AA01", "AA01", "30000"], ["BB02", "BB02", "80000"], ["CC03", "CC03", "130000"],
                      ["PK99", "PK99", "-1"]])

    return str(tmp_path / "sh_hist.csv"), ytd, str(geo), inc


def test_shooting_pipeline(spark, tmp_path):
    _, ytd, geo, inc = _shooting_files(tmp_path)
    sh = integrate_shootings(spark, str(tmp_path / "sh_hist.csv"), ytd)
    got = rows(sh, "incident_key", "occur_date", "statistical_murder_flag", "source")
    assert got == [("1", date(2019, 3, 1), False, "historic"), ("2", date(2020, 5, 2), True, "ytd"),
                   ("4", date(2021, 3, 1), False, "historic"), ("5", date(2022, 4, 1), False, "ytd"),
                   ("6", date(2022, 4, 1), True, "ytd")]
    assert "x_coord_cd" not in sh.columns and "lon_lat" not in sh.columns

    areas, incomes, names = read_neighbourhoods(spark, geo, inc)
    from blotter.plans.shootings import lookup_profile
    lp = lookup_profile(incomes)
    assert lp["duplicate_keys"].count() == 0
    assert lp["numeric_range"].collect()[0]["max"] == 130000.0
    located = locate_with_income(sh, areas, incomes, area_names=names)
    assert rows(located, "incident_key", "ntacode", "neighborhood", "income") == [
        ("1", "AA01", "AA01", 30000), ("2", "CC03", "CC03", 130000), ("5", "AA01", "AA01", 30000)]
    rep = shooting_report(sh, located, split=date(2020, 4, 1))
    # the total counts unlocated points and points of areas without income too
    assert sum(r["cnt"] for r in rep["monthly_trend"].collect()) == sh.count() == 5
    assert rows(rep["band_trend"], "band", "month", "cnt") == [
        ("High Income", date(2020, 5, 1), 1), ("Low Income", date(2019, 3, 1), 1),
        ("Low Income", date(2022, 4, 1), 1)]
    ba = {r["band"]: (r["before_avg"], r["after_avg"]) for r in rep["before_after"].collect()}
    assert ba == {"Low Income": (1.0, 1.0), "Mid Income": (None, None),
                  "Mid-High Income": (None, None), "High Income": (None, 1.0)}
    assert rep["change_matrix"].columns == ["month_no", "month_name", "Low Income", "Mid Income",
                                            "Mid-High Income"]
    assert rep["change_matrix"].count() == 12


def test_sink_modes(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    p = str(tmp_path / "t")
    write_table(df, p, "errorifexists")
    with pytest.raises(Exception):
        write_table(df, p, "errorifexists")
    write_table(df.limit(1), p, "ignore")                 # present: left as is
    assert spark.read.parquet(p).count() == 2
    write_table(df.limit(1), p, "overwrite")
    assert spark.read.parquet(p).count() == 1
    c = str(tmp_path / "c")
    write_table(df, c, "overwrite", fmt="csv", partition_by=["v"])
    back = spark.read.option("header", True).csv(c)
    assert sorted(r["id"] for r in back.collect()) == ["1", "2"]


def test_csv_folder_with_differing_headers(spark, tmp_path):
    from blotter.sources.files import read_csv_text
    folder = tmp_path / "in"
    folder.mkdir()
    _write_csv(folder / "a.csv", ["id", "lvl", "d"], [["1", "F", "1/1/2020"]])
    _write_csv(folder / "b.csv", ["id", "d", "lvl"], [["2", "1/2/2020", "M"]])
    _write_csv(folder / "c.csv", ["d", "id"], [["1/3/2020", "3"]])
    got = rows(read_csv_text(spark, str(folder)), "id", "lvl", "d")
    assert got == [("1", "F", "1/1/2020"), ("2", "M", "1/2/2020"), ("3", None, "1/3/2020")]
    assert rows(read_csv_text(spark, [str(folder)], columns=["lvl", "x"])) == sorted(
        [("F", None), ("M", None), (None, None)], key=str)


def test_overlapping_areas_do_not_change_the_total(spark):
    sh = spark.createDataFrame([("1", date(2020, 1, 5)), ("2", date(2020, 1, 6)), ("3", date(2020, 2, 1))],
                               "incident_key string, occur_date date")
    twice = sh.where("incident_key = '1'").withColumn("income", F.lit(30000))
    rep = shooting_report(sh, twice.unionAll(twice), split=date(2020, 2, 1))
    assert rows(rep["monthly_trend"], "month", "cnt") == [(date(2020, 1, 1), 2), (date(2020, 2, 1), 1)]
    assert rows(rep["band_trend"], "band", "cnt") == [("Low Income", 2)]


def test_lookup_reader_types(spark, tmp_path):
    p = _write_csv(tmp_path / "inc.csv", ["ntaname", "ntacode", "income"],
                   [["A", "X1", "10"], ["B", "X2", "oops"]])
    df = read_csv_typed(spark, p, INCOME_LOOKUP_SCHEMA)
    assert df.columns == ["ntacode", "ntaname", "income"]
    assert rows(df) == [("X1", "A", 10), ("X2", "B", None)]


def test_cli_areas_written_only_if_absent(spark, tmp_path):
    from blotter.__main__ import main
    geo = tmp_path / "a.geojson"
    geo.write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"ntacode": "A1", "ntaname": "Name, with comma"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
        {"type": "Feature", "properties": {"ntacode": "A1", "ntaname": "Name, with comma"},
         "geometry": {"type": "Polygon", "coordinates": [[[2, 0], [3, 0], [3, 1], [2, 0]]]}}]}))
    out = str(tmp_path / "names")
    main(["areas", str(geo), out])
    from blotter.plans.shootings import read_area_names
    back = read_area_names(spark, out)
    assert back.columns == ["ntacode", "ntaname"]
    assert rows(back) == [("A1", "Name, with comma")]
    geo.write_text(json.dumps({"type": "FeatureCollection", "features": []}))
    main(["areas", str(geo), out])                          # present: left as is
    assert spark.read.option("header", True).csv(out).count() == 1


def test_cli_shootings_and_complaints(spark, tmp_path):
    from blotter.__main__ import main
    hist, ytd, geo, inc = _shooting_files(tmp_path)
    out = str(tmp_path / "out")
    main(["shootings", hist, ytd, geo, inc, out])
    assert spark.read.parquet(f"{out}/located").count() == 3
    assert spark.read.parquet(f"{out}/change_matrix").count() == 12
    assert spark.read.parquet(f"{out}/lookup_numeric_range").count() == 1
    header = list(COMPLAINT_COLUMNS)
    h = _write_csv(tmp_path / "h.csv", header, [_complaint("1", "01/05/2016", "", "FELONY", "ROBBERY", "WHITE")[:-1]])
    c = _write_csv(tmp_path / "c.csv", header, [_complaint("2", "02/05/2016", "", "FELONY", "ROBBERY", "WHITE")[:-1]])
    out2 = str(tmp_path / "out2")
    main(["complaints", h, c, out2, "--format", "csv", "--mode", "errorifexists"])
    assert spark.read.parquet(f"{out2}/curated").count() == 2
    trend = spark.read.option("header", True).csv(f"{out2}/monthly_trend")
    assert trend.count() == 2 and "ma12" in trend.columns
    with pytest.raises(Exception):
        main(["complaints", h, c, out2, "--format", "csv", "--mode", "errorifexists"])


def test_enrich_area_same_rows_beyond_broadcast_bound(spark):
    from blotter.operators.enrich import enrich_area
    pts = spark.createDataFrame([(i, f"A{i % 5}") for i in range(200)] + [(999, None)],
                                "pid int, ntacode string")
    lookup = spark.createDataFrame([("A0", 10), ("A1", -1), ("A2", None), ("A3", 50000)],
                                   "ntacode string, income int")
    a = enrich_area(pts, lookup, "ntacode", value_col="income")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = enrich_area(pts, lookup, "ntacode", value_col="income")
        assert "BroadcastHashJoin" not in b._jdf.queryExecution().executedPlan().toString()
        assert rows(a) == rows(b)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert a.count() == 80 and {r["ntacode"] for r in a.collect()} == {"A0", "A3"}


def test_failing_write_leaves_the_old_table(spark, tmp_path):
    from blotter.sources.files import TableExists
    p = str(tmp_path / "t")
    write_table(spark.range(5).select("id", (F.col("id") % 2).alias("year")), p, partition_by=["year"])
    bad = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(
        F.raise_error(F.lit("stop")).cast("long")).alias("id"), F.lit(3).alias("year"))
    with pytest.raises(Exception, match="stop"):
        write_table(bad, p, partition_by=["year"])
    assert sorted(r.id for r in spark.read.parquet(p).collect()) == list(range(5))
    with pytest.raises(TableExists):
        write_table(bad, p, "errorifexists")
    with pytest.raises(ValueError):
        write_table(bad, p, "replace")
    write_table(bad, p, "ignore")
    write_table(spark.read.parquet(p).where("id > 1"), p)          # reads what it replaces
    assert sorted(r.id for r in spark.read.parquet(p).collect()) == [2, 3, 4]
    write_table(spark.range(1).select("id", F.lit(1).alias("year")), p, "append")
    assert spark.read.parquet(p).count() == 4
    assert sorted(f.name for f in tmp_path.iterdir()) == ["t"]     # nothing is left beside it


def test_few_files_a_year(spark, tmp_path):
    """32 tasks that all hold every year write a file or two a year, not 32."""
    df = spark.range(8000, numPartitions=32).select("id", (2015 + F.col("id") % 4).alias("year"))
    write_table(df, str(tmp_path / "y"), partition_by=["year"])
    years = [len(list(d.glob("*.parquet"))) for d in (tmp_path / "y").glob("year=*")]
    assert len(years) == 4 and max(years) <= 2


def test_headers_of_many_files_in_few_jobs(spark, tmp_path):
    from blotter.sources.files import read_csv_text
    d = tmp_path / "many files"
    d.mkdir()
    heads = [["a", "b"], ["b", "c"], ["c", "a", "d e"]]
    for i in range(300):
        head = heads[i % 3]
        (d / f"part {i}.csv").write_text(("\n" if i % 7 == 0 else "") + ",".join(head) + "\n" + ",".join(
            f"{c}{i}" for c in head) + "\n" + ("last" if i == 5 else ""))
    (d / "empty.csv").write_text("")
    sc = spark.sparkContext
    sc.setJobGroup("headers", "reading")
    df = read_csv_text(spark, str(d))
    jobs = len(sc.statusTracker().getJobIdsForGroup("headers"))
    sc._jsc.clearJobGroup()
    assert jobs <= 12 and set(df.columns) == {"a", "b", "c", "d e"}
    got = {tuple(r) for r in df.select("a", "b", "c", "`d e`").collect()}
    want = {tuple(f"{c}{i}" if c in heads[i % 3] else None for c in ("a", "b", "c", "d e")) for i in range(300)}
    assert got - want <= {(None, None, "last", None)} and want <= got
    same = read_csv_text(spark, str(d / "part 1.csv"), same_header=True)
    assert same.columns == ["b", "c"] and same.count() == 1
    with pytest.raises(Exception):
        read_csv_text(spark, [str(d / "part 1.csv"), str(d / "part 3.csv")], same_header=True).collect()


def test_one_large_collection_in_several_tasks(spark, tmp_path):
    from blotter.sources.geojson import FEATURE_START, read_areas, read_features
    features = [{"type": "Feature", "properties": {"ntacode": f"N{i}", "ntaname": 'say "{\\"type\\":\\"Feature\\"}" \n'},
                 "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [i + 1, 0], [i + 1, 1], [i, 0]]]}}
                for i in range(4000)]
    doc = {"type": "FeatureCollection", "crs": {"type": "name"}, "features": features, "bbox": [0, 0, 1, 1]}
    p = tmp_path / "large.geojson"
    p.write_text(json.dumps(doc, separators=(",", ":")))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        many = read_areas(spark, str(p), ["ntacode", "ntaname"], separator=FEATURE_START)
        assert many.rdd.getNumPartitions() > 3
        one = read_areas(spark, str(p), ["ntacode", "ntaname"])
        assert sorted(map(str, many.collect())) == sorted(map(str, one.collect())) and many.count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spaced = tmp_path / "spaced.geojson"
    spaced.write_text(json.dumps(doc, indent=1))
    with pytest.raises(Exception, match="no FeatureCollection"):
        read_features(spark, str(spaced), ["ntacode"], separator=FEATURE_START).collect()
    assert read_features(spark, str(spaced), ["ntacode"], separator='{\n   "type": "Feature"').count() == 4000
    none = tmp_path / "none.geojson"
    none.write_text('{"type":"FeatureCollection","features":[]}')
    assert read_features(spark, str(none), ["ntacode"], separator=FEATURE_START).count() == 0
