"""Command line: run a pipeline over files and write its tables.

    python -m blotter complaints HISTORIC.csv CURRENT.csv OUT_DIR
    python -m blotter shootings HISTORIC.csv YTD.csv AREAS.geojson INCOMES.csv OUT_DIR
    python -m blotter areas AREAS.geojson OUT_CSV_DIR

Each report table is written under OUT_DIR/<name>, as parquet or (with
``--format csv``) headered CSV; ``--mode errorifexists`` refuses to replace a
table.  The area dimension is written as CSV only if absent.  The session comes from
``spark-submit`` (or a local one when run directly).
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from blotter.plans.complaints import (
    complaint_report, complaint_union, curate_complaints, union_profile)
from blotter.plans.shootings import (
    integrate_shootings, locate_with_income, lookup_profile, read_neighbourhoods, shooting_report)
from blotter.sources.files import write_table
from blotter.sources.geojson import area_dimension, read_features


# Runtime settings applied only where the deployment left them unset: AQE
# sizes shuffle partitions from the data (start high, coalesce to ~256 MB),
# splits skewed join partitions, and scans read 256 MB splits.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def _write_all(tables: dict, out: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    for name, df in tables.items():
        write_table(df, os.path.join(out, name), mode, fmt)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="blotter")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("complaints")
    c.add_argument("historic"), c.add_argument("current"), c.add_argument("out")
    s = sub.add_parser("shootings")
    for a in ("historic", "ytd", "areas", "incomes", "out"):
        s.add_argument(a)
    s.add_argument("--cell-size", type=float, default=None)
    a = sub.add_parser("areas")
    a.add_argument("geojson"), a.add_argument("out")
    for sp in (c, s):
        sp.add_argument("--format", choices=["parquet", "csv"], default="parquet",
                        help="format of the report tables (CSV with a header)")
        sp.add_argument("--mode", choices=["overwrite", "errorifexists", "ignore"],
                        default="overwrite", help="what to do when a table exists")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"blotter-{args.cmd}").getOrCreate()
    for key, value in CLUSTER_DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    if args.cmd == "complaints":
        curated = curate_complaints(spark, args.historic, args.current,
                                    out=os.path.join(args.out, "curated"))
        union = complaint_union(spark, args.historic, args.current)
        _write_all(union_profile(union) | complaint_report(curated), args.out, args.format, args.mode)
    elif args.cmd == "shootings":
        where = os.path.join(args.out, "integrated")
        write_table(integrate_shootings(spark, args.historic, args.ytd), where, "overwrite")
        incidents = spark.read.parquet(where)
        areas, incomes, names = read_neighbourhoods(spark, args.areas, args.incomes)
        _write_all({f"lookup_{k}": v for k, v in lookup_profile(incomes).items()}, args.out,
                   args.format, args.mode)
        located = locate_with_income(incidents, areas, incomes, cell_size=args.cell_size,
                                     area_names=names)
        write_table(located, os.path.join(args.out, "located"), "overwrite")
        located = spark.read.parquet(os.path.join(args.out, "located"))
        _write_all(shooting_report(incidents, located), args.out, args.format, args.mode)
    else:
        dims = area_dimension(read_features(spark, args.geojson, ["ntacode", "ntaname"]))
        write_table(dims, args.out, "ignore", fmt="csv")


if __name__ == "__main__":
    main()
