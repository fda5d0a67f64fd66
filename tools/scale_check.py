"""Scaling check: locate and hot-key dedup over sf0.1 lineitem replicated x1/x4/x16.

Rows are replicated inside Spark (explode), nothing is written.  Prints rows/s.
"""
import os
import sys
import time
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import functions as F
from blotter.session import local_session
from blotter.plans import geo
from blotter.operators.spatial import locate
from blotter.operators.integrate import dedup_first
spark = local_session(8, 32, driver_memory="16g")
sf = os.environ.get('BENCH_SF_DIR', '/root/testdata/sf0.1')
idx = geo.area_index(spark, sf)
base = geo.line_points(spark, sf)
li = spark.read.parquet(f"{sf}/lineitem.parquet")
def timed(df, runs=2):
    best = float("inf")
    for _ in range(runs):
        t = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - t)
    return best
timed(locate(base, idx, x="x", y="y"))
for k in (1, 4, 16):
    pts = base.withColumn("_rep", F.explode(F.sequence(F.lit(1), F.lit(k)))) \
              .withColumn("x", F.col("x") + F.col("_rep") * 0.0)
    n = 600_000 * k  # ~rows
    tl = timed(locate(pts, idx, x="x", y="y"))
    d = li.withColumn("_rep", F.explode(F.sequence(F.lit(1), F.lit(k)))).select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("l_orderkey") * 100 + F.col("_rep")).alias("k"),
        F.col("l_shipdate").cast("date").alias("ship"), "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    td = timed(dedup_first(d, "k", ["ship"]))
    print(f"x{k}: ~{n/1e6:.1f}M rows  locate {tl:.2f}s ({n/tl/1e6:.2f}M pts/s)  hot-key dedup {td:.2f}s ({n/td/1e6:.2f}M rows/s)")
