"""The year-to-date feed over a driver table (Structured Streaming, then a batch count).

``orders`` is read as a file stream and appended to a table in the shared folder;
the monthly count is taken from that table.  Keys in ``orders`` are unique, so the
counts equal the batch monthly counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blotter.plans.catalog import register, table
from blotter.session import scratch_path
from blotter.streaming.feed import ingest_feed, landed_monthly_counts, read_feed

TIME_LIMIT_S = 3600


@register("feed_monthly_counts", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS cnt
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1
""")
def q_feed_monthly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 over a stream: every order file appended as it lands, counted per month."""
    # a file source streams a folder or a glob; the glob names the one table file
    feed = read_feed(spark, f"{sf_dir}/orders.parque[t]", ["o_orderkey", "o_orderdate"], fmt="parquet",
                     schema=table(spark, sf_dir, "orders").schema, base_path=sf_dir)
    home = scratch_path(spark, "feed")
    query = ingest_feed(feed, f"{home}/table", home.rsplit("/", 1)[1], f"{home}/state", available_now=True)
    if not query.awaitTermination(TIME_LIMIT_S):
        query.stop()
        raise TimeoutError(f"the feed did not end within {TIME_LIMIT_S} s")
    return landed_monthly_counts(spark.read.parquet(f"{home}/table"), "o_orderkey", "o_orderdate")
