"""Registered queries: the jobs run over a lake of the given events, and what they leave there."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillmark.catalog.layers import GOOD, SENT
from rillmark.catalog.registry import AS_OF, query
from rillmark.catalog.streams import _message_lake
from rillmark.catalog.tables import SILVER, silver
from rillmark.plans import jobs
from rillmark.session import scratch_path
from rillmark.sinks.compaction import compact_files
from rillmark.sources.tables import read_table
from rillmark.streaming.queries import DRAIN

GROUPS = """hours AS (SELECT event_date, hour("timestamp") AS h, event_type, device_type, count(*) AS n FROM good GROUP BY ALL)"""


def _lake(spark, d):
    """Messages taken in by the bronze job."""
    lake, config = _message_lake(spark, d)
    for running in jobs.bronze_job(spark, lake, config, topics=("clickstream",), trigger=DRAIN):
        running.awaitTermination()
    return lake


@query(
    """SELECT 'bronze_clickstream' AS table_name, count(*) AS n, 0 AS failed FROM sent
    UNION ALL SELECT 'silver_clickstream', count(*), 0 FROM good
    UNION ALL SELECT 'silver_rejected', count(*), 0 FROM sent WHERE number % 97 = 0
    UNION ALL SELECT 'gold_hourly', count(*), 0 FROM hours
    UNION ALL SELECT 'gold_events', CAST(sum(n) AS BIGINT), 0 FROM hours
    UNION ALL SELECT 'pipeline_runs', 2, 0 UNION ALL SELECT 'alerts', 4, 0""",
    (SILVER, GOOD, SENT, GROUPS),
)
def lake_refresh(spark, d):
    """Bronze, silver, gate, gold, metrics and alerts, run twice for one time: the second run leaves the tables as they were."""
    lake = _lake(spark, d)
    failed = sum(jobs.run_all(spark, lake, AS_OF) != "success" for _ in range(2))
    names = ("bronze_clickstream", "silver_clickstream", "silver_rejected", "gold_hourly", "pipeline_runs", "alerts")
    counts = [read_table(spark, lake, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("n")) for name in names]
    counts.append(read_table(spark, lake, "gold_hourly").agg(F.lit("gold_events").alias("table_name"), F.sum("event_count").alias("n")))
    out = counts[0]
    for frame in counts[1:]:
        out = out.union(frame)
    return out.withColumn("failed", F.lit(failed))


@query(
    """SELECT event_date, CAST(h AS INTEGER) AS event_hour, event_type, device_type, n AS event_count FROM hours
    WHERE event_date < (SELECT min(event_date) + 10 FROM good) OR event_date >= (SELECT min(event_date) + 20 FROM good)""",
    (SILVER, GOOD, GROUPS),
)
def gold_of_some_days(spark, d):
    """Gold written for the first ten days and for those from the twentieth on, by two runs of the job."""
    from datetime import timedelta

    lake = _lake(spark, d)
    jobs.silver_job(spark, lake)
    run = jobs.quality_job(spark, lake, AS_OF)
    days = sorted(jobs.event_dates(read_table(spark, lake, "silver_clickstream")))
    for part in ([x for x in days if x < days[0] + timedelta(days=10)], [x for x in days if x >= days[0] + timedelta(days=20)]):
        jobs.gold_job(spark, lake, run.run_id, part)
    return read_table(spark, lake, "gold_hourly").select("event_date", "event_hour", "event_type", "device_type", "event_count")


@query("SELECT event_date, count(*) AS n, CAST(1 AS BIGINT) AS files, CAST(sum(CAST(event_id AS BIGINT)) AS BIGINT) AS ids FROM silver GROUP BY 1", (SILVER,))
def packed_small_files(spark, d):
    """Events written in four loads, then the small files of every day packed, and once more for nothing."""
    path = scratch_path(spark, "small-files")
    events = silver(spark, d).select("event_id", "event_type", "price", "event_date")
    for load in range(4):
        events.where(F.pmod(F.col("event_id").cast("bigint"), F.lit(4)) == load).repartition(2).write.mode("append").partitionBy("event_date").parquet(path)
    if not compact_files(spark, path) or compact_files(spark, path):
        raise RuntimeError("a second run must find nothing to pack")
    rows = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    return rows.groupBy("event_date").agg(F.count("*").alias("n"), F.countDistinct("file").alias("files"), F.sum(F.col("event_id").cast("bigint")).alias("ids"))
