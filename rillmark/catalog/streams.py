"""Registered queries: streaming operators run over the event files until they are drained."""

from __future__ import annotations

import os
from datetime import timedelta

from pyspark.sql import functions as F

from rillmark.catalog.registry import query
from rillmark.catalog.tables import SILVER, given, messages, silver_of
from rillmark.operators.layers import dedupe, split_late, with_lineage
from rillmark.session import scratch_path
from rillmark.sources.streams import StreamConfig, read_events_stream, read_files_stream
from rillmark.sources.tables import Lake, read_table
from rillmark.streaming.gold import hourly_of, start_gold_cells
from rillmark.streaming.progress import ProgressRecorder, backlog, progress_metrics
from rillmark.streaming.sessions import rocks_state, sessions_until
from rillmark.streaming.queries import (
    DRAIN, carts_with_checkouts, hourly_stream, session_counts, sliding_counts, start_bronze, start_router, start_silver, start_table,
)


def _events_stream(spark, d):
    """The events file as a stream; event time as a timestamp, which watermarks need."""
    rows = read_files_stream(spark, d, given(spark, d, "events").schema, glob="events.parquet")
    return silver_of(rows).withColumn("event_ts", F.col("timestamp").cast("timestamp"))


def _drain(df, spark, label, by=None):
    """Run a streaming frame over everything there is and read the written table."""
    root = scratch_path(spark, label)
    start_table(df, os.path.join(root, "out"), os.path.join(root, "ckpt"), os.path.basename(root), by, DRAIN).awaitTermination()
    return spark.read.parquet(os.path.join(root, "out"))


MARK = "mark AS (SELECT max(\"timestamp\") - INTERVAL 1 HOUR AS w FROM silver)"


@query(
    """SELECT event_date, CAST(hour("timestamp") AS INTEGER) AS event_hour, event_type, device_type, count(*) AS event_count, count(user_id) AS user_events,
      CAST(sum(CAST(round(price * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_value
    FROM silver, mark GROUP BY 1, 2, 3, 4, mark.w HAVING max(date_trunc('hour', "timestamp")) + INTERVAL 1 HOUR <= mark.w""",
    (SILVER, MARK),
)
def stream_hourly(spark, d):
    """Hours that the watermark has closed."""
    out = _drain(hourly_stream(_events_stream(spark, d)), spark, "hourly")
    return out.select("event_date", "event_hour", "event_type", "device_type", "event_count", "user_events", "total_value")


@query(
    """SELECT window_start, event_type, count(*) AS events FROM
      (SELECT event_type, date_trunc('hour', "timestamp") - i * INTERVAL 1 HOUR AS window_start FROM silver, (SELECT unnest([0, 1]) AS i) s) x, mark
    GROUP BY 1, 2, mark.w HAVING window_start + INTERVAL 2 HOUR <= mark.w""",
    (SILVER, MARK),
)
def stream_sliding(spark, d):
    """Two-hour windows every hour."""
    out = _drain(sliding_counts(_events_stream(spark, d), size="2 hours", slide="1 hour"), spark, "sliding")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events")


@query(
    """SELECT user_id, min("timestamp") AS session_start, max("timestamp") AS last_event_ts, count(*) AS events FROM
      (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY "timestamp", event_id) AS n FROM
        (SELECT *, CASE WHEN prev IS NULL OR "timestamp" > prev + INTERVAL 12 HOUR THEN 1 ELSE 0 END AS opens FROM
          (SELECT *, lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp", event_id) AS prev FROM silver) p) o) s, mark
    GROUP BY user_id, n, mark.w HAVING max("timestamp") + INTERVAL 12 HOUR <= mark.w""",
    (SILVER, MARK),
)
def stream_sessions(spark, d):
    """Sessions that the watermark has closed."""
    out = _drain(session_counts(_events_stream(spark, d), "12 hours"), spark, "sessions")
    return out.select(
        "user_id",
        F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("last_event_ts").cast("timestamp_ntz").alias("last_event_ts"),
        "events",
    )


@query(
    """SELECT user_id, min("timestamp") AS session_start, max("timestamp") AS last_event_ts, count(*) AS events,
      CASE WHEN arg_max(event_type, ("timestamp", event_id)) = 'checkout_completed' THEN 'event' ELSE 'pause' END AS ended_by FROM
      (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY "timestamp", event_id) AS n FROM
        (SELECT *, CASE WHEN prev IS NULL OR "timestamp" > prev + INTERVAL 12 HOUR OR prev_type = 'checkout_completed' THEN 1 ELSE 0 END AS opens FROM
          (SELECT *, lag("timestamp") OVER w AS prev, lag(event_type) OVER w AS prev_type FROM silver WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", event_id)) p) o) s, mark
    GROUP BY user_id, n, mark.w
    HAVING max("timestamp") + INTERVAL 12 HOUR <= mark.w OR (max("timestamp") <= mark.w AND arg_max(event_type, ("timestamp", event_id)) = 'checkout_completed')""",
    (SILVER, MARK),
)
def stream_sessions_to_purchase(spark, d):
    """Sessions that end at a purchase or after a pause, as far as the watermark has closed them."""
    with rocks_state(spark):
        out = _drain(sessions_until(_events_stream(spark, d), timedelta(hours=12), "checkout_completed"), spark, "sessions-until")
    moment = {c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "last_event_ts")}
    return out.withColumns(moment)


@query(
    """SELECT a.session_id, a.event_id AS add_id, a."timestamp" AS added_at, a.product_id, CAST(round(a.price * 100) AS BIGINT) AS price_cents,
      c.event_id AS checkout_id, c."timestamp" AS completed_at
    FROM silver a CROSS JOIN (SELECT least(max("timestamp") FILTER (WHERE event_type = 'add_to_cart'), max("timestamp") FILTER (WHERE event_type = 'checkout_completed'))
        - INTERVAL 1 HOUR AS w FROM silver) m
      LEFT JOIN silver c ON c.event_type = 'checkout_completed' AND c.session_id = a.session_id AND c."timestamp" BETWEEN a."timestamp" AND a."timestamp" + INTERVAL 2 HOUR
    WHERE a.event_type = 'add_to_cart' AND (c.event_id IS NOT NULL OR a."timestamp" + INTERVAL 2 HOUR < w)""",
    (SILVER,),
)
def stream_carts_with_checkouts(spark, d):
    """Two streams of the events: cart adds with their checkouts, and abandoned ones as far as the watermark tells."""
    out = _drain(carts_with_checkouts(_events_stream(spark, d), _events_stream(spark, d)), spark, "carts")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("added_at", "completed_at")})


@query("SELECT event_id, event_type FROM silver", (SILVER,))
def stream_deduplicated(spark, d):
    """Every event sent twice, kept once."""
    rows = _events_stream(spark, d).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy", "timestamp")
    return _drain(dedupe(rows, ["session_id", "event_id"], watermark="1 hour"), spark, "dedupe").select("event_id", "event_type")


@query("SELECT event_id FROM silver WHERE k > 60", (SILVER,))
def stream_late_rows(spark, d):
    rows = _events_stream(spark, d).withColumn("arrived", F.col("event_ts") + F.make_dt_interval(mins=F.col("k")))
    _, late = split_late(rows.drop("timestamp"), "event_ts", "arrived", timedelta(hours=1))
    return _drain(late, spark, "late").select("event_id")


@query("SELECT CASE WHEN event_type = 'checkout_completed' THEN 'orders' ELSE 'clicks' END AS route, count(*) AS n FROM silver GROUP BY 1", (SILVER,))
def stream_routed(spark, d):
    """One stream sent to two tables."""
    root = scratch_path(spark, "routes")
    bought = F.col("event_type") == "checkout_completed"
    routes = {"orders": (bought, f"{root}/orders"), "clicks": (~bought, f"{root}/clicks")}
    start_router(_events_stream(spark, d), routes, f"{root}/ckpt", DRAIN).awaitTermination()
    counts = [
        spark.read.parquet(path).agg(F.lit(name).alias("route"), F.count("*").alias("n")) for name, (_, path) in routes.items()
    ]
    return counts[0].union(counts[1])


def _message_lake(spark, d) -> tuple[Lake, StreamConfig]:
    """Messages as files of the envelope, ready to be streamed."""
    root = scratch_path(spark, "lake")
    # without a number adaptive execution sizes the files: as many as there are cores, and more of them when they get large
    messages(spark, d).repartition("offset").write.parquet(f"{root}/in/clickstream")
    return Lake(root), StreamConfig(kind="files", directory=f"{root}/in")


@query(
    """SELECT CAST(k % 4 AS INTEGER) AS kafka_partition, count(*) AS n, CAST(sum(number) AS BIGINT) AS offsets FROM
      (SELECT k, CAST(event_id AS BIGINT) AS number FROM silver UNION ALL
       SELECT k, CAST(event_id AS BIGINT) FROM silver WHERE CAST(event_id AS BIGINT) % 50 = 0) s GROUP BY 1""",
    (SILVER,),
)
def stream_bronze(spark, d):
    """Ingestion stopped and started again: the checkpoint lets nothing in twice."""
    lake, config = _message_lake(spark, d)
    for _ in range(2):
        start_bronze(read_events_stream(spark, config, "clickstream"), lake, "clickstream", DRAIN).awaitTermination()
    rows = read_table(spark, lake, "bronze_clickstream")
    return rows.groupBy("kafka_partition").agg(F.count("*").alias("n"), F.sum("kafka_offset").alias("offsets"))


@query(
    """SELECT event_date, event_type, count(*) AS n FROM silver WHERE CAST(event_id AS BIGINT) % 97 <> 0 GROUP BY 1, 2
    UNION ALL SELECT NULL, 'rejected', count(*) FROM (SELECT event_id FROM silver UNION ALL
      SELECT event_id FROM silver WHERE CAST(event_id AS BIGINT) % 50 = 0) s WHERE CAST(event_id AS BIGINT) % 97 = 0""",
    (SILVER,),
)
def stream_silver(spark, d):
    """Raw stream to events and rejected rows, both drained."""
    lake, config = _message_lake(spark, d)
    start_bronze(read_events_stream(spark, config, "clickstream"), lake, "clickstream", DRAIN).awaitTermination()
    schema = read_table(spark, lake, "bronze_clickstream").schema
    raw = read_files_stream(spark, lake.path("bronze_clickstream"), schema)
    for running in start_silver(raw, lake, "40 days", DRAIN):
        running.awaitTermination()
    events = read_table(spark, lake, "silver_clickstream").groupBy("event_date", "event_type").agg(F.count("*").alias("n"))
    bad = read_table(spark, lake, "silver_stream_rejected").agg(F.lit(None).cast("date"), F.lit("rejected"), F.count("*"))
    return events.union(bad)


@query(
    """SELECT part, count(*) AS n, CAST(sum(number) AS BIGINT) AS offsets FROM (
      SELECT number, CASE WHEN number % 97 = 0 THEN 'rejected' WHEN "timestamp" < TIMESTAMP '2024-01-20' THEN 'late'
        WHEN copy = 1 THEN 'duplicate' ELSE 'silver' END AS part
      FROM (SELECT CAST(event_id AS BIGINT) AS number, "timestamp", unnest(CASE WHEN CAST(event_id AS BIGINT) % 50 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM silver) m
      UNION ALL SELECT NULL, 'lost' WHERE FALSE) p
    GROUP BY part""",
    (SILVER,),
)
def stream_silver_late(spark, d):
    """Three batches in falling time order under a watermark of an hour: every message is in one of the four parts."""
    lake, config = _message_lake(spark, d)
    arrived = spark.read.parquet(f"{config.directory}/clickstream")
    moment = F.coalesce(F.get_json_object(F.col("value").cast("string"), "$.timestamp"), F.lit(None)).cast("timestamp")
    days = F.when(moment >= "2024-01-20", 0).when(moment >= "2024-01-10", 1).otherwise(2)
    for number in range(3):
        with_lineage(arrived.where(days == number)).write.mode("append").partitionBy("ingestion_date").parquet(lake.path("bronze_clickstream"))
        schema = read_table(spark, lake, "bronze_clickstream").schema
        raw = read_files_stream(spark, lake.path("bronze_clickstream"), schema)
        for running in start_silver(raw, lake, "1 hour", DRAIN):
            running.awaitTermination()
    counts = read_table(spark, lake, "silver_batches").agg(F.sum("received").alias("received"))
    parts = [read_table(spark, lake, name).select(F.lit(part).alias("part"), offset) for part, name, offset in (
        ("silver", "silver_clickstream", "kafka_offset"), ("late", "silver_late", "kafka_offset"), ("rejected", "silver_stream_rejected", "kafka_offset"))]
    kept = parts[0].union(parts[1]).union(parts[2])
    less = kept.select(-F.lit(1), -F.col("kafka_offset"))
    rest = arrived.select(F.lit(1).alias("n"), "offset").union(less).agg(F.sum("n").alias("n"), F.sum("offset").alias("offsets"))
    unseen = arrived.select(F.lit(1).alias("n")).union(counts.select(-F.col("received"))).agg(F.sum("n").alias("n"))
    found = kept.groupBy("part").agg(F.count("*").alias("n"), F.sum("kafka_offset").alias("offsets"))
    copies, lost = rest.select(F.lit("duplicate"), "n", "offsets"), unseen.select(F.lit("lost"), "n", F.lit(0).cast("bigint"))
    return found.union(copies).union(lost).where("n <> 0")


def _brought(spark, lake, rows) -> None:
    """Messages taken into bronze and through the silver stream, as one batch."""
    with_lineage(rows).write.mode("append").partitionBy("ingestion_date").parquet(lake.path("bronze_clickstream"))
    schema = read_table(spark, lake, "bronze_clickstream").schema
    for running in start_silver(read_files_stream(spark, lake.path("bronze_clickstream"), schema), lake, "1 hour", DRAIN):
        running.awaitTermination()


def _moment():
    return F.get_json_object(F.col("value").cast("string"), "$.timestamp").cast("timestamp")


@query(
    """SELECT part, count(*) AS n FROM (
      SELECT CASE WHEN number % 97 = 0 THEN 'rejected' ELSE 'silver' END AS part FROM
        (SELECT number, unnest(CASE WHEN number % 97 = 0 AND number % 50 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM (SELECT CAST(event_id AS BIGINT) AS number FROM silver) e) m
      UNION ALL SELECT 'future_time') p
    GROUP BY part""",
    (SILVER,),
)
def stream_future_stamp(spark, d):
    """The first batch holds an event of the year 2099; the events behind it are not late for that."""
    lake, config = _message_lake(spark, d)
    arrived = spark.read.parquet(f"{config.directory}/clickstream")
    early = F.coalesce(_moment() < "2024-01-15", F.lit(True))
    text = F.regexp_replace(F.col("value").cast("string"), '"timestamp":"[^"]*"', '"timestamp":"2099-01-01T00:00:00Z"')
    ahead = arrived.where(~early & (F.col("offset") % 97 != 0)).orderBy("offset").limit(1).withColumn("value", text.cast("binary"))
    _brought(spark, lake, arrived.where(early).unionByName(ahead))
    _brought(spark, lake, arrived.where(~early))
    reason = F.when(F.array_contains("reasons", "future_time"), "future_time").otherwise("rejected")
    parts = [
        read_table(spark, lake, "silver_clickstream").select(F.lit("silver").alias("part")), read_table(spark, lake, "silver_late").select(F.lit("late").alias("part")),
        read_table(spark, lake, "silver_stream_rejected").select(reason.alias("part")),
    ]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("part").agg(F.count("*").alias("n"))


@query(
    """SELECT event_date, CAST(hour("timestamp") AS INTEGER) AS event_hour, event_type, device_type, count(*) AS event_count, count(user_id) AS user_events,
      count(DISTINCT user_id) AS unique_users, CAST(sum(CAST(round(price * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_value
    FROM silver WHERE CAST(event_id AS BIGINT) % 97 <> 0 GROUP BY 1, 2, 3, 4""",
    (SILVER,),
)
def gold_with_late_events(spark, d):
    """Three batches in falling time order, so that most events are late, and the cells brought up after each; few users share an hour."""
    lake, config = _message_lake(spark, d)
    arrived = spark.read.parquet(f"{config.directory}/clickstream")
    part = F.when(_moment() >= "2024-01-20", 0).when(_moment() >= "2024-01-10", 1).otherwise(2)
    for number in range(3):
        _brought(spark, lake, arrived.where(part == number))
        start_gold_cells(spark, lake, DRAIN).awaitTermination()
    hourly = hourly_of(spark.read.parquet(lake.path("gold_cells")))
    return hourly.select("event_date", "event_hour", "event_type", "device_type", "event_count", "user_events", "unique_users", "total_value")


@query("SELECT 'stream.input.rows' AS metric_name, CAST(count(*) AS DOUBLE) AS total, TRUE AS timed, count(*) * 0 AS slow FROM events")
def stream_progress(spark, d):
    """Rows of a drained query as seen by the listener, and its batches slower than an hour."""
    import time

    recorder = ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        total = _drain(_events_stream(spark, d).drop("timestamp"), spark, "progress").count()
        for _ in range(100):  # the listener bus delivers a moment after the query has ended
            if sum(row[2] for row in recorder.rows) >= total:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(recorder)
    progress = recorder.frame(spark)
    slow = backlog(progress, 3_600_000).agg(F.count("*").alias("slow"))
    rows = progress_metrics(progress).where("metric_name = 'stream.input.rows'")
    timed = progress.agg(F.bool_and(F.col("trigger_ms") > 0)).scalar()
    return rows.groupBy("metric_name").agg(F.sum("metric_value").alias("total"), F.any_value(timed).alias("timed")).withColumn("slow", slow.scalar())
