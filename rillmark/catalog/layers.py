"""Registered queries: raw messages to events, splits, and writes that are read back."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from rillmark.catalog.registry import AS_OF, AS_OF_SQL, query
from rillmark.catalog.tables import LINES, NUMBERED, SILVER, given, messages, metric_history, numbered_lines, runs, silver
from rillmark.catalog.tables import GOLD, METRICS, RUNS
from rillmark.functions.columns import json_tag, normalise_text, strip_prefix
from rillmark.operators import layers
from rillmark.operators.orders import nest_items
from rillmark.session import scratch_path
from rillmark.sinks.key_index import insert_indexed, repeated_keys
from rillmark.sinks.mart import metric_rows
from rillmark.sinks.messages import to_messages
from rillmark.sinks.tables import append_new, append_rows, apply_retention, write_compacted, write_partitions
from rillmark.sources.tables import Lake, first_readable, layer_status, read_files, read_table, register_views, run_sql
from rillmark.streaming.queries import conform, rejected

# every 97th message is cut short, every 50th is sent twice
GOOD = "good AS (SELECT * FROM silver WHERE CAST(event_id AS BIGINT) % 97 <> 0)"
SENT = """sent AS (SELECT silver.*, CAST(event_id AS BIGINT) AS number FROM silver
  UNION ALL SELECT silver.*, CAST(event_id AS BIGINT) FROM silver WHERE CAST(event_id AS BIGINT) % 50 = 0)"""


@query(
    """SELECT 'clickstream' AS source_topic, CAST(k % 4 AS INTEGER) AS kafka_partition, number AS kafka_offset,
      "timestamp" + k * INTERVAL 1 MINUTE AS kafka_timestamp, TRUE AS dated FROM sent""",
    (SILVER, SENT),
)
def bronze_lineage(spark, d):
    rows = layers.with_lineage(messages(spark, d))
    dated = F.col("ingestion_date") == F.date_format("ingestion_timestamp", "yyyy-MM-dd")
    return rows.select("source_topic", "kafka_partition", "kafka_offset", F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_timestamp"), dated.alias("dated"))


@query("SELECT length(event_id) > 0 AS has_text, count(*) AS n FROM sent GROUP BY 1", (SILVER, SENT))
def raw_landing(spark, d):
    rows = layers.land_raw(messages(spark, d))
    return rows.groupBy((F.length("event_data") > 0).alias("has_text")).agg(F.count("received_at").alias("n"))


EVENT_SQL = """event_id, user_id, session_id, event_type, device_type, product_id, price,
  date_trunc('second', "timestamp") AS event_ts, event_date, CAST(hour("timestamp") AS INTEGER) AS event_hour,
  CAST(date_trunc('month', "timestamp") AS DATE) AS event_month"""
EVENT_COLUMNS = [
    "event_id", "user_id", "session_id", "event_type", "device_type", "product_id", "price", "event_ts", "event_date",
    "event_hour", "event_month",
]


@query(f"SELECT {EVENT_SQL} FROM sent WHERE number % 97 <> 0", (SILVER, SENT))
def parsed_events(spark, d):
    good, _ = layers.split_malformed(layers.parse_events(messages(spark, d)))
    return good.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz")).select(*EVENT_COLUMNS)


@query("SELECT count(*) AS n FROM sent WHERE number % 97 = 0", (SILVER, SENT))
def malformed_messages(spark, d):
    _, bad = layers.split_malformed(layers.parse_events(messages(spark, d)))
    return bad.agg(F.count("_corrupt_record").alias("n"))


@query(f"SELECT {EVENT_SQL} FROM good", (SILVER, GOOD))
def conformed_events(spark, d):
    """Parsed, valid, and each event once."""
    events = conform(layers.with_lineage(messages(spark, d)))
    return events.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz")).select(*EVENT_COLUMNS)


@query(
    """SELECT event_id, event_type, min(number) AS first_offset FROM (
      SELECT event_id, event_type, CAST(event_id AS BIGINT) + i * 1000000000 AS number FROM silver,
        (SELECT unnest([0, 1, 2]) AS i) n WHERE i = 0 OR CAST(event_id AS BIGINT) % 20 = i) s GROUP BY 1, 2""",
    (SILVER,),
)
def stored_events_once(spark, d):
    """A stored table in which a tenth of the events repeat."""
    rows = silver(spark, d).select("event_id", "event_type", F.col("event_id").cast("bigint").alias("number"))
    again = [rows.where(F.col("number") % 20 == i).withColumn("number", F.col("number") + i * 1000000000) for i in (1, 2)]
    path = scratch_path(spark, "repeated")
    append_rows(rows.union(again[0]).union(again[1]), path)
    once = layers.dedupe_stored(spark.read.parquet(path), ["event_id"], ["number"])
    return once.select("event_id", "event_type", F.col("number").alias("first_offset"))


@query("SELECT 'malformed,missing_required,bad_time,unknown_event_type,unknown_device_type' AS reasons, count(*) AS n FROM sent WHERE number % 97 = 0", (SILVER, SENT))
def rejected_messages(spark, d):
    rows = rejected(messages(spark, d))
    return rows.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count("*").alias("n"))


@query("SELECT event_id, native_type, native_type <> 'error' AS valid FROM silver", (SILVER,))
def domain_split(spark, d):
    """Entry filter on the native event names, of which ``error`` is not allowed."""
    rows = silver(spark, d)
    good, bad = layers.split_invalid(rows, {"unknown_event_type": "native_type in ('view', 'click', 'signup', 'purchase')"})
    keep = ["event_id", "native_type"]
    return good.select(*keep, F.lit(True).alias("valid")).union(bad.select(*keep, F.lit(False)))


@query("SELECT event_id, k > 60 AS late FROM silver", (SILVER,))
def late_split(spark, d):
    """Messages that arrived more than an hour after their event, and the others."""
    rows = silver(spark, d).withColumn("arrived", F.col("timestamp") + F.make_dt_interval(mins=F.col("k")))
    on_time, late = layers.split_late(rows, "timestamp", "arrived", timedelta(hours=1))
    return on_time.select("event_id", F.lit(False).alias("late")).union(late.select("event_id", F.lit(True)))


@query("SELECT user_id, event_type, event_date, min(event_id) AS event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, event_date ORDER BY \"timestamp\", event_id) AS rn FROM silver) s WHERE rn = 1 GROUP BY 1, 2, 3", (SILVER,))
def first_event_per_day(spark, d):
    """Deduplication that keeps the earliest row of each key."""
    rows = silver(spark, d).select("user_id", "event_type", "event_date", "event_id", "timestamp")
    return layers.dedupe(rows, ["user_id", "event_type", "event_date"], ["timestamp", "event_id"]).drop("timestamp")


@query("SELECT event_id, price FROM silver WHERE event_type = 'checkout_completed'", (SILVER,))
def purchases(spark, d):
    return layers.filter_type(silver(spark, d), "checkout_completed").select("event_id", "price")


@query("SELECT event_id FROM silver WHERE event_type IS NOT NULL AND price IS NOT NULL", (SILVER,))
def complete_rows(spark, d):
    return layers.drop_nulls(silver(spark, d), ["event_type", "price", "no_such_column"]).select("event_id")


@query("""SELECT event_id, regexp_extract(props, '"k": *([0-9]+)', 1) AS k FROM events""")
def json_tags(spark, d):
    return given(spark, d, "events").select("event_id", json_tag(F.col("props"), "k").alias("k"))


@query("SELECT DISTINCT substr(metric_name, 17) AS stage FROM metrics WHERE metric_name LIKE 'business.funnel.%'", (SILVER, GOLD, METRICS))
def metric_name_stages(spark, d):
    rows = metric_history(spark, d).where(F.startswith("metric_name", F.lit("business.funnel.")))
    return rows.select(strip_prefix(F.col("metric_name"), "business.funnel.").alias("stage")).distinct()


@query("SELECT DISTINCT lower(trim(c_mktsegment)) AS segment FROM customer")
def normalised_segments(spark, d):
    padded = F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("  "))
    return given(spark, d, "customer").select(normalise_text(padded).alias("segment")).distinct()


ITEMS_SQL = "SELECT transaction_id, product_id, quantity, CAST(unit_price * 100 AS BIGINT) AS price_cents, line_no FROM numbered"


@query(ITEMS_SQL, (LINES, NUMBERED))
def numbered_order_lines(spark, d):
    rows = numbered_lines(spark, d)
    return rows.select("transaction_id", "product_id", "quantity", (F.col("unit_price") * 100).cast("bigint").alias("price_cents"), "line_no")


@query(ITEMS_SQL, (LINES, NUMBERED))
def exploded_items(spark, d):
    """Lines nested into message-sized arrays and taken apart again."""
    rows = numbered_order_lines(spark, d)
    size = 4
    nested = nest_items(rows, "transaction_id", "line_no", ["product_id", "quantity", "price_cents"], size)
    lines = layers.explode_items(nested, ["transaction_id", "page"])
    return lines.withColumn("line_no", (F.col("page") * size + F.col("line_no")).cast("bigint")).drop("page")


@query(
    """SELECT user_id AS key, count(*) AS n, count(*) FILTER (WHERE event_type = 'search') AS searches
    FROM silver GROUP BY 1""",
    (SILVER,),
)
def keyed_messages(spark, d):
    """Events as keyed JSON, read back from the JSON text; the null search text stays in it."""
    rows = silver(spark, d).select("user_id", "event_type", "price", F.lit(None).cast("string").alias("search_query"))
    sent = to_messages(rows)
    kind = json_tag(F.col("value"), "event_type")
    kept = sent.where(F.contains("value", F.lit('"search_query":null')))
    return kept.groupBy("key").agg(F.count("*").alias("n"), F.count_if(kind == "search").alias("searches"))


# ---- writes, read back ----------------------------------------------------------


@query("SELECT event_date, count(*) AS n, count(DISTINCT event_id) AS events FROM good GROUP BY 1", (SILVER, GOOD))
def silver_written_twice(spark, d):
    """The event table after two runs of the same job: the second replaces the first."""
    path = scratch_path(spark, "silver")
    events = conform(layers.with_lineage(messages(spark, d)))
    for _ in range(2):
        write_partitions(events, path, ["event_date"])
    return spark.read.parquet(path).groupBy("event_date").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("events"))


@query("SELECT event_date, event_type, count(*) AS n, TRUE AS clustered FROM silver GROUP BY 1, 2", (SILVER,))
def compacted_partitions(spark, d):
    """The second half of the month rewritten as few sorted files; the first half is left alone."""
    path = scratch_path(spark, "compact")
    silver(spark, d).write.partitionBy("event_date").parquet(path)
    write_compacted(spark, path, F.col("event_date") >= "2024-01-16", ["event_date"], ["event_type", "timestamp"], 4)
    rows = spark.read.parquet(path)
    files = rows.withColumn("file", F.input_file_name()).groupBy("event_date").agg(F.countDistinct("file").alias("files"))
    small = files.select("event_date", (F.col("files") <= 4).alias("clustered"))
    return rows.groupBy("event_date", "event_type").agg(F.count("*").alias("n")).join(small, "event_date")


@query("SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id FROM silver) s GROUP BY 1", (SILVER,))
def inserted_if_absent(spark, d):
    """Users of the first half of the month, then those of the whole month: each is there once."""
    path = scratch_path(spark, "absent")
    users = silver(spark, d)
    append_new(users.where(F.col("event_date") < "2024-01-16").select("user_id"), path, ["user_id"])
    append_new(users.select("user_id"), path, ["user_id"])
    return spark.read.parquet(path).groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT user_id, min(event_date) AS first_date FROM silver GROUP BY 1", (SILVER,))
def inserted_by_key_index(spark, d):
    """Users by the day they are first seen on, in three loads of which the last brings nothing new: keys are unique over all days."""
    path = scratch_path(spark, "indexed")
    seen = silver(spark, d).where("user_id is not null")
    early = seen.where(F.col("event_date") < "2024-01-16")
    loads = [rows.groupBy("user_id").agg(F.min("event_date").alias("event_date")) for rows in (early, seen, seen)]
    added = [insert_indexed(rows, path, ["user_id"], ["event_date"]) for rows in loads]
    if added[2].rows:
        raise RuntimeError("a load that is repeated must add nothing")
    return spark.read.schema(loads[0].schema).parquet(path).select("user_id", F.col("event_date").alias("first_date"))


@query("SELECT event_id, count(*) AS n FROM sent GROUP BY 1 HAVING count(*) > 1", (SILVER, SENT))
def repeated_over_partitions(spark, d):
    """Events that were sent twice and stored on two days: uniqueness over the whole table, from the index of its keys."""
    path = scratch_path(spark, "repeated")
    events = silver(spark, d).select("event_id", "event_date")
    again = events.where(F.col("event_id").cast("bigint") % 50 == 0).withColumn("event_date", F.date_add("event_date", 40))
    events.union(again).hint("rebalance", "event_date").write.partitionBy("event_date").parquet(path)
    table = spark.read.schema(events.schema).parquet(path)
    return repeated_keys(table, path, ["event_id"], ["event_date"]).withColumnRenamed("rows", "n")


@query(f"SELECT run_id, started_at FROM runs WHERE started_at >= {AS_OF_SQL} - INTERVAL 7 DAY", (RUNS,))
def retained_runs(spark, d):
    return apply_retention(runs(spark, d), "started_at", timedelta(days=7), AS_OF).select("run_id", "started_at")


@query("SELECT pipeline_name, status, count(*) AS n, CAST(sum(events_processed) AS BIGINT) AS events FROM runs GROUP BY 1, 2", (RUNS,))
def run_log_csv(spark, d):
    """Run records as CSV lines, read back."""
    path = scratch_path(spark, "runlog")
    rows = runs(spark, d).select("pipeline_name", "run_id", "status", "events_processed")
    rows.write.mode("append").csv(path)
    log = spark.read.schema(rows.schema).csv(path)
    return log.groupBy("pipeline_name", "status").agg(F.count("*").alias("n"), F.sum("events_processed").alias("events"))


@query("SELECT metric_name, metric_unit, count(*) AS n, count(tag) AS tagged FROM metrics GROUP BY 1, 2", (SILVER, GOLD, METRICS))
def appended_metrics(spark, d):
    """Metric rows appended to the mart table, read back."""
    lake = Lake(scratch_path(spark, "mart"))
    append_rows(metric_rows(metric_history(spark, d)), lake.path("pipeline_metrics"))
    rows = read_table(spark, lake, "pipeline_metrics")
    return rows.groupBy("metric_name", "metric_unit").agg(F.count("*").alias("n"), F.count("tags").alias("tagged"))


# ---- sources ----------------------------------------------------------------------


@query(
    """SELECT 'silver_clickstream' AS table_name, TRUE AS available, count(*) AS row_count FROM silver
    UNION ALL SELECT 'gold_hourly', TRUE, count(*) FROM gold
    UNION ALL SELECT 'alerts', FALSE, 0""",
    (SILVER, GOLD),
)
def layer_status_report(spark, d):
    from rillmark.catalog.tables import gold

    lake = _small_lake(spark, d)
    append_rows(gold(spark, d), lake.path("gold_hourly"))
    return layer_status(spark, lake)


def _small_lake(spark, d) -> Lake:
    names = ("silver_clickstream", "gold_hourly", "alerts")
    lake = Lake(scratch_path(spark, "lake"), tables={name: name for name in names})
    append_rows(silver(spark, d), lake.path("silver_clickstream"))
    return lake


@query("SELECT count(*) AS n, CAST(sum(k) AS BIGINT) AS total FROM silver", (SILVER,))
def many_files_one_table(spark, d):
    """Files in folders of different depth, written with different columns, read as one table."""
    root = scratch_path(spark, "files")
    rows = silver(spark, d)
    rows.where("k < 50").select("event_id", "k").write.parquet(f"{root}/a")
    rows.where("k >= 50").select("event_id", "k", "price").write.parquet(f"{root}/b/c")
    return read_files(spark, f"{root}/a", f"{root}/b").agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query("SELECT count(*) AS n FROM events")
def first_readable_source(spark, d):
    tried = [("delta", f"{d}/no_such_table"), ("parquet", f"{d}/no_such_file.parquet"), ("parquet", f"{d}/events.parquet")]
    return first_readable(spark, tried).agg(F.count("*").alias("n"))


@query(
    """SELECT event_type, count(*) AS n FROM silver GROUP BY 1""",
    (SILVER,),
)
def sql_over_views(spark, d):
    register_views(spark, _small_lake(spark, d))
    return run_sql(spark, "SELECT event_type, count(*) AS n FROM silver_clickstream GROUP BY event_type")
