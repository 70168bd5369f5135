"""Streaming forms: ingestion, conforming, windowed aggregates, sessions, routing."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillmark.functions.columns import cents
from rillmark.operators.layers import BROADCAST_KEYS, CORRUPT, EVENT_RULES, dedupe, dedupe_stored, parse_events, split_invalid, with_lineage, with_reasons
from rillmark.session import cut_lineage
from rillmark.sources.tables import Lake

EVERY_10_SECONDS = {"processingTime": "10 seconds"}
DRAIN = {"availableNow": True}


def start_table(
    df: DataFrame, path: str, checkpoint: str, name: str, by: list[str] | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Exactly-once append to a Parquet table: checkpoint plus the file sink's own log."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
    if by:
        writer = writer.partitionBy(*by)
    return writer.queryName(name).trigger(**(trigger or EVERY_10_SECONDS)).start()


def start_bronze(df: DataFrame, lake: Lake, topic: str, trigger: dict | None = None) -> StreamingQuery:
    """Raw messages with lineage, by ingestion date. A projection only: no shuffle, no state."""
    name = f"bronze_{topic}"
    return start_table(with_lineage(df), lake.path(name), lake.checkpoint(name), name, ["ingestion_date"], trigger)


def conform(raw: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Messages to valid events, each once. Of a stream, events behind the watermark are dropped; ``start_silver`` keeps them."""
    parsed = parse_events(raw)
    valid, _ = split_invalid(parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT))
    return first_events(valid, watermark)


EVENT_KEYS = ["session_id", "event_id"]


def first_events(events: DataFrame, watermark: str | None = None, stored: bool = False) -> DataFrame:
    """Each event once: the first by time, and by place in the log where times are equal. ``stored``: the rows can be read twice."""
    order = place_of(events)
    return dedupe_stored(events, EVENT_KEYS, order) if stored else dedupe(events, EVENT_KEYS, order, watermark)


def place_of(events: DataFrame) -> list[str]:
    """The columns by which the first copy of an event is told."""
    return ["event_ts", *[c for c in ("kafka_partition", "kafka_offset") if c in events.columns]]


def changes(stored: DataFrame, events: DataFrame) -> tuple[list[date], DataFrame]:
    """Event dates on which ``first_events`` of both together may differ from what is stored, and the events that matter for it.

    Events of a key that is stored once, all of them at its stored place, change nothing and
    are left out. These keys are told in one narrow aggregation; copies are compared for
    the others alone. A key whose copies have several dates counts for all of them.
    """
    place = place_of(events)
    narrow = lambda df, there: df.select(*EVENT_KEYS, *place, "event_date", F.lit(there).alias("_there"))
    both = narrow(stored, 1).unionByName(narrow(events, 0))
    one_place = [F.coalesce(F.min(c) == F.max(c), F.lit(True)) & F.count(c).isin(F.lit(0), F.count("*")) for c in place]
    keys = both.groupBy(*EVENT_KEYS).agg(((F.sum("_there") == 1) & reduce(and_, one_place)).alias("_settled"))
    open_keys = cut_lineage(keys.where(~F.col("_settled")).select(*EVENT_KEYS))
    if open_keys.count() <= BROADCAST_KEYS:
        open_keys = F.broadcast(open_keys)
    first, there = F.struct(*place), F.col("_there") == 1
    per_key = both.join(open_keys, EVENT_KEYS, "left_semi").groupBy(*EVENT_KEYS).agg(
        F.count_if(there).alias("_stored"), F.min(first).alias("_first"), F.min(F.when(there, first)).alias("_held"), F.collect_set("event_date").alias("_days"),
    )
    differ = per_key.where((F.col("_stored") != 1) | (F.col("_first") < F.col("_held")) | (F.size("_days") > 1))
    days = [row["day"] for row in differ.select(F.explode("_days").alias("day")).distinct().collect()]  # one value per day
    return days, events.join(open_keys, EVENT_KEYS, "left_semi").select(*events.columns)


#: How far an event time may lie behind the time of its ingestion, as clocks differ.
AHEAD = "1 day"


def judge(raw: DataFrame) -> DataFrame:
    """Parsed messages with the reasons for which they are no events; an empty list for events.

    An event that is dated later than it came in, by more than ``AHEAD``, is rejected as
    ``future_time``: it would move the line behind which events are late for good.
    """
    parsed = parse_events(raw)
    ahead = {"future_time": f"event_ts is null or event_ts <= ingestion_timestamp + interval {AHEAD}"} if "ingestion_timestamp" in parsed.columns else {}
    return with_reasons(parsed, {"malformed": f"{CORRUPT} is null", **EVENT_RULES, **ahead})


def rejected(raw: DataFrame) -> DataFrame:
    """Messages that do not become events, with their reasons."""
    return judge(raw).where(F.size("reasons") > 0)


def start_silver(raw: DataFrame, lake: Lake, watermark: str = "1 hour", trigger: dict | None = None) -> list[StreamingQuery]:
    """Raw stream to events, late events, rejected rows and a count of each batch; see ``silver_batch``."""
    writer = raw.writeStream.foreachBatch(silver_batch(lake, watermark)).option("checkpointLocation", lake.checkpoint("silver"))
    return [writer.queryName(SILVER_QUERY).trigger(**(trigger or EVERY_10_SECONDS)).start()]


SILVER_QUERY, GOLD_QUERY = "silver", "gold"


def silver_batch(lake: Lake, watermark: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that loses nothing: silver + late + rejected + duplicates = rows that came in.

    A batch is parsed once. The newest event time of the batches before, less the
    watermark, is the line behind which a valid event is late; late events go to a table
    of their own. The others are written once: their keys are compared with those of the
    stored days from that line on, which are few, and a batch that is tried again finds
    its own rows there. The other tables have a folder per batch, which a retry replaces.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        line = _line_before(spark, lake, batch_id, watermark)
        judged = judge(batch).persist()
        try:
            behind = F.coalesce(F.col("event_ts") < F.lit(line), F.lit(False)) if line else F.lit(False)
            good = F.size("reasons") == 0
            valid = judged.where(good).drop("reasons", CORRUPT)
            late, timely = valid.where(behind), valid.where(~behind)
            insert_new(first_events(timely), lake.path("silver_clickstream"), EVENT_KEYS, ["event_date"], F.to_date(F.lit(line)) if line else None)
            late.write.mode("overwrite").parquet(f"{lake.path('silver_late')}/batch={batch_id}")
            judged.where(~good).write.mode("overwrite").parquet(f"{lake.path('silver_stream_rejected')}/batch={batch_id}")
            counts = judged.agg(
                F.count("*").alias("received"), F.count_if(good & ~behind).alias("timely"), F.count_if(good & behind).alias("late"),
                F.count_if(~good).alias("rejected"), F.max(F.when(good, F.col("event_ts"))).alias("newest"),
            )
            seen = F.greatest("newest", F.lit(None if line is None else _newest_before(spark, lake, batch_id)).cast("timestamp"))
            counts.withColumn("newest", seen).write.mode("overwrite").parquet(f"{lake.path('silver_batches')}/batch={batch_id}")
        finally:
            judged.unpersist()

    return write


def _newest_before(spark, lake: Lake, batch_id: int):
    """Newest valid event time of all batches before: every batch stores the running maximum."""
    try:
        return spark.read.parquet(f"{lake.path('silver_batches')}/batch={batch_id - 1}").first()["newest"]
    except AnalysisException:
        return None


def _line_before(spark, lake: Lake, batch_id: int, watermark: str):
    newest = _newest_before(spark, lake, batch_id)
    return spark.range(1).select(F.lit(newest) - F.expr(f"INTERVAL {watermark}")).first()[0] if newest else None


def insert_new(rows: DataFrame, path: str, keys: list[str], by: list[str], since: Column | None = None) -> None:
    """Append the rows whose key is not stored yet, to a table partitioned by ``by``.

    With ``since`` only partitions from there on are compared.
    """
    try:
        stored = rows.sparkSession.read.parquet(path)
        stored = stored if since is None else stored.where(F.col(by[0]) >= since)
        rows = rows.join(stored.select(*keys), keys, "left_anti")
    except AnalysisException:
        pass  # nothing is stored yet
    rows.write.mode("append").partitionBy(*by).parquet(path)


def refuse_second_writer(spark, name: str) -> None:
    """A batch job must not rewrite a table while a stream of this session appends to it."""
    if any(query.name == name and query.isActive for query in spark.streams.active):
        raise RuntimeError(f"the stream {name!r} is writing this table; stop it first")


def hourly_stream(events: DataFrame, ts: str = "event_ts", watermark: str = "1 hour", rsd: float = 0.05) -> DataFrame:
    """Hourly metrics of a stream; users are approximate, as streams have no distinct count.

    Each open group keeps its user sketch in state: about 0.4 KB at 5 %, 12 KB at 1 %.
    """
    hour = F.window(ts, "1 hour")
    return (
        events.withWatermark(ts, watermark)
        .groupBy(hour, "event_type", "device_type")
        .agg(
            F.count("*").alias("event_count"),
            F.count("user_id").alias("user_events"),
            F.approx_count_distinct("user_id", rsd).alias("unique_users"),
            F.count("price").alias("priced_count"),
            F.sum(cents(F.col("price"))).alias("value_cents"),
        )
        .select(
            F.to_date("window.start").alias("event_date"),
            F.hour("window.start").alias("event_hour"),
            "event_type",
            "device_type",
            "event_count",
            "user_events",
            "unique_users",
            "priced_count",
            F.try_divide(F.col("value_cents") / F.lit(100.0), "priced_count").alias("avg_price"),
            (F.col("value_cents") / F.lit(100.0)).alias("total_value"),
        )
    )


def start_gold(events: DataFrame, lake: Lake, watermark: str = "1 hour", trigger: dict | None = None) -> StreamingQuery:
    """Closed hours into the hourly table, each once, in the layout that the batch job writes too.

    The watermark must be at least that of silver: rows then reach this query no later
    than its watermark allows, and none is dropped.
    """
    keys = ["event_date", "event_hour", "event_type", "device_type"]

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            oldest = batch.agg(F.min("event_date")).first()[0]  # a key has its day, so earlier days need no look
            if oldest:
                insert_new(batch, lake.path("gold_hourly"), keys, ["event_date"], F.lit(oldest))
        finally:
            batch.unpersist()

    writer = hourly_stream(events, "event_ts", watermark).writeStream.foreachBatch(write).outputMode("append")
    return writer.option("checkpointLocation", lake.checkpoint("gold")).queryName(GOLD_QUERY).trigger(**(trigger or EVERY_10_SECONDS)).start()


def sliding_counts(
    events: DataFrame, ts: str = "event_ts", size: str = "5 minutes", slide: str = "1 minute", watermark: str = "1 hour"
) -> DataFrame:
    """Events per type in overlapping windows."""
    return (
        events.withWatermark(ts, watermark)
        .groupBy(F.window(ts, size, slide), "event_type")
        .agg(F.count("*").alias("events"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "event_type", "events")
    )


def session_counts(events: DataFrame, gap: str, ts: str = "event_ts", watermark: str = "1 hour") -> DataFrame:
    """Sessions of every user by inactivity gap. State is one running total per open session."""
    return (
        events.withWatermark(ts, watermark)
        .groupBy("user_id", F.session_window(ts, gap))
        .agg(F.count("*").alias("events"), F.max(ts).alias("last_event_ts"))
        .select("user_id", F.col("session_window.start").alias("session_start"), "last_event_ts", "events")
    )


def carts_with_checkouts(
    adds: DataFrame, checkouts: DataFrame, within: str = "2 hours", ts: str = "event_ts", watermark: str = "1 hour"
) -> DataFrame:
    """Cart adds with the checkouts of their session up to ``within`` later; an add without one comes with nulls.

    Both frames are streams of events. A pair comes as soon as both events are there. An
    abandoned add comes once the watermarks of both have passed its range, after which
    neither side is kept: state is what happened within the range and the watermark. Events
    without a session or time never meet and are not waited for.
    """
    known = F.col("session_id").isNotNull() & F.col(ts).isNotNull()
    left = adds.where((F.col("event_type") == "add_to_cart") & known).withWatermark(ts, watermark)
    left = left.select("session_id", F.col("event_id").alias("add_id"), F.col(ts).alias("added_at"), "product_id", cents(F.col("price")).alias("price_cents"))
    right = checkouts.where((F.col("event_type") == "checkout_completed") & known).withWatermark(ts, watermark)
    right = right.select(F.col("session_id").alias("_session"), F.col("event_id").alias("checkout_id"), F.col(ts).alias("completed_at"))
    in_range = F.col("completed_at").between(F.col("added_at"), F.col("added_at") + F.expr(f"interval {within}"))
    return left.join(right, (F.col("session_id") == F.col("_session")) & in_range, "left_outer").drop("_session")


def route(routes: dict[str, tuple[Column, str]]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that sends rows to tables by predicate.

    A batch that is tried again replaces its own folder, so nothing is written twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        for condition, path in routes.values():
            batch.where(condition).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def start_router(df: DataFrame, routes: dict[str, tuple[Column, str]], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(route(routes)).option("checkpointLocation", checkpoint)
    return writer.queryName("router").trigger(**(trigger or EVERY_10_SECONDS)).start()


def stop_all(queries: list[StreamingQuery]) -> None:
    """Stop every query that still runs, even if stopping one of them fails."""
    problems = []
    for query in queries:
        try:
            if query is not None and query.isActive:
                query.stop()
        except Exception as error:
            problems.append(error)
    if problems:
        raise problems[0]


def run_until_any_ends(spark, queries: list[StreamingQuery]) -> None:
    """Wait for whichever query ends first, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        stop_all(queries)
