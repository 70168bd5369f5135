"""Batch and streaming jobs over a lake. Each takes the session and the lake."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillmark.operators.aggregates import gold_rollup, hourly_metrics, kpis, valid_rate
from rillmark.operators.behaviour import cohort_retention, daily_active, journeys, rfm, session_funnel, step_conversion
from rillmark.operators.check_states import merged_suites
from rillmark.operators.layers import CORRUPT
from rillmark.operators.mart import ALERT_RULES, active_alerts, alert_episodes, alert_rows, evaluate_alerts, run_metrics
from rillmark.operators.quality import (
    VALIDATION_POLICY, WRITE_POLICY, check_gold, checks_of_reports, gate, report, run_suites,
)
from rillmark.plans.quality_states import refresh_states
from rillmark.schemas import METRIC
from rillmark.sinks.mart import run_key, run_row, write_metrics, write_report, write_run, write_run_rows
from rillmark.sinks.tables import trim_table, write_partitions
from rillmark.sources.streams import StreamConfig, read_events_stream
from rillmark.sources.tables import Lake, exists, layer_status, read_table, report_of_run
from rillmark.streaming.queries import GOLD_QUERY, SILVER_QUERY, changes, first_events, judge, refuse_second_writer, start_bronze, stop_all


class PublicationBlocked(RuntimeError):
    """A quality gate did not approve writing aggregates."""


def now_utc() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def bronze_job(
    spark: SparkSession, lake: Lake, config: StreamConfig, topics=("clickstream", "transactions"), trigger: dict | None = None
) -> list[StreamingQuery]:
    """One ingestion query per topic. If one cannot start, those already started are stopped."""
    queries: list[StreamingQuery] = []
    try:
        for topic in topics:
            queries.append(start_bronze(read_events_stream(spark, config, topic), lake, topic, trigger))
    except Exception:
        stop_all(queries)
        raise
    return queries


@dataclass(frozen=True)
class Written:
    """Rows of silver on the event dates that a run took up, messages that it rejected, and those dates."""

    events: int
    rejected: int
    days: tuple[date, ...] = ()


def silver_job(spark: SparkSession, lake: Lake, ingestion_dates: list[str] | None = None, full: bool = False) -> Written:
    """Raw messages to events by date, and what there is then on the dates they touch.

    Only the given raw partitions are read, by default those that may hold messages that
    silver has not seen: the newest one it knows and all after it. Only the event dates
    they touch are taken up: stored events of those dates and new ones go through the
    same deduplication, so a repeated run changes nothing, and dates on which it would
    change nothing keep their files (``changes``). ``full`` reads everything.
    Messages are parsed once, into a staged table that both outputs are cut from. Copies
    of an event are taken to carry the same event time.
    """
    refuse_second_writer(spark, SILVER_QUERY)
    raw = read_table(spark, lake, "bronze_clickstream")
    known = exists(spark, lake, "silver_clickstream") and not full
    if ingestion_dates is None and known:
        ingestion_dates = open_ingestion_dates(spark, lake)
    if ingestion_dates is not None:
        raw = raw.where(F.col("ingestion_date").cast("string").isin(*ingestion_dates))
    staged_path = f"{lake.root}/_staging/silver-{uuid.uuid4().hex[:12]}"
    judge(raw).write.parquet(staged_path)
    staged = spark.read.parquet(staged_path)
    events = staged.where(F.size("reasons") == 0).drop("reasons", CORRUPT)
    # a row per event date and one for rejected messages
    good = F.size("reasons") == 0
    found = staged.groupBy(good.alias("good"), F.when(good, F.col("event_date")).alias("event_date")).agg(F.count("*").alias("n")).collect()
    days, rejected = [r["event_date"] for r in found if r["good"]], sum(r["n"] for r in found if not r["good"])
    add_pending(spark, lake, days)
    rewritten = days
    if known and days:
        stored = read_table(spark, lake, "silver_clickstream").where(F.col("event_date").isin(*days)).select(*events.columns)
        rewritten, new = changes(stored, events)
        some = F.col("event_date").isin(*rewritten)
        events = stored.where(some).unionByName(new.where(some))
    if rewritten:
        write_partitions(first_events(events, stored=True), lake.path("silver_clickstream"), ["event_date"], lake.file_format)
    written = read_table(spark, lake, "silver_clickstream").where(F.col("event_date").isin(*days)).count() if days else 0
    bad = staged.where(F.size("reasons") > 0)
    if rejected:
        write_partitions(bad.withColumn("ingested_on", F.to_date("ingestion_timestamp")), lake.path("silver_rejected"), ["ingested_on"], lake.file_format)
    target = spark._jvm.org.apache.hadoop.fs.Path(staged_path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return Written(written, rejected, tuple(sorted(days)))


def open_ingestion_dates(spark: SparkSession, lake: Lake) -> list[str]:
    """Raw partitions from the newest one that silver or its rejected rows know of, that one included."""
    newest = [
        read_table(spark, lake, name).agg(F.to_date(F.max("ingestion_timestamp"))).first()[0]
        for name in ("silver_clickstream", "silver_rejected") if exists(spark, lake, name)
    ]
    newest = [day for day in newest if day is not None]
    days = read_table(spark, lake, "bronze_clickstream").select(F.col("ingestion_date").cast("string").alias("day")).distinct()
    if newest:
        days = days.where(F.col("day") >= max(newest).isoformat())
    return sorted(row["day"] for row in days.collect())  # one value per raw partition


def add_pending(spark: SparkSession, lake: Lake, days: list[date]) -> None:
    """Note days of silver that gold has yet to take up; written before silver is, so that a failed run loses none."""
    spark.createDataFrame([(day,) for day in days], "event_date date").coalesce(1).write.mode("append").parquet(f"{lake.root}/_pending/gold")


def pending_days(spark: SparkSession, lake: Lake) -> list[date] | None:
    """Days that silver has taken up since gold last did; None if that is not known."""
    try:
        return sorted(event_dates(spark.read.parquet(f"{lake.root}/_pending/gold")))
    except AnalysisException:
        return None


def clear_pending(spark: SparkSession, lake: Lake) -> None:
    """Start an empty list of pending days."""
    spark.createDataFrame([], "event_date date").coalesce(1).write.mode("overwrite").parquet(f"{lake.root}/_pending/gold")


def event_dates(events: DataFrame) -> list[date]:
    """The days that events fall on: one value per day."""
    return [row["event_date"] for row in events.select("event_date").distinct().collect()]


def typed_events(spark: SparkSession, lake: Lake) -> DataFrame:
    """Silver with ``timestamp`` as the typed event time, as all operators expect it."""
    silver = read_table(spark, lake, "silver_clickstream")
    return silver.drop("timestamp").withColumnRenamed("event_ts", "timestamp")


#: Columns that every event carries; completeness is the share of their cells that are filled.
CORE_COLUMNS = ("event_id", "user_id", "session_id", "event_type", "device_type", "timestamp", "event_date", "price")


def new_run_id() -> str:
    return f"run_{uuid.uuid4().hex[:12]}"


@dataclass(frozen=True)
class Verdict:
    """What the first gate says about the checks of one run; that run's report is stored under its id."""

    run_id: str
    approved: bool

    def __bool__(self) -> bool:
        return self.approved


def quality_job(
    spark: SparkSession, lake: Lake, as_of: datetime, backfill: bool = True, run_id: str | None = None, columns: tuple[str, ...] | None = CORE_COLUMNS,
    changed_only: bool = False,
) -> Verdict:
    """Run the suites over ``columns`` (None for all), store the report, and judge the checks just computed.

    With ``changed_only`` only days whose files changed since the last such run are read;
    the others are judged by their stored states. Distinct users and sessions in the details
    are then estimates; verdicts are the same.
    """
    run_id = run_id or new_run_id()
    if changed_only:
        checks = merged_suites(*current_states(spark, lake, columns), as_of, backfill)
    else:
        events = typed_events(spark, lake)
        checks = run_suites(events if columns is None else events.select(*columns), as_of, backfill)
    checks = spark.createDataFrame(checks.collect(), checks.schema)  # a few dozen rows, used twice
    write_report(report(checks, as_of.isoformat(), run_id, now_utc().isoformat()), lake.reports)
    return Verdict(run_id, gate(checks, VALIDATION_POLICY).first()["approved"])


def current_states(spark: SparkSession, lake: Lake, columns: tuple[str, ...] | None = CORE_COLUMNS) -> tuple[DataFrame, DataFrame | None]:
    """Check states of all days of silver, and of the parents of its sessions; days whose files changed are read for it."""
    def read(silver: DataFrame) -> DataFrame:
        events = silver.drop("timestamp").withColumnRenamed("event_ts", "timestamp")
        return events if columns is None else events.select(*columns)

    states = refresh_states(spark, lake.path("silver_clickstream"), f"{lake.root}/quality/states", "event_date", read)
    return states.rows, states.parents


def approved(spark: SparkSession, lake: Lake, run_id: str, policy: frozenset[str] = WRITE_POLICY) -> bool:
    """Verdict of the report of one run; without one the answer is no."""
    stored = report_of_run(spark, lake.reports, run_id)
    if stored is None:
        return False
    return gate(checks_of_reports(stored), policy).first()["approved"]


def gold_job(spark: SparkSession, lake: Lake, run_id: str, days: list[date] | None = None) -> int:
    """Hourly table, of all days or of some, after the gate on the report of ``run_id``.

    A blocked gate raises and leaves the table as it was.
    """
    refuse_second_writer(spark, GOLD_QUERY)
    if not approved(spark, lake, run_id, WRITE_POLICY):
        raise PublicationBlocked(f"the quality report of {run_id} is missing or has blocking failures")
    if days is not None and not days:
        return 0
    events = typed_events(spark, lake)
    if days is not None:
        events = events.where(F.col("event_date").isin(*days))
    written = Observation("gold")
    gold = hourly_metrics(events).observe(written, F.count("*").alias("rows"))
    write_partitions(gold, lake.path("gold_hourly"), ["event_date"], lake.file_format)
    return written.get["rows"]


def metrics_job(spark: SparkSession, lake: Lake, as_of: datetime, run_id: str, jdbc: dict[str, str] | None = None) -> None:
    """Figures and checks of the hourly table into the mart; a repeated run of one time replaces them."""
    gold = read_table(spark, lake, "gold_hourly")
    write_metrics(kpis(gold), lake, jdbc, as_of)
    checks = check_gold(gold, as_of).select(
        F.lit(run_id).alias("run_id"),
        "check_name",
        F.lit("gold.hourly_metrics").alias("dataset"),
        "status",
        "records_checked",
        "records_failed",
        "failure_rate",
        F.lit(as_of).alias("checked_at"),
    )
    write_run_rows(checks, lake, "data_quality_checks", as_of)


def alerts_job(spark: SparkSession, lake: Lake, as_of: datetime) -> DataFrame:
    """Figures of the recorded runs into the mart, then the verdict of every alert rule into the alert table."""
    write_metrics(run_metrics(read_table(spark, lake, "pipeline_runs"), as_of), lake, None, as_of, source="runs")
    known = exists(spark, lake, "pipeline_metrics")
    metrics = read_table(spark, lake, "pipeline_metrics") if known else spark.createDataFrame([], METRIC)
    verdicts = alert_rows(evaluate_alerts(metrics, ALERT_RULES, as_of), as_of)
    write_run_rows(verdicts, lake, "alerts", as_of)
    return read_table(spark, lake, "alerts").where(F.col("run_at") == run_key(as_of))


def current_alerts(spark: SparkSession, lake: Lake, as_of: datetime) -> DataFrame:
    """Alerts that fire at ``as_of``: one row per open episode of the stored verdicts, aged from its opening."""
    verdicts = read_table(spark, lake, "alerts").where(F.col("triggered_at") <= F.lit(as_of))
    return active_alerts(alert_episodes(verdicts), as_of)


#: Table -> (time column, how long its rows are kept), for tables partitioned by run time.
RETENTION = {
    "pipeline_metrics": ("recorded_at", timedelta(days=90)),
    "data_quality_checks": ("checked_at", timedelta(days=7)),
    "alerts": ("triggered_at", timedelta(days=90)),
    "pipeline_runs": ("started_at", timedelta(days=7)),
}


def retention_job(spark: SparkSession, lake: Lake, as_of: datetime, keep: dict[str, tuple[str, timedelta]] = RETENTION) -> dict[str, list[str]]:
    """Delete run times of the mart tables that are older than they are kept; returns what went."""
    return {name: trim_table(spark, lake.path(name), column, age, as_of, "run_at") for name, (column, age) in keep.items()}


def analytics_job(spark: SparkSession, lake: Lake, as_of: datetime) -> dict[str, DataFrame]:
    """The customer analyses as lazy frames by name."""
    events = typed_events(spark, lake)
    return {
        "funnel": step_conversion(session_funnel(events)),
        "cohorts": cohort_retention(events),
        "rfm": rfm(events, as_of, value=F.coalesce("cart_total", "price")),
        "daily_active": daily_active(events),
        "journeys": journeys(events, limit=10),
    }


def layer_report(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """What is in each layer."""
    out = {"tables": layer_status(spark, lake)}
    if exists(spark, lake, "silver_clickstream"):
        out["silver_validity"] = valid_rate(read_table(spark, lake, "silver_clickstream"), "event_type")
    if exists(spark, lake, "gold_hourly"):
        out["gold"] = gold_rollup(read_table(spark, lake, "gold_hourly"))
    return out


def run_all(spark: SparkSession, lake: Lake, as_of: datetime | None = None, name: str = "lake_refresh", full: bool = False) -> str:
    """Silver, quality gate, gold; then metrics in any case, a record of this run, alerts and retention.

    Silver reads only raw partitions that it has not seen whole, and gold only the days that
    silver has rewritten since gold last ran; checks read the days whose files changed. ``full``
    rebuilds both and checks all rows.
    """
    given, as_of = as_of, as_of or now_utc()
    started, run_id = now_utc(), new_run_id()
    status, written, error = "success", Written(0, 0), None
    try:
        written = silver_job(spark, lake, full=full)
        # states are known by the files of a plain table; other formats have files that no longer count
        if not quality_job(spark, lake, as_of, run_id=run_id, changed_only=lake.file_format == "parquet" and not full):
            raise PublicationBlocked("validation gate: blocking suites failed")
        # what earlier runs left open is taken up too; a first or full run writes all days
        pending = pending_days(spark, lake) if exists(spark, lake, "gold_hourly") and not full else None
        gold_job(spark, lake, run_id, pending)
        clear_pending(spark, lake)
    except Exception as problem:
        status, error = "failed", f"{type(problem).__name__}: {problem}"
    if exists(spark, lake, "gold_hourly"):
        metrics_job(spark, lake, as_of, run_id)
    row = run_row(spark, name, run_id, started, now_utc(), status, written.events, written.rejected, error)
    write_run(row.withColumn("run_at", F.lit(run_key(started))), lake, csv_fallback=f"{lake.root}/metrics/run_log")
    if exists(spark, lake, "pipeline_runs"):
        alerts_job(spark, lake, given or now_utc())  # without a given time this run counts too
        retention_job(spark, lake, as_of)
    return status
