"""Registered queries: snapshot, health, rates, panels, bands, alert rules, targets."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from rillmark.catalog.registry import AS_OF, AS_OF_SQL, query
from rillmark.catalog.tables import (
    ALERTS, CHECKS, GOLD, METRICS, RESOURCES, RUNS, SILVER,
    alerts, check_history, metric_history, resources, runs, silver,
)
from rillmark.functions.columns import age_seconds, run_duration
from rillmark.operators import aggregates as agg
from rillmark.operators import links, mart

M = (SILVER, GOLD, METRICS)
NOON = datetime(2024, 1, 15, 12)
NOON_SQL = "TIMESTAMP '2024-01-15 12:00:00'"


@query("SELECT metric_name, arg_max(metric_value, recorded_at) AS metric_value, max(recorded_at) AS recorded_at FROM metrics WHERE tag IS NULL GROUP BY 1", M)
def latest_metrics(spark, d):
    rows = metric_history(spark, d).where("tags is null")
    return mart.latest_metrics(rows).select("metric_name", "metric_value", "recorded_at")


@query(
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC) AS rn FROM silver) s
    WHERE rn = 1""",
    (SILVER,),
)
def last_event_per_user(spark, d):
    rows = silver(spark, d).select("user_id", "timestamp", "event_id", "event_type")
    return mart.last_per_key(rows, ["user_id"], "timestamp").drop("timestamp")


@query(
    f"""SELECT metric_name, arg_max(metric_value, recorded_at) AS metric_value, max(recorded_at) AS recorded_at
    FROM metrics WHERE tag IS NULL AND recorded_at <= {NOON_SQL} GROUP BY 1""",
    M,
)
def metrics_as_of(spark, d):
    return links.value_as_of(metric_history(spark, d).where("tags is null"), NOON)


@query(
    """SELECT e.event_id, e.event_type, (SELECT arg_max(p.price, p."timestamp") FROM silver p WHERE p.event_type = 'checkout_completed'
      AND p.device_type = e.device_type AND p."timestamp" <= e."timestamp") AS last_price FROM silver e WHERE e.event_type <> 'checkout_completed'""",
    (SILVER,),
)
def as_of_join(spark, d):
    """For every other event the device's last purchase price at that moment."""
    rows = silver(spark, d)
    bought = F.col("event_type") == "checkout_completed"
    points = rows.where(~bought).select("event_id", "event_type", "device_type", "timestamp")
    history = rows.where(bought).select("device_type", "timestamp", F.col("price").alias("last_price"))
    out = links.as_of_join(points, history, ["device_type"], "timestamp", "last_price")
    return out.select("event_id", "event_type", "last_price")


RATE = f"""ends AS (SELECT arg_max(metric_value, recorded_at) AS latest, max(recorded_at) AS latest_at,
    arg_max(metric_value, recorded_at) FILTER (WHERE recorded_at <= {AS_OF_SQL} - INTERVAL 6 HOUR) AS previous,
    max(recorded_at) FILTER (WHERE recorded_at <= {AS_OF_SQL} - INTERVAL 6 HOUR) AS previous_at
  FROM metrics WHERE metric_name = 'pipeline.events.total')"""


@query("SELECT 'pipeline.events.total' AS metric_name, (latest - previous) / 21600 AS rate_per_sec FROM ends", (*M, RATE))
def metric_rate(spark, d):
    return mart.metric_rate(metric_history(spark, d), "pipeline.events.total", timedelta(hours=6), AS_OF)


@query(
    "SELECT 'pipeline.events.total' AS metric_name, (latest - previous) / CAST(epoch(latest_at - previous_at) AS DOUBLE) AS rate_per_sec FROM ends",
    (*M, RATE),
)
def metric_rate_exact(spark, d):
    return mart.metric_rate(metric_history(spark, d), "pipeline.events.total", timedelta(hours=6), AS_OF, exact=True)


@query(
    f"""SELECT pipeline_name, count(*) FILTER (WHERE status = 'success') AS successful_runs,
      count(*) FILTER (WHERE status = 'failed') AS failed_runs, count(*) FILTER (WHERE status = 'running') AS running_runs,
      avg(duration_seconds) FILTER (WHERE status = 'success') AS avg_duration_sec, max(started_at) AS last_run_time
    FROM runs WHERE started_at > {AS_OF_SQL} - INTERVAL 24 HOUR GROUP BY 1""",
    (RUNS,),
)
def run_health(spark, d):
    return mart.run_health(runs(spark, d), AS_OF)


@query("SELECT run_id, CAST(epoch(completed_at - started_at) AS BIGINT) AS seconds FROM runs", (RUNS,))
def run_durations(spark, d):
    return runs(spark, d).select("run_id", run_duration(F.col("started_at"), F.col("completed_at")).alias("seconds"))


@query(
    """SELECT r.run_id, r.status, count(*) AS checks, count(*) FILTER (WHERE NOT passed) AS failed_checks,
      count(*) FILTER (WHERE NOT passed) = 0 AS gate_passed
    FROM runs r JOIN (SELECT 'run_' || strftime("timestamp", '%Y%m%d%H') AS run_id, price <= 200 AS passed FROM silver) c ON r.run_id = c.run_id
    GROUP BY 1, 2""",
    (SILVER, RUNS),
)
def runs_with_gate(spark, d):
    """Every event is read as one check of its hour's run."""
    checks = silver(spark, d).select(
        F.concat(F.lit("run_"), F.date_format("timestamp", "yyyyMMddHH")).alias("run_id"), (F.col("price") <= 200).alias("passed")
    )
    return links.attach_gate(runs(spark, d).select("run_id", "status"), checks)


@query(
    f"""SELECT alert_name, severity, message, actual_value, threshold_value, triggered_at,
      CAST(epoch({AS_OF_SQL} - triggered_at) AS BIGINT) AS age_seconds FROM alerts WHERE status = 'firing'""",
    (SILVER, CHECKS, ALERTS),
)
def active_alerts(spark, d):
    return mart.active_alerts(alerts(spark, d), AS_OF)


@query(f"SELECT event_id, CAST(floor(epoch({AS_OF_SQL} - \"timestamp\")) AS BIGINT) AS age_seconds FROM silver", (SILVER,))
def event_ages(spark, d):
    return silver(spark, d).select("event_id", age_seconds(F.col("timestamp"), AS_OF).alias("age_seconds"))


OPEN = "SELECT check_name, status, failure_rate, records_failed, checked_at FROM checks WHERE status <> 'passed'"


@query(OPEN, (SILVER, CHECKS))
def open_checks(spark, d):
    return mart.open_checks(check_history(spark, d))


@query(
    f"""SELECT check_name, status, count(*) AS n, max(checked_at) AS newest FROM
    (SELECT *, dense_rank() OVER (ORDER BY checked_at DESC) AS rk FROM checks WHERE status <> 'passed') c WHERE rk = 1 GROUP BY 1, 2""",
    (SILVER, CHECKS),
)
def newest_open_checks(spark, d):
    """Every open check of the newest time."""
    newest = mart.newest_open_checks(check_history(spark, d))
    return newest.groupBy("check_name", "status").agg(F.count("*").alias("n"), F.max("checked_at").alias("newest"))


# ---- panels ---------------------------------------------------------------------


class Mart:
    """The mart's tables, each built when a panel asks for it."""

    TABLES = {"metrics": metric_history, "runs": runs, "checks": check_history, "alerts": alerts, "resources": resources}

    def __init__(self, spark, sf_dir):
        self.source = (spark, sf_dir)

    def __getitem__(self, name):
        return self.TABLES[name](*self.source)


def _newest(name: str) -> str:
    return f"SELECT arg_max(metric_value, recorded_at) AS metric_value FROM metrics WHERE metric_name = '{name}'"


@query(_newest("pipeline.events.total"), M)
def panel_events_total(spark, d):
    return mart.panel("events_total", Mart(spark, d), AS_OF)


@query(_newest("pipeline.events.rate"), M)
def panel_event_rate(spark, d):
    return mart.panel("event_rate", Mart(spark, d), AS_OF)


@query(_newest("business.conversion.overall"), M)
def panel_conversion(spark, d):
    return mart.panel("conversion", Mart(spark, d), AS_OF)


@query("SELECT count(*) AS count FROM alerts WHERE status = 'firing'", (SILVER, CHECKS, ALERTS))
def panel_alert_count(spark, d):
    return mart.panel("alert_count", Mart(spark, d), AS_OF)


@query(
    f"""SELECT recorded_at AS time, metric_value AS value FROM metrics WHERE metric_name = 'pipeline.events.total'
    AND recorded_at > {AS_OF_SQL} - INTERVAL 24 HOUR""",
    M,
)
def panel_events_over_time(spark, d):
    return mart.panel("events_over_time", Mart(spark, d), AS_OF)


@query(
    f"""SELECT tag AS metric, max(metric_value) AS value FROM metrics WHERE metric_name = 'pipeline.events.by_type'
    AND recorded_at > {AS_OF_SQL} - INTERVAL 1 HOUR GROUP BY 1""",
    M,
)
def panel_events_by_type(spark, d):
    return mart.panel("events_by_type", Mart(spark, d), AS_OF)


@query(
    f"""SELECT substr(metric_name, 17) AS metric, max(metric_value) AS value FROM metrics WHERE metric_name LIKE 'business.funnel.%'
    AND recorded_at > {AS_OF_SQL} - INTERVAL 1 HOUR GROUP BY 1""",
    M,
)
def panel_funnel(spark, d):
    return mart.panel("funnel", Mart(spark, d), AS_OF)


@query(
    f"""SELECT CAST(count(*) FILTER (WHERE status = 'success') AS DOUBLE) / nullif(count(*), 0) * 100 AS value FROM runs
    WHERE started_at > {AS_OF_SQL} - INTERVAL 24 HOUR""",
    (RUNS,),
)
def panel_success_rate(spark, d):
    return mart.panel("success_rate", Mart(spark, d), AS_OF)


@query(
    f"""SELECT avg(duration_seconds) AS value FROM runs WHERE status = 'success' AND started_at > {AS_OF_SQL} - INTERVAL 24 HOUR""",
    (RUNS,),
)
def panel_mean_duration(spark, d):
    return mart.panel("mean_duration", Mart(spark, d), AS_OF)


@query(
    f"""SELECT check_name, count(*) AS n, CAST(sum(records_failed) AS BIGINT) AS failed FROM checks
    WHERE checked_at > {AS_OF_SQL} - INTERVAL 24 HOUR GROUP BY 1""",
    (SILVER, CHECKS),
)
def panel_recent_checks(spark, d):
    """Last checks of the day; six fall into the window, so the panel's ten rows hold them all."""
    rows = mart.panel("recent_checks", Mart(spark, d), AS_OF)
    return rows.groupBy("check_name").agg(F.count("*").alias("n"), F.sum("records_failed").alias("failed"))


def _series(kind: str) -> str:
    return f"""SELECT recorded_at AS time, CAST(sum(CAST(metric_value AS DECIMAL(28,10))) AS DOUBLE) / count(metric_value) AS value FROM resources
    WHERE resource_type = '{kind}' AND recorded_at > {AS_OF_SQL} - INTERVAL 1 HOUR GROUP BY 1"""


@query(_series("cpu"), (SILVER, RESOURCES))
def panel_cpu(spark, d):
    return mart.panel("cpu", Mart(spark, d), AS_OF)


@query(_series("memory"), (SILVER, RESOURCES))
def panel_memory(spark, d):
    return mart.panel("memory", Mart(spark, d), AS_OF)


@query(
    """SELECT pipeline_name, status, duration_seconds, events_processed, events_failed, started_at FROM runs
    ORDER BY started_at DESC, run_id LIMIT 10""",
    (RUNS,),
)
def panel_recent_runs(spark, d):
    return mart.panel("recent_runs", Mart(spark, d), AS_OF)


# ---- bands, alert rules, targets ---------------------------------------------------


@query(
    """SELECT metric_name, metric_value, CASE metric_name
      WHEN 'pipeline.events.rate' THEN CASE WHEN metric_value < 10 THEN 'critical' WHEN metric_value < 40 THEN 'warning' ELSE 'normal' END
      WHEN 'business.conversion.overall' THEN CASE WHEN metric_value < 2 THEN 'critical' WHEN metric_value < 4 THEN 'warning' ELSE 'normal' END
      WHEN 'pipeline.success.rate' THEN CASE WHEN metric_value < 95 THEN 'critical' WHEN metric_value < 99 THEN 'warning' ELSE 'normal' END
      WHEN 'pipeline.run.duration' THEN CASE WHEN metric_value > 600 THEN 'critical' WHEN metric_value > 300 THEN 'warning' ELSE 'normal' END
      END AS band
    FROM (SELECT metric_name, metric_value FROM metrics
      UNION ALL SELECT 'pipeline.run.duration', CAST(duration_seconds AS DOUBLE) FROM runs WHERE duration_seconds IS NOT NULL
      UNION ALL SELECT 'pipeline.success.rate', 100 - CAST(events_failed AS DOUBLE) FROM runs) v""",
    (*M, RUNS),
)
def threshold_bands(spark, d):
    values = metric_history(spark, d).select("metric_name", "metric_value")
    lengths = runs(spark, d).where("duration_seconds is not null").select(
        F.lit("pipeline.run.duration"), F.col("duration_seconds").cast("double")
    )
    rates = runs(spark, d).select(F.lit("pipeline.success.rate"), 100 - F.col("events_failed").cast("double"))
    return mart.band(values.union(lengths).union(rates))


def _signals(spark, d):
    """Hourly figures that the alert rules look at."""
    hourly = metric_history(spark, d).select("metric_name", "metric_value", "recorded_at")
    rows = runs(spark, d)
    ended = F.col("started_at") + F.lit(timedelta(hours=1))
    failed = rows.select(F.lit("pipeline.runs.failed"), F.when(F.col("status") == "failed", 1.0).otherwise(0.0), ended)
    errors = rows.select(F.lit("pipeline.error.rate"), F.col("events_failed") * 100 / F.col("events_processed"), ended)
    return hourly.union(failed).union(errors)


SIGNALS = """signals AS (SELECT metric_name, metric_value, recorded_at FROM metrics
  UNION ALL SELECT 'pipeline.runs.failed', CASE WHEN status = 'failed' THEN 1.0 ELSE 0.0 END, started_at + INTERVAL 1 HOUR FROM runs
  UNION ALL SELECT 'pipeline.error.rate', CAST(events_failed * 100 AS DOUBLE) / events_processed, started_at + INTERVAL 1 HOUR FROM runs)"""


def _rule_sql(name, severity, metric, agg, op, threshold, minutes) -> str:
    value = f"{agg}(metric_value)" if agg != "count" else "CAST(count(metric_value) AS DOUBLE)"
    return f"""SELECT '{name}' AS alert_name, '{severity}' AS severity, '{metric}' AS metric_name, CAST({threshold} AS DOUBLE) AS threshold_value,
      CAST({value} AS DOUBLE) AS actual_value, CASE WHEN coalesce({value} {op} {threshold}, FALSE) THEN 'firing' ELSE 'resolved' END AS status
    FROM signals WHERE metric_name = '{metric}' AND recorded_at > {AS_OF_SQL} - INTERVAL {minutes} MINUTE AND recorded_at <= {AS_OF_SQL}"""


@query(
    "\nUNION ALL\n".join([
        _rule_sql("low_event_rate", "warning", "pipeline.events.rate", "max", "<", 10, 5),
        _rule_sql("failed_run", "warning", "pipeline.runs.failed", "sum", ">", 0, 60),
        _rule_sql("error_rate", "warning", "pipeline.error.rate", "min", ">", 5, 15),
        _rule_sql("no_events", "critical", "pipeline.events.total", "count", "=", 0, 10),
    ]),
    (*M, RUNS, SIGNALS),
)
def alert_rules(spark, d):
    return mart.evaluate_alerts(_signals(spark, d), mart.ALERT_RULES, AS_OF)


#: Moments of the given data at which the rules are evaluated besides the last one: some fire, some do not.
MOMENTS = tuple(datetime(2024, 1, 2, 5) + timedelta(hours=31 * k) for k in range(18))


def _rules_at(moment: datetime) -> str:
    at = f"TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S}'"
    rules = [
        ("low_event_rate", "pipeline.events.rate", "max(metric_value) < 10", 5), ("failed_run", "pipeline.runs.failed", "sum(metric_value) > 0", 60),
        ("error_rate", "pipeline.error.rate", "min(metric_value) > 5", 15), ("no_events", "pipeline.events.total", "count(metric_value) = 0", 10),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT {at} AS moment, '{name}' AS alert_name, CASE WHEN coalesce({fires}, FALSE) THEN 'firing' ELSE 'resolved' END AS status FROM signals "
        f"WHERE metric_name = '{metric}' AND recorded_at > {at} - INTERVAL {minutes} MINUTE AND recorded_at <= {at}"
        for name, metric, fires, minutes in rules
    )


@query("\nUNION ALL\n".join(_rules_at(m) for m in MOMENTS), (*M, RUNS, SIGNALS))
def alert_rules_over_time(spark, d):
    """The verdict of every rule at several moments."""
    signals = _signals(spark, d)
    frames = [mart.evaluate_alerts(signals, mart.ALERT_RULES, m).select(F.lit(m).cast("timestamp_ntz").alias("moment"), "alert_name", "status") for m in MOMENTS]
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


@query(
    f"""SELECT metric_name, metric_value, recorded_at FROM (
      SELECT *, started_at + duration_seconds * INTERVAL 1 SECOND AS ended FROM runs WHERE status IN ('success', 'failed')) r,
      LATERAL (SELECT unnest(['pipeline.runs.failed', 'pipeline.run.duration', 'pipeline.error.rate']) AS metric_name,
        unnest([CASE WHEN status = 'failed' THEN 1.0::DOUBLE ELSE 0.0 END, CAST(duration_seconds AS DOUBLE),
          CAST(events_failed AS DOUBLE) * 100 / (events_processed + events_failed)]) AS metric_value, unnest([ended, ended, ended]) AS recorded_at) m
      WHERE ended <= {AS_OF_SQL} AND ended > {AS_OF_SQL} - INTERVAL 24 HOUR
    UNION ALL SELECT 'pipeline.success.rate', CAST(count(*) FILTER (WHERE status = 'success') AS DOUBLE) / count(*) * 100, {AS_OF_SQL} FROM runs
      WHERE status IN ('success', 'failed') AND started_at + duration_seconds * INTERVAL 1 SECOND <= {AS_OF_SQL}
      AND started_at + duration_seconds * INTERVAL 1 SECOND > {AS_OF_SQL} - INTERVAL 24 HOUR HAVING count(*) > 0""",
    (RUNS,),
)
def run_metrics(spark, d):
    """Figures of the runs that the rules, bands and targets read."""
    rows = mart.run_metrics(runs(spark, d), AS_OF)
    return rows.select("metric_name", "metric_value", F.col("recorded_at").cast("timestamp_ntz").alias("recorded_at"))


@query(
    f"""SELECT metric_name, count(*) AS windows, count(*) FILTER (WHERE met) AS met, CAST(count(*) FILTER (WHERE met) AS DOUBLE) / count(*) * 100 AS attained_pct
    FROM (SELECT metric_name, CASE metric_name WHEN 'availability_pct' THEN mean >= 99.5 WHEN 'error_rate_pct' THEN mean <= 1 WHEN 'latency_p95' THEN mean <= 15 ELSE mean >= 99 END AS met
      FROM (SELECT metric_name, CASE WHEN metric_name = 'error_rate_pct' THEN date_trunc('hour', recorded_at) ELSE date_trunc('day', recorded_at) END AS w,
          CAST(sum(CAST(metric_value AS DECIMAL(28,10))) AS DOUBLE) / count(metric_value) AS mean
        FROM (SELECT 'availability_pct' AS metric_name, CASE WHEN status = 'failed' THEN 0.0 ELSE 100.0 END AS metric_value, started_at AS recorded_at FROM runs
          UNION ALL SELECT 'error_rate_pct', CAST(events_failed * 100 AS DOUBLE) / events_processed, started_at FROM runs
          UNION ALL SELECT 'latency_p95', CAST(events_processed AS DOUBLE), started_at FROM runs
          UNION ALL SELECT 'valid_rows_pct', metric_value, recorded_at FROM metrics WHERE metric_name = 'pipeline.quality.score') s
        GROUP BY 1, 2) m) t GROUP BY 1""",
    (*M, RUNS),
)
def slo_attainment(spark, d):
    rows = runs(spark, d)
    available = rows.select(F.lit("availability_pct").alias("metric_name"), F.when(F.col("status") == "failed", 0.0).otherwise(100.0).alias("metric_value"), F.col("started_at").alias("recorded_at"))
    errors = rows.select(F.lit("error_rate_pct"), F.col("events_failed") * 100 / F.col("events_processed"), "started_at")
    valid = metric_history(spark, d).where("metric_name = 'pipeline.quality.score'").select(F.lit("valid_rows_pct"), "metric_value", "recorded_at")
    delays = rows.select(F.lit("latency_p95"), F.col("events_processed").cast("double"), "started_at")
    return mart.slo(available.union(errors).union(delays).union(valid))


BUSINESS = """business AS (SELECT 'business.revenue.total' AS metric_name, CAST(sum(CAST(round(price * 100) AS BIGINT)) AS DOUBLE) / 100 AS metric_value,
    'device_type' AS dimension, device_type AS dimension_value, 'day' AS time_period, date_trunc('day', "timestamp") AS period_start
  FROM silver GROUP BY device_type, date_trunc('day', "timestamp"))"""


def _business(spark, d):
    return mart.business_rows(silver(spark, d), "business.revenue.total", "device_type", "day", F.col("price"))


@query("SELECT * FROM business", (SILVER, BUSINESS))
def business_metrics(spark, d):
    return _business(spark, d)


@query("SELECT CAST(sum(CAST(round(metric_value * 100) AS BIGINT)) AS DOUBLE) / 100 AS total FROM business", (SILVER, BUSINESS))
def revenue_total(spark, d):
    return mart.metric_total(_business(spark, d), "business.revenue.total")


def _status_sql(by: str) -> str:
    return f"""SELECT {by}, count(*) AS checks, count(*) FILTER (WHERE status = 'passed') AS passed, count(*) FILTER (WHERE status = 'warning') AS warning,
      count(*) FILTER (WHERE status = 'failed') AS failed, CAST(count(*) FILTER (WHERE status = 'passed') AS DOUBLE) / count(*) * 100 AS pass_rate
    FROM checks GROUP BY {by}"""


@query(_status_sql("dataset"), (SILVER, CHECKS))
def check_status_by_dataset(spark, d):
    return mart.check_status(check_history(spark, d), ["dataset"])


@query(
    "SELECT CAST(checked_at AS DATE) AS day, CAST(sum(records_failed) AS BIGINT) AS failed, CAST(sum(records_checked) AS BIGINT) AS checked FROM checks WHERE check_name = 'error_share' GROUP BY 1",
    (SILVER, CHECKS),
)
def failed_rows_trend(spark, d):
    rows = check_history(spark, d).where("check_name = 'error_share'")
    return rows.groupBy(F.to_date("checked_at").alias("day")).agg(F.sum("records_failed").alias("failed"), F.sum("records_checked").alias("checked"))


@query(
    f"SELECT CAST(count(*) FILTER (WHERE status = 'passed') AS DOUBLE) / count(*) * 100 AS pass_rate FROM checks WHERE checked_at > {AS_OF_SQL} - INTERVAL 24 HOUR",
    (SILVER, CHECKS),
)
def recent_pass_rate(spark, d):
    return mart.recent_pass_rate(check_history(spark, d), AS_OF)


@query("SELECT metric_name, count(*) AS n FROM metrics GROUP BY 1", M)
def metric_row_counts(spark, d):
    return agg.row_counts(metric_history(spark, d), "metric_name")


@query(
    """SELECT device_type, count(*) AS samples, CAST(sum(k * 60) AS DOUBLE) / count(*) AS mean_latency,
      list_sort(list(k * 60))[CAST(floor(count(*) * 0.95) AS BIGINT) + 1] AS p_latency
    FROM (SELECT device_type, CAST(k AS BIGINT) AS k FROM silver) s GROUP BY 1""",
    (SILVER,),
)
def latency_summary(spark, d):
    """Event time to broker time, per device."""
    rows = silver(spark, d).withColumn("arrived", F.col("timestamp") + F.make_dt_interval(mins=F.col("k")))
    return agg.latency_summary(rows, "timestamp", "arrived", ["device_type"])


@query(
    """SELECT count(*) AS samples, CAST(sum(k * 60) AS DOUBLE) / count(*) AS mean_latency,
      list_sort(list(k * 60))[CAST(floor(count(*) * 0.95) AS BIGINT) + 1] AS p_latency FROM (SELECT CAST(k AS BIGINT) AS k FROM silver) s""",
    (SILVER,),
)
def latency_of_all(spark, d):
    """Event time to broker time, over all rows."""
    rows = silver(spark, d).withColumn("arrived", F.col("timestamp") + F.make_dt_interval(mins=F.col("k")))
    return agg.latency_summary(rows, "timestamp", "arrived")


# ---- episodes of alerts ---------------------------------------------------------

VERDICTS = """verdicts AS (SELECT device_type AS alert_name, date_trunc('hour', "timestamp") AS triggered_at, CAST(count(*) AS DOUBLE) AS actual_value, count(*) > 5 AS firing
    FROM silver GROUP BY 1, 2),
spells AS (SELECT *, sum(CASE WHEN firing AND NOT was THEN 1 ELSE 0 END) OVER (PARTITION BY alert_name ORDER BY triggered_at) AS episode FROM
    (SELECT *, coalesce(lag(firing) OVER (PARTITION BY alert_name ORDER BY triggered_at), FALSE) AS was FROM verdicts) v),
episodes AS (SELECT alert_name, CAST(episode AS BIGINT) AS episode, CASE WHEN max(CASE WHEN NOT firing THEN 1 END) IS NULL THEN 'firing' ELSE 'resolved' END AS status,
    min(triggered_at) FILTER (WHERE firing) AS triggered_at, max(triggered_at) FILTER (WHERE firing) AS last_fired_at,
    min(triggered_at) FILTER (WHERE NOT firing) AS resolved_at, count(*) FILTER (WHERE firing) AS evaluations,
    arg_max(actual_value, triggered_at) FILTER (WHERE firing) AS actual_value
  FROM spells WHERE firing OR was GROUP BY 1, 2)"""


def _verdicts(spark, d):
    """A rule per device, judged every hour that has events: more than five of them fire."""
    hours = silver(spark, d).groupBy(F.col("device_type").alias("alert_name"), F.date_trunc("hour", "timestamp").alias("triggered_at")).agg(F.count("*").cast("double").alias("actual_value"))
    status = F.when(F.col("actual_value") > 5, "firing").otherwise("resolved")
    return hours.select("alert_name", F.lit("warning").alias("severity"), status.alias("status"), F.lit("busy").alias("message"), "actual_value", F.lit(5.0).alias("threshold_value"), "triggered_at")


@query("SELECT * FROM episodes", (SILVER, VERDICTS))
def alert_episodes(spark, d):
    return mart.alert_episodes(_verdicts(spark, d)).drop("severity", "message", "threshold_value")


@query(
    f"""SELECT alert_name, 'warning' AS severity, 'busy' AS message, actual_value, CAST(5 AS DOUBLE) AS threshold_value, triggered_at,
      CAST(epoch({AS_OF_SQL} - triggered_at) AS BIGINT) AS age_seconds FROM episodes WHERE status = 'firing'""",
    (SILVER, VERDICTS),
)
def active_alert_episodes(spark, d):
    """Alerts that still fire, with the age of their episode."""
    return mart.active_alerts(mart.alert_episodes(_verdicts(spark, d)), AS_OF)
