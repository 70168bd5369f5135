"""Metrics mart: snapshot, health, rates, panels, bands, alerts, targets."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.functions.columns import age_seconds, exact_mean, later_than, money_sum, percent, since, strip_prefix, tag
from rillmark.functions.ordered import with_previous, with_running
from rillmark.schemas import SEVERITIES

DAY, HOUR = timedelta(hours=24), timedelta(hours=1)
FUNNEL_PREFIX = "business.funnel."


def last_per_key(df: DataFrame, keys: list[str], ts: str, tie: list[str] | None = None) -> DataFrame:
    """The newest row of every key; of several with one time the largest by ``tie``, by default by all other columns.

    An aggregate, so rows of one key shrink before the shuffle. Map columns have no order and do not break ties.
    """
    rest = [c for c in df.columns if c not in keys]
    kinds = dict(df.dtypes)
    ties = [c for c in (rest if tie is None else tie) if c != ts and "map<" not in kinds[c]]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(ts, *ties)).alias("_r"))
    return newest.select(*keys, "_r.*").select(*df.columns)


def latest_metrics(metrics: DataFrame) -> DataFrame:
    return last_per_key(metrics, ["metric_name"], "recorded_at")


def metric_rate(metrics: DataFrame, name: str, interval: timedelta, as_of: datetime, exact: bool = False) -> DataFrame:
    """Change per second between the newest value and the last one an interval ago.

    Null without an earlier point. ``exact`` divides by the real distance of the
    two points, else by the interval asked for.
    """
    old = F.col("recorded_at") <= F.lit(as_of) - F.lit(interval)
    value, at = F.col("metric_value"), F.col("recorded_at")
    ends = metrics.where(F.col("metric_name") == name).agg(
        F.max_by(value, at).alias("latest"),
        F.max(at).alias("latest_at"),
        F.max_by(value, F.when(old, at)).alias("previous"),
        F.max(F.when(old, at)).alias("previous_at"),
    )
    seconds = F.timestamp_diff("SECOND", F.col("previous_at"), F.col("latest_at")) if exact else F.lit(interval.total_seconds())
    return ends.select(
        F.lit(name).alias("metric_name"),
        F.try_divide(F.col("latest") - F.col("previous"), seconds.cast("double")).alias("rate_per_sec"),
    )


def run_health(runs: DataFrame, as_of: datetime) -> DataFrame:
    """Counts by status, mean length of successes and last start, over 24 hours."""
    status = F.col("status")
    ok = status == "success"
    return (
        since(runs, "started_at", DAY, as_of)
        .groupBy("pipeline_name")
        .agg(
            F.count_if(ok).alias("successful_runs"),
            F.count_if(status == "failed").alias("failed_runs"),
            F.count_if(status == "running").alias("running_runs"),
            F.avg(F.when(ok, F.col("duration_seconds"))).alias("avg_duration_sec"),
            F.max("started_at").alias("last_run_time"),
        )
    )


def severity_rank(severity: Column) -> Column:
    rank = F.lit(len(SEVERITIES))
    for position, name in reversed(list(enumerate(SEVERITIES))):
        rank = F.when(severity == name, position).otherwise(rank)
    return rank


def alert_rows(verdicts: DataFrame, as_of: datetime) -> DataFrame:
    """Verdicts of the rules as rows of the alert table."""
    limit = F.concat_ws(" ", "metric_name", F.lit("is"), F.coalesce(F.col("actual_value").cast("string"), F.lit("missing")), F.lit("against"), "threshold_value")
    return verdicts.select(
        "alert_name", "severity", "status", limit.alias("message"), "actual_value", "threshold_value", F.lit(as_of).alias("triggered_at"),
    )


def run_metrics(runs: DataFrame, as_of: datetime) -> DataFrame:
    """Figures that alert rules, bands and targets read, from the runs that ended in the 24 hours before ``as_of``.

    Each ended run gives its failure (1 or 0), its length and its share of rejected events at the
    moment it ended; the success rate is one figure at ``as_of``.
    """
    ended = runs.where((F.col("completed_at") <= F.lit(as_of)) & later_than(F.col("completed_at"), as_of, DAY) & F.col("status").isin("success", "failed"))
    failed = (F.col("status") == "failed").cast("double")
    share = F.try_divide(F.col("events_failed").cast("double") * 100, (F.col("events_processed") + F.col("events_failed")).cast("double"))
    row = lambda name, value, unit: F.struct(F.lit(name).alias("metric_name"), value.alias("metric_value"), F.lit(unit).alias("metric_unit"))
    each = F.array(
        row("pipeline.runs.failed", failed, "runs"),
        row("pipeline.run.duration", F.col("duration_seconds").cast("double"), "seconds"),
        row("pipeline.error.rate", share, "percent"),
    )
    nothing = F.lit(None).cast("map<string,string>")
    tags = F.create_map(F.lit("run_id"), F.col("run_id"))
    single = ended.select(F.inline(each), tags.alias("tags"), F.col("completed_at").cast("timestamp").alias("recorded_at")).where("metric_value is not null")
    rate = ended.agg(percent(F.count_if(F.col("status") == "success"), F.count("*")).alias("metric_value")).where("metric_value is not null")
    whole = rate.select(F.lit("pipeline.success.rate").alias("metric_name"), "metric_value", F.lit("percent").alias("metric_unit"), nothing.alias("tags"), F.lit(as_of).cast("timestamp").alias("recorded_at"))
    return single.unionByName(whole)


def alert_episodes(verdicts: DataFrame) -> DataFrame:
    """One row per spell of an alert, from its verdicts over time: opened at its first firing, resolved at the first verdict that is not.

    ``triggered_at`` of a verdict is the time of its evaluation; of an episode it is the time
    it opened. Severity, message and values are those of its last firing, ``evaluations``
    counts its firings. An episode that has not been resolved is ``firing``, others are
    ``resolved``. A verdict that came twice for one time counts once, as firing if one is.
    """
    firing = F.col("status") == "firing"
    once = verdicts.groupBy("alert_name", "triggered_at").agg(
        F.max_by(F.struct("severity", "message", "actual_value", "threshold_value"), firing).alias("_said"), F.max(firing).alias("_firing")
    )
    seen = with_previous(once, ["alert_name"], "triggered_at", [], {"_was": "_firing"})
    was = F.coalesce("_was", F.lit(False))
    opens = (F.col("_firing") & ~was).cast("int")
    spells = with_running(seen.withColumns({"_opens": opens, "_ends": ~F.col("_firing") & was}), ["alert_name"], "triggered_at", [], {"episode": ("sum", "_opens")})
    fired = F.when(F.col("_firing"), F.col("triggered_at"))
    out = spells.where(F.col("_firing") | F.col("_ends")).groupBy("alert_name", "episode").agg(
        F.max_by("_said", fired).alias("_said"), F.min(fired).alias("triggered_at"), F.max(fired).alias("last_fired_at"),
        F.min(F.when(F.col("_ends"), F.col("triggered_at"))).alias("resolved_at"), F.count_if("_firing").alias("evaluations"),
    )
    status = F.when(F.col("resolved_at").isNull(), "firing").otherwise("resolved")
    return out.select("alert_name", "episode", "_said.*", status.alias("status"), "triggered_at", "last_fired_at", "resolved_at", "evaluations")


def active_alerts(alerts: DataFrame, as_of: datetime) -> DataFrame:
    """Firing alerts with their age, most severe and newest first."""
    return (
        alerts.where(F.col("status") == "firing")
        .select(
            "alert_name", "severity", "message", "actual_value", "threshold_value", "triggered_at",
            age_seconds(F.col("triggered_at"), as_of).alias("age_seconds"),
        )
        .orderBy(severity_rank(F.col("severity")), F.desc("triggered_at"), "alert_name")
    )


def newest_open_checks(checks: DataFrame) -> DataFrame:
    """All checks that did not pass at the newest time any did not."""
    found = checks.where(F.col("status") != "passed")
    newest = found.agg(F.max("checked_at").alias("_newest"))
    return found.join(F.broadcast(newest), F.col("checked_at") == F.col("_newest")).drop("_newest")  # one row


def open_checks(checks: DataFrame, n: int | None = None) -> DataFrame:
    """Checks that did not pass, newest first."""
    out = (
        checks.where(F.col("status") != "passed")
        .select("check_name", "status", "failure_rate", "records_failed", "checked_at")
        .orderBy(F.desc("checked_at"), "check_name")
    )
    return out if n is None else out.limit(n)


# ---- dashboard panels -----------------------------------------------------------


def single_value(metrics: DataFrame, name: str) -> DataFrame:
    """Newest value of one metric."""
    return latest_metrics(metrics.where(F.col("metric_name") == name)).select("metric_value")


def events_over_time(metrics: DataFrame, as_of: datetime) -> DataFrame:
    rows = since(metrics.where(F.col("metric_name") == "pipeline.events.total"), "recorded_at", DAY, as_of)
    return rows.select(F.col("recorded_at").alias("time"), F.col("metric_value").alias("value")).orderBy("time")


def events_by_type(metrics: DataFrame, as_of: datetime) -> DataFrame:
    rows = since(metrics.where(F.col("metric_name") == "pipeline.events.by_type"), "recorded_at", HOUR, as_of)
    return _max_per(rows, tag(F.col("tags"), "event_type"))


def funnel_panel(metrics: DataFrame, as_of: datetime) -> DataFrame:
    rows = since(metrics.where(F.startswith("metric_name", F.lit(FUNNEL_PREFIX))), "recorded_at", HOUR, as_of)
    return _max_per(rows, strip_prefix(F.col("metric_name"), FUNNEL_PREFIX))


def _max_per(rows: DataFrame, label: Column) -> DataFrame:
    return rows.groupBy(label.alias("metric")).agg(F.max("metric_value").alias("value")).orderBy(F.desc("value"), "metric")


def run_success_rate(runs: DataFrame, as_of: datetime) -> DataFrame:
    ok = F.count_if(F.col("status") == "success")
    return since(runs, "started_at", DAY, as_of).agg(percent(ok, F.count("*")).alias("value"))


def mean_run_duration(runs: DataFrame, as_of: datetime) -> DataFrame:
    ok = F.col("status") == "success"
    return since(runs, "started_at", DAY, as_of).agg(F.avg(F.when(ok, F.col("duration_seconds"))).alias("value"))


def recent_checks(checks: DataFrame, as_of: datetime, n: int = 10) -> DataFrame:
    return (
        since(checks, "checked_at", DAY, as_of)
        .select("check_name", "status", "failure_rate", "records_failed", "checked_at")
        .orderBy(F.desc("checked_at"), "check_name")
        .limit(n)
    )


def resource_series(resources: DataFrame, kind: str, as_of: datetime) -> DataFrame:
    """Mean of a resource per instant over the last hour."""
    rows = since(resources.where(F.col("resource_type") == kind), "recorded_at", HOUR, as_of)
    return rows.groupBy(F.col("recorded_at").alias("time")).agg(exact_mean(F.col("metric_value")).alias("value")).orderBy("time")


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    columns = ["pipeline_name", "status", "duration_seconds", "events_processed", "events_failed", "started_at"]
    return runs.orderBy(F.desc("started_at"), "run_id").select(*columns).limit(n)


PANELS = {
    "events_total": lambda m, t: single_value(m["metrics"], "pipeline.events.total"),
    "event_rate": lambda m, t: single_value(m["metrics"], "pipeline.events.rate"),
    "conversion": lambda m, t: single_value(m["metrics"], "business.conversion.overall"),
    "alert_count": lambda m, t: m["alerts"].where("status = 'firing'").agg(F.count("*").alias("count")),
    "events_over_time": lambda m, t: events_over_time(m["metrics"], t),
    "events_by_type": lambda m, t: events_by_type(m["metrics"], t),
    "funnel": lambda m, t: funnel_panel(m["metrics"], t),
    "success_rate": lambda m, t: run_success_rate(m["runs"], t),
    "mean_duration": lambda m, t: mean_run_duration(m["runs"], t),
    "recent_checks": lambda m, t: recent_checks(m["checks"], t),
    "cpu": lambda m, t: resource_series(m["resources"], "cpu", t),
    "memory": lambda m, t: resource_series(m["resources"], "memory", t),
    "recent_runs": lambda m, t: recent_runs(m["runs"]),
}


def panel(name: str, mart: dict[str, DataFrame], as_of: datetime) -> DataFrame:
    """One dashboard panel over the mart's tables ``metrics, runs, checks, alerts, resources``."""
    return PANELS[name](mart, as_of)


# ---- bands, alert rules, targets ------------------------------------------------

# --- fixed values: metric -> (critical below, warning below); a negative pair reads "above" instead.
THRESHOLDS = {
    "pipeline.events.rate": (10.0, 40.0),
    "business.conversion.overall": (2.0, 4.0),
    "pipeline.success.rate": (95.0, 99.0),
    "pipeline.run.duration": (-600.0, -300.0),
}


def band(values: DataFrame, thresholds: dict[str, tuple[float, float]] = THRESHOLDS) -> DataFrame:
    """critical / warning / normal for metrics with thresholds; other metrics have no band."""
    value = F.col("metric_value")
    level = F.lit(None).cast("string")
    for name, (critical, warning) in thresholds.items():
        measure = -value if critical < 0 else value
        bands = F.when(measure < critical, "critical").when(measure < warning, "warning").otherwise("normal")
        level = F.when(F.col("metric_name") == name, bands).otherwise(level)
    return values.select("metric_name", "metric_value", level.alias("band"))


@dataclass(frozen=True)
class AlertRule:
    """A limit on a metric over the trailing ``hold``.

    ``below`` and ``above`` fire when every point is beyond the limit, ``any_above`` when
    the sum of the points is, as for counts of failures, ``no_data`` when there is no point.
    """

    alert_name: str
    severity: str
    metric_name: str
    when: str  # "below", "above", "any_above" or "no_data"
    threshold: float
    hold: timedelta


# --- fixed values: the alert rules.
ALERT_RULES = (
    AlertRule("low_event_rate", "warning", "pipeline.events.rate", "below", 10, timedelta(minutes=5)),
    AlertRule("failed_run", "warning", "pipeline.runs.failed", "any_above", 0, timedelta(hours=1)),
    AlertRule("error_rate", "warning", "pipeline.error.rate", "above", 5, timedelta(minutes=15)),
    AlertRule("no_events", "critical", "pipeline.events.total", "no_data", 0, timedelta(minutes=10)),
)


def evaluate_alerts(metrics: DataFrame, rules: tuple[AlertRule, ...], as_of: datetime) -> DataFrame:
    """Every rule with its verdict, from one pass over the recent metric rows."""
    longest = max(rule.hold for rule in rules)
    wanted = F.col("metric_name").isin(*sorted({r.metric_name for r in rules}))
    recent = since(metrics.where(wanted & (F.col("recorded_at") <= F.lit(as_of))), "recorded_at", longest, as_of)
    verdicts = []
    for rule in rules:
        inside = (F.col("metric_name") == rule.metric_name) & later_than(F.col("recorded_at"), as_of, rule.hold)
        value = F.when(inside, F.col("metric_value"))
        extreme = {
            "below": F.max(value), "above": F.min(value), "any_above": F.sum(value), "no_data": F.count(value).cast("double"),
        }[rule.when]
        fires = {
            "below": extreme < rule.threshold, "above": extreme > rule.threshold, "any_above": extreme > rule.threshold, "no_data": extreme == 0,
        }[rule.when]
        verdicts.append(
            F.struct(
                F.lit(rule.alert_name).alias("alert_name"),
                F.lit(rule.severity).alias("severity"),
                F.lit(rule.metric_name).alias("metric_name"),
                F.lit(float(rule.threshold)).alias("threshold_value"),
                extreme.alias("actual_value"),
                F.when(F.coalesce(fires, F.lit(False)), "firing").otherwise("resolved").alias("status"),
            )
        )
    return recent.agg(F.array(*verdicts).alias("v")).select(F.inline("v"))


# --- fixed values: metric -> (direction, target, length of the window it is judged over)
SLO_TARGETS = {
    "availability_pct": ("at_least", 99.5, "day"),
    "latency_p95": ("at_most", 15.0, "day"),
    "error_rate_pct": ("at_most", 1.0, "hour"),
    "valid_rows_pct": ("at_least", 99.0, "day"),
}


def slo(metrics: DataFrame, targets: dict[str, tuple[str, float, str]] = SLO_TARGETS) -> DataFrame:
    """Share of windows in which each metric's mean met its target."""
    name, value = F.col("metric_name"), F.col("metric_value")
    start, met = F.lit(None).cast("timestamp"), F.lit(None).cast("boolean")
    for metric, (direction, target, grain) in targets.items():
        start = F.when(name == metric, F.date_trunc(grain, "recorded_at").cast("timestamp")).otherwise(start)
        good = F.col("mean") >= target if direction == "at_least" else F.col("mean") <= target
        met = F.when(name == metric, good).otherwise(met)
    windows = metrics.where(name.isin(*targets)).groupBy("metric_name", start.alias("window_start")).agg(
        exact_mean(value).alias("mean")
    )
    return windows.groupBy("metric_name").agg(
        F.count("*").alias("windows"), F.count_if(met).alias("met"), percent(F.count_if(met), F.count("*")).alias("attained_pct")
    )


def business_rows(df: DataFrame, name: str, dimension: str, period: str, value: Column, ts: str = "timestamp") -> DataFrame:
    """Long-format business metric: money per dimension value and period."""
    start = F.date_trunc(period, F.col(ts)).cast("timestamp_ntz")
    grouped = df.groupBy(F.col(dimension).cast("string").alias("dimension_value"), start.alias("period_start"))
    return grouped.agg(money_sum(value).alias("metric_value")).select(
        F.lit(name).alias("metric_name"),
        "metric_value",
        F.lit(dimension).alias("dimension"),
        "dimension_value",
        F.lit(period).alias("time_period"),
        "period_start",
    )


def metric_total(business: DataFrame, name: str) -> DataFrame:
    return business.where(F.col("metric_name") == name).agg(money_sum(F.col("metric_value")).alias("total"))


def check_status(checks: DataFrame, by: list[str]) -> DataFrame:
    """Check results per group: counts by status and pass rate."""
    status = F.col("status")
    passed = F.count_if(status == "passed")
    return checks.groupBy(*by).agg(
        F.count("*").alias("checks"),
        passed.alias("passed"),
        F.count_if(status == "warning").alias("warning"),
        F.count_if(status == "failed").alias("failed"),
        percent(passed, F.count("*")).alias("pass_rate"),
    )


def recent_pass_rate(checks: DataFrame, as_of: datetime) -> DataFrame:
    passed = F.count_if(F.col("status") == "passed")
    return since(checks, "checked_at", DAY, as_of).agg(percent(passed, F.count("*")).alias("pass_rate"))
