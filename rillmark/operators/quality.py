"""Data-quality checks, suites, report and publication gates.

A check is a handful of aggregate expressions. All checks of a table that need
only one look at each row are evaluated in one pass; the result is a small
table ``(suite, name, passed, tested, failed, details)``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, StringType, TimestampNTZType, TimestampType

from rillmark.functions.columns import all_present, has_columns, missing_columns, normalise_text, percent
from rillmark.operators.orders import whole_orders
from rillmark.schemas import (
    ALERT_STATUSES,
    CHECK_STATUSES,
    DEVICE_TYPES,
    EVENT_TYPES,
    FUNNEL_STAGES,
    ORDER_STATUSES,
    PAYMENT_METHODS,
    RUN_STATUSES,
    SEVERITIES,
)

SCHEMA, NULLS, RANGE, DOMAIN = "schema_validation", "null_checks", "range_constraints", "set_membership"
UNIQUE, REFERENCE, COMPLETE = "uniqueness_checks", "referential_integrity", "completeness_freshness"
SUITES = (SCHEMA, NULLS, RANGE, DOMAIN, UNIQUE, REFERENCE, COMPLETE)

# --- fixed values: required columns, ranges and domains of the suites; the patterns of the check names below.
REQUIRED_TYPES = {
    "user_id": "text", "event_type": "text", "timestamp": "time", "session_id": "text", "device_type": "text",
}
REQUIRED_NOT_NULL = ("user_id", "event_type", "timestamp", "session_id")
RANGES = {"price": (0, 10000), "quantity": (1, 1000)}
DOMAINS = {"event_type": EVENT_TYPES, "device_type": DEVICE_TYPES}
UNIQUE_COLUMNS = ("user_id", "session_id")

# --- fixed values: which suites block publication: at validation time, and again when aggregates are written.
VALIDATION_POLICY = frozenset({SCHEMA, NULLS, RANGE, DOMAIN, REFERENCE})
WRITE_POLICY = frozenset({SCHEMA, NULLS, DOMAIN, REFERENCE, COMPLETE})

# --- fixed values: suite -> (alert, recommended action) for failed suites.
ALERT_ACTIONS = {
    SCHEMA: ("New/removed columns", "Update downstream schemas"),
    NULLS: ("Null counts exceed threshold", "Investigate upstream pipeline"),
    RANGE: ("Prices/quantities exceed ranges", "Data quality review"),
    DOMAIN: ("Unknown event/device types", "Enum mapping validation"),
    UNIQUE: ("Unexpected uniqueness patterns", "Aggregation logic check"),
    REFERENCE: ("Multi-user sessions detected", "User-session mapping fix"),
    COMPLETE: ("Data older than 1 hour", "Ingestion pipeline restart"),
}


@dataclass(frozen=True)
class Check:
    """Aggregate expressions of one check; by default it passes when nothing failed."""

    suite: str
    name: str
    tested: Column
    failed: Column
    passed: Column | None = None
    details: Column | None = None

    def row(self) -> Column:
        passed = self.failed == 0 if self.passed is None else self.passed
        counts = F.concat_ws(
            "", self.failed.cast("string"), F.lit(" of "), self.tested.cast("string"), F.lit(" rows failed")
        )
        return F.struct(
            F.lit(self.suite).alias("suite"),
            F.lit(self.name).alias("name"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            self.tested.cast("bigint").alias("tested"),
            self.failed.cast("bigint").alias("failed"),
            (counts if self.details is None else self.details).alias("details"),
        )


def evaluate(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All checks in a single aggregation, one row each."""
    return df.agg(F.array(*[check.row() for check in checks]).alias("checks")).select(F.inline("checks"))


def row_check(suite: str, name: str, bad: Column, tested: Column | None = None) -> Check:
    """A check on single rows; a verdict of null does not count as bad."""
    return Check(suite, name, F.count("*") if tested is None else tested, F.count_if(bad))


# ---- checks on single rows ----------------------------------------------------


def not_null_checks(df: DataFrame, columns=REQUIRED_NOT_NULL) -> list[Check]:
    return [
        row_check(NULLS, f"no_nulls_{c}", F.col(c).isNull() if has_columns(df, c) else F.lit(True)) for c in columns
    ]


def range_checks(df: DataFrame, ranges=RANGES, nulls: str = "ignore") -> list[Check]:
    """Values inside ``[low, high]``; ``nulls="fail"`` counts a null as out of range."""
    present = {c: bounds for c, bounds in ranges.items() if has_columns(df, c)}
    checks = []
    for column, (low, high) in present.items():
        outside = ~F.col(column).between(low, high)
        outside = F.coalesce(outside, F.lit(nulls == "fail"))
        checks.append(row_check(RANGE, f"range_{column}_{low}_to_{high}", outside))
    return checks or [Check(RANGE, "numeric_columns_not_found", F.count("*"), F.lit(0))]


def domain_checks(df: DataFrame, domains=DOMAINS, suite: str = DOMAIN) -> list[Check]:
    checks = []
    for column, values in domains.items():
        bad = ~F.coalesce(F.col(column).isin(*values), F.lit(False)) if has_columns(df, column) else F.lit(True)
        checks.append(row_check(suite, f"set_membership_{column}", bad))
    return checks


def timestamp_checks(ts: str = "timestamp") -> list[Check]:
    return [row_check(REFERENCE, "all_rows_timestamped", F.col(ts).isNull())]


def fresh_checks(ts: str, max_age: timedelta, as_of: datetime, backfill: bool = False) -> list[Check]:
    """The newest row is younger than ``max_age``; passes in any case while back-filling."""
    newest = F.max(ts)
    fresh = F.lit(True) if backfill else newest > F.lit(as_of) - F.lit(max_age)
    hours = int(max_age.total_seconds() // 3600)
    details = F.concat_ws("", F.lit("newest row: "), newest.cast("string"))
    return [Check(COMPLETE, f"data_freshness_{hours}hour", F.count("*"), F.when(fresh, 0).otherwise(1), fresh, details)]


def complete_checks(df: DataFrame, min_pct: float = 95) -> list[Check]:
    """Share of cells that are not null, over all columns."""
    filled = sum((F.count(c) for c in df.columns[1:]), F.count(df.columns[0]))
    cells = F.count("*") * len(df.columns)
    score = percent(filled, cells)
    details = F.concat_ws("", F.lit("completeness "), F.format_number(score, 2), F.lit("%"))
    return [Check(COMPLETE, f"data_completeness_{min_pct:g}_percent", cells, cells - filled, score >= min_pct, details)]


def check_not_null(df, columns=REQUIRED_NOT_NULL) -> DataFrame:
    return evaluate(df, not_null_checks(df, columns))


def check_range(df, ranges=RANGES, nulls="ignore") -> DataFrame:
    return evaluate(df, range_checks(df, ranges, nulls))


def check_domain(df, domains=DOMAINS) -> DataFrame:
    return evaluate(df, domain_checks(df, domains))


def check_timestamped(df, ts="timestamp") -> DataFrame:
    return evaluate(df, timestamp_checks(ts))


def check_fresh(df, ts, max_age, as_of, backfill=False) -> DataFrame:
    return evaluate(df, fresh_checks(ts, max_age, as_of, backfill))


def check_complete(df, min_pct=95) -> DataFrame:
    return evaluate(df, complete_checks(df, min_pct))


def domain_offenders(df: DataFrame, domains=DOMAINS, sample: int = 5) -> DataFrame:
    """The most frequent values outside each domain, at most ``sample`` per column (they are shown, not counted)."""
    frames = []
    for column, values in domains.items():
        outside = df.where(~F.coalesce(F.col(column).isin(*values), F.lit(False)))
        counts = outside.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
        frames.append(
            counts.orderBy(F.desc("n"), "value").limit(sample).select(F.lit(column).alias("column_name"), "value", "n")
        )
    return _union(frames)


# ---- checks on the schema and on groups ---------------------------------------


def _kind(data_type: DataType) -> str:
    if isinstance(data_type, StringType):
        return "text"
    if isinstance(data_type, (TimestampType, TimestampNTZType)):
        return "time"
    return "date" if isinstance(data_type, DateType) else "number" if isinstance(data_type, DoubleType) else data_type.simpleString()


def schema_checks(df: DataFrame, required: dict[str, str] = REQUIRED_TYPES) -> list[Check]:
    """Required columns exist with the right kind of type; if not, the check fails for every row."""
    found = {f.name: _kind(f.dataType) for f in df.schema.fields}
    return [
        Check(
            SCHEMA,
            f"column_{name}_exists_with_type_{kind}",
            F.count("*"),
            F.lit(0) if found.get(name) == kind else F.count("*"),
            F.lit(found.get(name) == kind),
            F.lit(f"found {found.get(name, 'no column')}"),
        )
        for name, kind in required.items()
    ]


def check_schema(df: DataFrame, required: dict[str, str] = REQUIRED_TYPES) -> DataFrame:
    return evaluate(df, schema_checks(df, required))


def check_unique_profile(df: DataFrame, columns=UNIQUE_COLUMNS, approx: bool = False) -> DataFrame:
    """Distinct values and duplication of each column; passes when there is something at all.

    Each column is counted on its own, so every scan reads one column and rows
    are not multiplied by the number of columns.
    """
    frames = []
    for column in columns:
        if not has_columns(df, column):
            frames.append(evaluate(df, [Check(UNIQUE, f"uniqueness_{column}", F.count("*"), F.lit(1))]))
            continue
        distinct = F.approx_count_distinct(column, 0.01) if approx else F.countDistinct(column)
        counted = df.agg(distinct.alias("distinct"), F.count("*").alias("total"))
        some = (F.col("distinct") > 0) & (F.col("total") > 0)
        share = percent(F.col("total") - F.col("distinct"), F.col("total"))
        details = F.concat_ws(
            "", F.lit("distinct "), F.col("distinct").cast("string"), F.lit(", duplication "), F.format_number(share, 1), F.lit("%")
        )
        frames.append(
            counted.select(
                F.lit(UNIQUE).alias("suite"), F.lit(f"uniqueness_{column}").alias("name"), some.alias("passed"),
                F.col("total").alias("tested"), F.when(some, 0).otherwise(1).cast("bigint").alias("failed"), details.alias("details"),
            )
        )
    return _union(frames)


def check_one_to_one(df: DataFrame, child: str = "session_id", parent: str = "user_id") -> DataFrame:
    """Every child value belongs to one parent value.

    Pairs are made distinct before the shuffle, by hash; a child with very many
    rows arrives as its few pairs.
    """
    pairs = df.where(F.col(child).isNotNull()).select(child, parent).distinct()
    per_child = pairs.groupBy(child).agg(F.count(parent).alias("parents"))
    return evaluate(per_child, [row_check(REFERENCE, f"{child}_has_one_{parent}", F.col("parents") > 1)])


def check_duplicates(df: DataFrame, keys: list[str], suite: str = UNIQUE) -> DataFrame:
    """Keys that occur more than once."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return evaluate(counts, [row_check(suite, "no_duplicate_" + "_".join(keys), F.col("n") > 1)])


def check_arrival(df: DataFrame, ts: str, arrival: str, limit: timedelta) -> DataFrame:
    """Rows arrive within ``limit`` of their event time."""
    late = F.col(arrival) > F.col(ts) + F.lit(limit)
    return evaluate(df, [row_check(COMPLETE, "arrival_within_limit", late)])


def check_event_rules(events: DataFrame) -> DataFrame:
    """Cart events name a product and searches carry a text."""
    cart = F.col("event_type").isin("add_to_cart", "remove_from_cart")
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    search = F.col("event_type") == "search"
    return evaluate(
        events,
        [
            row_check("event_rules", "cart_event_has_product", cart & empty("product_id"), F.count_if(cart)),
            row_check("event_rules", "search_has_query", search & empty("search_query"), F.count_if(search)),
        ],
    )


def order_flags(orders: DataFrame) -> DataFrame:
    """Orders with ``total_ok`` and ``items_ok``."""
    expected = F.col("subtotal_cents") + F.col("tax_cents") + F.col("shipping_cents") - F.col("discount_cents")
    counted = F.size("items") if has_columns(orders, "items") else F.col("item_count")
    return orders.withColumns(
        {
            "total_ok": F.coalesce(expected == F.col("total_cents"), F.lit(False)),
            "items_ok": F.coalesce((counted > 0) & (counted == F.col("total_items")), F.lit(False)),
        }
    )


def check_orders(orders: DataFrame, key: str = "order_id") -> DataFrame:
    """Order rules; orders that come in pages of items are judged as a whole."""
    flagged = order_flags(whole_orders(orders, key) if has_columns(orders, "page", "items") else orders)
    checks = [
        row_check("order_rules", "total_reconciles", ~F.col("total_ok")),
        row_check("order_rules", "has_items_and_count_matches", ~F.col("items_ok")),
    ]
    domains = {"payment_method": PAYMENT_METHODS, "order_status": ORDER_STATUSES}
    present = {c: v for c, v in domains.items() if has_columns(orders, c)}
    return evaluate(flagged, checks + domain_checks(orders, present, "order_rules"))


def check_metric_rows(metrics: DataFrame) -> DataFrame:
    named = F.coalesce(F.col("metric_name").rlike(r"^[a-z0-9_.]+$"), F.lit(False))
    return evaluate(metrics, [row_check("metric_rows", "metric_name_format", ~named)])


def check_run_rows(runs: DataFrame) -> DataFrame:
    status = evaluate(runs, domain_checks(runs, {"status": RUN_STATUSES}, "metric_rows"))
    return status.unionByName(check_duplicates(runs, ["run_id"], "metric_rows"))


def check_alert_rows(alerts: DataFrame) -> DataFrame:
    return evaluate(alerts, domain_checks(alerts, {"severity": SEVERITIES, "status": ALERT_STATUSES}, "metric_rows"))


def check_result_rows(checks: DataFrame) -> DataFrame:
    return evaluate(checks, domain_checks(checks, {"status": CHECK_STATUSES}, "metric_rows"))


def check_weights(df: DataFrame, group: str, weight: str, tolerance: float = 0.01) -> DataFrame:
    """Weights of every group are positive and sum to one."""
    sums = df.groupBy(group).agg(F.sum(F.col(weight).cast("decimal(18,6)")).cast("double").alias("total"), F.min(weight).alias("least"))
    off = (F.abs(F.col("total") - 1) >= tolerance) | (F.col("least") <= 0)
    return evaluate(sums, [row_check("weights", f"{weight}_sums_to_one_per_{group}", off)])


GOLD_COLUMNS = ("event_type", "event_date", "device_type", "event_count", "total_value", "avg_price", "unique_users")


def check_gold(gold: DataFrame, as_of: datetime, max_age: timedelta = timedelta(hours=24)) -> DataFrame:
    """Checks of the hourly table, with failure rate and status, in one pass.

    A missing column fails the schema check and, for every row, each check that needs it.
    """
    missing = missing_columns(gold, list(GOLD_COLUMNS))

    def on(name: str, columns: tuple[str, ...], bad) -> Check:
        return row_check("gold", name, bad() if has_columns(gold, *columns) else F.lit(True))

    named = ("event_type", "event_date", "device_type")
    newest = lambda: F.to_timestamp(F.max("event_date")) > F.lit(as_of) - F.lit(max_age)
    fresh = newest() if has_columns(gold, "event_date") else F.lit(False)
    checks = [
        Check("gold", "schema_validation", F.count("*"), F.lit(len(missing))),
        on("null_checks", named, lambda: ~all_present(*named)),
        on("range_constraints", ("event_count", "total_value"), lambda: (F.col("event_count") < 0) | (F.col("total_value") < 0)),
        on("device_type_validation", ("device_type",), lambda: ~normalise_text(F.col("device_type")).isin(*DEVICE_TYPES)),
        on("events_cover_users", ("event_count", "unique_users"), lambda: F.col("event_count") < F.col("unique_users")),
        Check("gold", "conversion_at_most_100", F.count("*"), *_conversion(gold)),
        Check("gold", "data_freshness", F.count("*"), F.when(fresh, 0).otherwise(1)),
    ]
    whole = ("schema_validation", "data_freshness", "conversion_at_most_100")
    rate = F.coalesce(percent(F.col("failed"), F.col("tested")), F.lit(0.0))
    return evaluate(gold, checks).select(
        F.col("name").alias("check_name"),
        F.when(F.col("passed"), "passed").otherwise("failed").alias("status"),
        F.when(F.col("name").isin(*whole), 0.0).otherwise(rate).alias("failure_rate"),
        F.col("tested").alias("records_checked"),
        F.col("failed").alias("records_failed"),
    )


def _conversion(gold: DataFrame) -> tuple[Column]:
    """1 if there are more purchases than page views, which would be a conversion above 100 %, else 0."""
    if not has_columns(gold, "event_type", "event_count"):
        return (F.lit(1),)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("event_type") == kind, F.col("event_count"))), F.lit(0))
    return (F.when(of(FUNNEL_STAGES["purchased"]) > of(FUNNEL_STAGES["viewed"]), 1).otherwise(0),)


def reconcile_layers(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Event counts of the three layers side by side, and what is missing between them."""
    counts = [
        bronze.agg(F.count("*").alias("n")).select(F.lit("bronze").alias("layer"), "n"),
        silver.agg(F.count("*").alias("n")).select(F.lit("silver"), "n"),
        gold.agg(F.coalesce(F.sum("event_count"), F.lit(0)).alias("n")).select(F.lit("gold"), "n"),
    ]
    n = {layer: F.max(F.when(F.col("layer") == layer, F.col("n"))) for layer in ("bronze", "silver", "gold")}
    return _union(counts).agg(
        n["bronze"].alias("bronze_events"),
        n["silver"].alias("silver_events"),
        n["gold"].alias("gold_events"),
        (n["bronze"] - n["silver"]).alias("bronze_minus_silver"),
        (n["silver"] - n["gold"]).alias("silver_minus_gold"),
    )


# ---- suites, report, gates ----------------------------------------------------


def run_suites(df: DataFrame, as_of: datetime, backfill: bool = True, approx: bool = False) -> DataFrame:
    """All seven suites. An empty table gives no rows, which every gate treats as blocked."""
    checks = schema_checks(df) + not_null_checks(df) + range_checks(df) + domain_checks(df)
    if has_columns(df, "timestamp"):
        checks += timestamp_checks() + fresh_checks("timestamp", timedelta(hours=1), as_of, backfill)
    checks += complete_checks(df)
    frames = [evaluate(df, checks), check_unique_profile(df, approx=approx)]
    if has_columns(df, "session_id", "user_id"):
        frames.append(check_one_to_one(df))
    all_rows = _union(frames)
    some = F.max(F.when(F.col("suite") == NULLS, F.col("tested"))).over(Window.partitionBy())
    return all_rows.withColumn("_rows", some).where("_rows > 0").drop("_rows")


def suite_summary(checks: DataFrame) -> DataFrame:
    return checks.groupBy("suite").agg(
        F.count("*").alias("expectations"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed")
    )


def report_summary(checks: DataFrame) -> DataFrame:
    return suite_summary(checks).agg(
        F.count("*").alias("total_suites"),
        F.sum("expectations").alias("total_expectations"),
        F.sum("passed").alias("total_passed"),
        F.sum("failed").alias("total_failed"),
        F.count_if(F.col("failed") == 0).alias("suites_passed"),
        F.count_if(F.col("failed") > 0).alias("suites_failed"),
        percent(F.sum("passed"), F.sum("expectations")).alias("pass_rate"),
    )


def report(checks: DataFrame, timestamp: str, run_id: str | None = None, written_at: str | None = None) -> DataFrame:
    """One nested report row. Only check rows, a few dozen, are collected into it.

    ``run_id`` and ``written_at`` say which run it belongs to and when it was written.
    """
    run = {"run_id": run_id, "written_at": written_at}
    suites = checks.groupBy("suite").agg(
        F.sort_array(F.collect_list(F.struct("name", "passed", "details"))).alias("expectations"),
        F.count_if("passed").cast("int").alias("passed"),
        F.count_if(~F.col("passed")).cast("int").alias("failed"),
    )
    body = F.struct(F.col("suite").alias("suite_name"), "expectations", "passed", "failed")
    summary = F.struct(
        F.sum(F.size("expectations")).cast("int").alias("total_expectations"),
        F.sum("passed").cast("int").alias("total_passed"),
        F.sum("failed").cast("int").alias("total_failed"),
        F.count_if(F.col("failed") == 0).cast("int").alias("suites_passed"),
        F.count_if(F.col("failed") > 0).cast("int").alias("suites_failed"),
    )
    return suites.agg(
        F.lit(timestamp).alias("timestamp"),
        F.count("*").cast("int").alias("total_suites"),
        F.sort_array(F.collect_list(body)).alias("suites"),
        summary.alias("summary"),
        *[F.lit(value).alias(name) for name, value in run.items() if value is not None],
    )


def checks_of_reports(reports: DataFrame) -> DataFrame:
    """Flat check rows of stored reports."""
    suites = reports.select("timestamp", F.explode("suites").alias("s"))
    return suites.select("timestamp", F.col("s.suite_name").alias("suite"), F.inline("s.expectations"))


def gate(checks: DataFrame, blocking: frozenset[str] = VALIDATION_POLICY) -> DataFrame:
    """One row: may aggregates be published? No checks at all means no."""
    is_blocking = F.col("suite").isin(*sorted(blocking))
    failed = ~F.col("passed")
    return checks.agg(
        ((F.count("*") > 0) & (F.count_if(failed & is_blocking) == 0)).alias("approved"),
        F.count_if(failed & is_blocking).alias("blocking_failures"),
        F.count_if(failed & ~is_blocking).alias("advisory_failures"),
        F.array_join(F.sort_array(F.collect_set(F.when(failed & is_blocking, F.col("suite")))), ",").alias("blocked_by"),
    )


def quality_trend(reports: DataFrame) -> DataFrame:
    """Pass rate of every stored report and its change from the report before."""
    rated = reports.select(
        "timestamp",
        F.col("summary.suites_passed").alias("suites_passed"),
        percent(F.col("summary.total_passed"), F.col("summary.total_expectations")).alias("pass_rate"),
    )
    # one row per report run: a day has a handful, so this window stays small
    order = Window.orderBy("timestamp")
    return rated.withColumn("change", F.col("pass_rate") - F.lag("pass_rate").over(order))


def failures_to_alerts(checks: DataFrame, blocking: frozenset[str] = VALIDATION_POLICY) -> DataFrame:
    """Alert rows of failed suites with the recommended action."""
    failed = suite_summary(checks).where("failed > 0")
    pick = lambda i: F.coalesce(*[F.when(F.col("suite") == s, F.lit(t[i])) for s, t in ALERT_ACTIONS.items()])
    return failed.select(
        F.col("suite").alias("alert_name"),
        F.when(F.col("suite").isin(*sorted(blocking)), "critical").otherwise("warning").alias("severity"),
        pick(0).alias("message"),
        pick(1).alias("action"),
        F.col("failed").cast("double").alias("actual_value"),
    )


def quality_scores(checks: DataFrame) -> DataFrame:
    """Daily score 0-100 per table from check result rows."""
    passed = F.count_if(F.col("status") == "passed")
    return checks.groupBy(F.col("dataset").alias("table_name"), F.to_date("checked_at").alias("check_date")).agg(
        percent(passed, F.count("*")).cast("decimal(5,2)").alias("quality_score"),
        F.count("*").alias("total_checks"),
        passed.alias("passed_checks"),
        (F.count("*") - passed).alias("failed_checks"),
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


