"""Registered queries: checks, suites, reports and gates."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from rillmark.catalog.registry import AS_OF, AS_OF_SQL, query
from rillmark.catalog.tables import CHECKS, GOLD, LINES, METRICS, RUNS, SILVER
from rillmark.catalog.tables import alerts, check_history, given, gold, lines, messages, metric_history, runs, silver
from rillmark.operators import quality as q
from rillmark.operators.check_states import merged_suites
from rillmark.operators.layers import with_event_time
from rillmark.plans.quality_states import refresh_states
from rillmark.session import scratch_path
from rillmark.sinks.mart import write_report
from rillmark.sources.tables import latest_report

NATIVE = {"native_type": ("view", "click", "signup", "purchase"), "device_type": ("mobile", "desktop", "tablet")}
FLAT = ["suite", "name", "passed", "tested", "failed"]


def _flat(checks):
    return checks.select(*FLAT)


def _row(suite: str, name: str, failed: str, tested: str = "count(*)", passed: str | None = None, source: str = "silver") -> str:
    verdict = passed or f"({failed}) = 0"
    return (
        f"SELECT '{suite}' AS suite, '{name}' AS name, {verdict} AS passed, CAST({tested} AS BIGINT) AS tested, "
        f"CAST({failed} AS BIGINT) AS failed FROM {source}"
    )


def _bad(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


NOT_NULL_SQL = [
    _row(q.NULLS, f"no_nulls_{c}", _bad(f'"{c}" IS NULL')) for c in ("user_id", "event_type", "timestamp", "session_id")
]
RANGE_SQL = [_row(q.RANGE, "range_price_0_to_10000", _bad("price < 0 OR price > 10000"))]
EVENT_LIST = "'search','page_view','add_to_cart','remove_from_cart','checkout_started','checkout_completed','wishlist_add','review_submitted','filter_applied','sort_changed'"
DOMAIN_SQL = [
    _row(q.DOMAIN, "set_membership_event_type", _bad(f"event_type IS NULL OR event_type NOT IN ({EVENT_LIST})")),
    _row(q.DOMAIN, "set_membership_device_type", _bad("device_type IS NULL OR device_type NOT IN ('mobile','desktop','tablet')")),
]
TIME_SQL = [_row(q.REFERENCE, "all_rows_timestamped", _bad('"timestamp" IS NULL'))]
UNIQUE_SQL = [
    _row(q.UNIQUE, f"uniqueness_{c}", "0", passed=f"count(DISTINCT {c}) > 0") for c in ("user_id", "session_id")
]
ONE_SQL = [
    _row(q.REFERENCE, "session_id_has_one_user_id", _bad("n > 1"),
         source="(SELECT session_id, count(DISTINCT user_id) AS n FROM silver GROUP BY 1) s")
]
COLUMNS = ["event_id", "user_id", "session_id", "event_type", "native_type", "product_id", "price", "device_type", "timestamp", "event_date", "k"]
FILLED = " + ".join(f'count("{c}")' for c in COLUMNS)
COMPLETE_SQL = [
    _row(q.COMPLETE, "data_completeness_95_percent", f"count(*) * {len(COLUMNS)} - ({FILLED})", f"count(*) * {len(COLUMNS)}",
         f"CAST({FILLED} AS DOUBLE) / (count(*) * {len(COLUMNS)}) * 100 >= 95")
]
SCHEMA_SQL = [
    _row(q.SCHEMA, f"column_{c}_exists_with_type_{kind}", _bad(f"typeof(\"{c}\") <> '{duck}'"))
    for c, kind, duck in (
        ("user_id", "text", "VARCHAR"), ("event_type", "text", "VARCHAR"), ("timestamp", "time", "TIMESTAMP"),
        ("session_id", "text", "VARCHAR"), ("device_type", "text", "VARCHAR"),
    )
]
FRESH_SQL = [_row(q.COMPLETE, "data_freshness_1hour", "0", passed="TRUE")]
SUITE_SQL = "\nUNION ALL\n".join(
    SCHEMA_SQL + NOT_NULL_SQL + RANGE_SQL + DOMAIN_SQL + TIME_SQL + FRESH_SQL + COMPLETE_SQL + UNIQUE_SQL + ONE_SQL
)
SUITES = f"suite_rows AS ({SUITE_SQL})"


@query("\nUNION ALL\n".join(SCHEMA_SQL), (SILVER,))
def check_schema(spark, d):
    return _flat(q.check_schema(silver(spark, d)))


@query("\nUNION ALL\n".join(NOT_NULL_SQL), (SILVER,))
def check_not_null(spark, d):
    return _flat(q.check_not_null(silver(spark, d)))


@query(
    "\nUNION ALL\n".join([
        _row(q.RANGE, "range_price_10_to_200", _bad("price < 10 OR price > 200")),
        _row(q.RANGE, "range_k_1_to_98", _bad("k < 1 OR k > 98")),
    ]),
    (SILVER,),
)
def check_range(spark, d):
    return _flat(q.check_range(silver(spark, d), {"price": (10, 200), "k": (1, 98), "no_such_column": (0, 1)}))


@query(
    "\nUNION ALL\n".join([
        _row(q.DOMAIN, "set_membership_native_type", _bad("native_type NOT IN ('view','click','signup','purchase')")),
        _row(q.DOMAIN, "set_membership_device_type", _bad("device_type NOT IN ('mobile','desktop','tablet')")),
    ]),
    (SILVER,),
)
def check_domain(spark, d):
    return _flat(q.check_domain(silver(spark, d), NATIVE))


@query(
    """SELECT 'native_type' AS column_name, native_type AS value, count(*) AS n FROM silver WHERE native_type NOT IN ('view','click')
    GROUP BY 2 ORDER BY n DESC, value LIMIT 5""",
    (SILVER,),
)
def domain_offenders(spark, d):
    return q.domain_offenders(silver(spark, d), {"native_type": ("view", "click")})


@query("\nUNION ALL\n".join(UNIQUE_SQL), (SILVER,))
def check_unique_profile(spark, d):
    return _flat(q.check_unique_profile(silver(spark, d)))


@query("\nUNION ALL\n".join(UNIQUE_SQL), (SILVER,))
def check_unique_profile_approx(spark, d):
    return _flat(q.check_unique_profile(silver(spark, d), approx=True))


@query(
    "\nUNION ALL\n".join(ONE_SQL + [
        _row(q.REFERENCE, "product_id_has_one_user_id", _bad("n > 1"),
             source="(SELECT product_id, count(DISTINCT user_id) AS n FROM silver GROUP BY 1) s")
    ]),
    (SILVER,),
)
def check_one_to_one(spark, d):
    rows = silver(spark, d)
    return _flat(q.check_one_to_one(rows).union(q.check_one_to_one(rows, "product_id", "user_id")))


@query(TIME_SQL[0], (SILVER,))
def check_timestamped(spark, d):
    return _flat(q.check_timestamped(silver(spark, d)))


@query(
    "\nUNION ALL\n".join([
        _row(q.COMPLETE, "data_freshness_1hour", f'CASE WHEN max("timestamp") > {AS_OF_SQL} - INTERVAL 1 HOUR THEN 0 ELSE 1 END'),
        _row(q.COMPLETE, "data_freshness_1hour", "0", passed="TRUE", source="silver WHERE event_date < DATE '2024-01-10'"),
        _row(q.COMPLETE, "data_freshness_1hour", "1", passed="FALSE", source="silver WHERE event_date < DATE '2024-01-10'"),
    ]),
    (SILVER,),
)
def check_fresh(spark, d):
    """Fresh data, old data while back-filling, and the same old data otherwise."""
    rows, hour = silver(spark, d), timedelta(hours=1)
    old = rows.where(F.col("event_date") < "2024-01-10")
    return _flat(
        q.check_fresh(rows, "timestamp", hour, AS_OF)
        .union(q.check_fresh(old, "timestamp", hour, AS_OF, backfill=True))
        .union(q.check_fresh(old, "timestamp", hour, AS_OF))
    )


@query(COMPLETE_SQL[0], (SILVER,))
def check_complete(spark, d):
    return _flat(q.check_complete(silver(spark, d)))


@query("SELECT * FROM suite_rows", (SILVER, SUITES))
def quality_suites(spark, d):
    return _flat(q.run_suites(silver(spark, d), AS_OF))


@query("SELECT * FROM suite_rows", (SILVER, SUITES))
def quality_suites_merged(spark, d):
    """The suites from stored states: half of the events first, all later, so days are read again only where files came."""
    path, root = scratch_path(spark, "checked-events"), scratch_path(spark, "check-states")
    events = silver(spark, d)
    middle = events.select(F.expr("timestampadd(SECOND, int(timestampdiff(SECOND, min(timestamp), max(timestamp)) / 2), min(timestamp))")).first()[0]
    for part in (F.coalesce(F.col("timestamp") < F.lit(middle), F.lit(True)), F.col("timestamp") >= F.lit(middle)):
        events.where(part).write.mode("append").partitionBy("event_date").parquet(path)
        states = refresh_states(spark, path, root, "event_date", lambda df: df.select(*events.columns))
    return _flat(merged_suites(states.rows, states.parents, AS_OF))


SUITE_SUM = """suite_sums AS (SELECT suite, count(*) AS expectations, count(*) FILTER (WHERE passed) AS ok,
    count(*) FILTER (WHERE NOT passed) AS bad FROM suite_rows GROUP BY 1)"""


@query(
    """SELECT count(*) AS total_suites, CAST(sum(expectations) AS BIGINT) AS total_expectations, CAST(sum(ok) AS BIGINT) AS total_passed,
      CAST(sum(bad) AS BIGINT) AS total_failed, count(*) FILTER (WHERE bad = 0) AS suites_passed,
      count(*) FILTER (WHERE bad > 0) AS suites_failed, CAST(sum(ok) AS DOUBLE) / CAST(sum(expectations) AS DOUBLE) * 100 AS pass_rate
    FROM suite_sums""",
    (SILVER, SUITES, SUITE_SUM),
)
def quality_summary(spark, d):
    return q.report_summary(q.run_suites(silver(spark, d), AS_OF))


@query(
    """SELECT '2024-01-31T00:00:00' AS timestamp, (SELECT CAST(count(*) AS INTEGER) FROM suite_sums) AS total_suites, suite, name, passed
    FROM suite_rows""",
    (SILVER, SUITES, SUITE_SUM),
)
def stored_report(spark, d):
    """The newest of two reports stored as JSON, read back and flattened."""
    folder = scratch_path(spark, "reports")
    checks = q.run_suites(silver(spark, d), AS_OF)
    write_report(q.report(checks.where(F.col("suite") == q.NULLS), "2024-01-30T00:00:00"), folder)
    write_report(q.report(checks, AS_OF.isoformat()), folder)
    newest = latest_report(spark, folder)
    flat = q.checks_of_reports(newest)
    return flat.join(newest.select("timestamp", "total_suites"), "timestamp").drop("details")


# native event names: the 'error' rows break the domain
BAD_SUITES = [
    _row(q.DOMAIN, "set_membership_native_type", _bad("native_type NOT IN ('view','click','signup','purchase')")),
    _row(q.RANGE, "range_price_10_to_200", _bad("price < 10 OR price > 200")),
    *NOT_NULL_SQL,
]
BAD = "bad_rows AS (" + "\nUNION ALL\n".join(BAD_SUITES) + ")"


def _bad_checks(spark, d):
    rows = silver(spark, d)
    checks = q.domain_checks(rows, {"native_type": NATIVE["native_type"]})
    checks += q.range_checks(rows, {"price": (10, 200)}) + q.not_null_checks(rows)
    return q.evaluate(rows, checks)


def _gate_sql(policy: str, blocking) -> str:
    listed = ", ".join(f"'{s}'" for s in sorted(blocking))
    return f"""SELECT '{policy}' AS policy, count(*) > 0 AND count(*) FILTER (WHERE NOT passed AND suite IN ({listed})) = 0 AS approved,
      count(*) FILTER (WHERE NOT passed AND suite IN ({listed})) AS blocking_failures,
      count(*) FILTER (WHERE NOT passed AND suite NOT IN ({listed})) AS advisory_failures,
      coalesce((SELECT string_agg(suite, ',' ORDER BY suite) FROM (SELECT DISTINCT suite FROM bad_rows
        WHERE NOT passed AND suite IN ({listed})) b), '') AS blocked_by FROM bad_rows"""


@query(_gate_sql("validation", q.VALIDATION_POLICY) + "\nUNION ALL\n" + _gate_sql("write", q.WRITE_POLICY), (SILVER, BAD))
def gate_verdicts(spark, d):
    """The same failures under the two policies: a range failure blocks only the first."""
    checks = _bad_checks(spark, d)
    both = [q.gate(checks, p).withColumn("policy", F.lit(n)) for n, p in (("validation", q.VALIDATION_POLICY), ("write", q.WRITE_POLICY))]
    return both[0].union(both[1])


@query(
    """SELECT suite AS alert_name, CASE WHEN suite IN ('set_membership', 'range_constraints') THEN 'critical' ELSE 'warning' END AS severity,
      CASE suite WHEN 'set_membership' THEN 'Unknown event/device types' ELSE 'Prices/quantities exceed ranges' END AS message,
      CASE suite WHEN 'set_membership' THEN 'Enum mapping validation' ELSE 'Data quality review' END AS action,
      CAST(count(*) AS DOUBLE) AS actual_value FROM bad_rows WHERE NOT passed GROUP BY suite""",
    (SILVER, BAD),
)
def failures_to_alerts(spark, d):
    return q.failures_to_alerts(_bad_checks(spark, d))


DAILY = """daily AS (SELECT event_date, count(*) FILTER (WHERE price > 200) = 0 AS p1, count(*) FILTER (WHERE price > 300) = 0 AS p2,
    count(*) FILTER (WHERE native_type = 'error') = 0 AS p3 FROM silver GROUP BY 1)"""


@query(
    """SELECT strftime(event_date, '%Y-%m-%d') AS timestamp, CAST(CAST(p1 AS INTEGER) + CAST(p2 AS INTEGER) + CAST(p3 AS INTEGER) AS INTEGER) AS suites_passed,
      CAST(CAST(p1 AS INTEGER) + CAST(p2 AS INTEGER) + CAST(p3 AS INTEGER) AS DOUBLE) / 3 * 100 AS pass_rate,
      CAST(CAST(p1 AS INTEGER) + CAST(p2 AS INTEGER) + CAST(p3 AS INTEGER) AS DOUBLE) / 3 * 100
        - lag(CAST(CAST(p1 AS INTEGER) + CAST(p2 AS INTEGER) + CAST(p3 AS INTEGER) AS DOUBLE) / 3 * 100) OVER (ORDER BY event_date) AS change
    FROM daily""",
    (SILVER, DAILY),
)
def quality_trend(spark, d):
    """One report per day with three one-check suites, and the change of its pass rate."""
    days = silver(spark, d).groupBy("event_date").agg(
        (F.count_if(F.col("price") > 200) == 0).cast("int").alias("p1"),
        (F.count_if(F.col("price") > 300) == 0).cast("int").alias("p2"),
        (F.count_if(F.col("native_type") == "error") == 0).cast("int").alias("p3"),
    )
    passed = F.col("p1") + F.col("p2") + F.col("p3")
    summary = F.struct(F.lit(3).alias("total_expectations"), passed.alias("total_passed"), passed.alias("suites_passed"))
    return q.quality_trend(days.select(F.date_format("event_date", "yyyy-MM-dd").alias("timestamp"), summary.alias("summary")))


GOLD_CHECKS = (
    ("schema_validation", "0", "0.0"),
    ("null_checks", _bad("event_type IS NULL OR event_date IS NULL OR device_type IS NULL"), None),
    ("range_constraints", _bad("event_count < 0 OR total_value < 0"), None),
    ("device_type_validation", _bad("lower(trim(device_type)) NOT IN ('mobile','desktop','tablet')"), None),
    ("events_cover_users", _bad("event_count < unique_users"), None),
    ("conversion_at_most_100", "CASE WHEN coalesce(sum(event_count) FILTER (WHERE event_type = 'checkout_completed'), 0)"
     " > coalesce(sum(event_count) FILTER (WHERE event_type = 'page_view'), 0) THEN 1 ELSE 0 END", "0.0"),
    ("data_freshness", f"CASE WHEN CAST(max(event_date) AS TIMESTAMP) > {AS_OF_SQL} - INTERVAL 25 HOUR THEN 0 ELSE 1 END", "0.0"),
)


@query(
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS check_name, CASE WHEN ({bad}) = 0 THEN 'passed' ELSE 'failed' END AS status, "
        f"CAST({rate or f'CAST({bad} AS DOUBLE) / count(*) * 100'} AS DOUBLE) AS failure_rate, count(*) AS records_checked, "
        f"CAST({bad} AS BIGINT) AS records_failed FROM gold"
        for name, bad, rate in GOLD_CHECKS
    ),
    (SILVER, GOLD),
)
def gold_checks(spark, d):
    return q.check_gold(gold(spark, d), AS_OF, timedelta(hours=25))


@query(
    """SELECT name AS check_name, 'failed' AS status, rate AS failure_rate, n AS records_checked, CASE WHEN rows THEN n ELSE bad END AS records_failed
    FROM (SELECT count(*) AS n FROM gold) g, (VALUES ('schema_validation', 0.0::DOUBLE, FALSE, 3::BIGINT), ('device_type_validation', 100.0, TRUE, 0),
      ('events_cover_users', 100.0, TRUE, 0), ('null_checks', 100.0, TRUE, 0), ('data_freshness', 0.0, FALSE, 1)) v(name, rate, rows, bad)
    UNION ALL SELECT 'conversion_at_most_100', 'failed', 0.0, count(*), 1 FROM gold
    HAVING sum(event_count) FILTER (WHERE event_type = 'checkout_completed') > sum(event_count) FILTER (WHERE event_type = 'page_view')""",
    (SILVER, GOLD),
)
def gold_checks_missing_columns(spark, d):
    """The hourly table without three of its columns: what needs them fails and is reported."""
    checks = q.check_gold(gold(spark, d).drop("device_type", "unique_users", "event_date"), AS_OF)
    return checks.where("status = 'failed'")


@query(
    "\nUNION ALL\n".join([
        _row("event_rules", "cart_event_has_product", "0", _bad("event_type = 'add_to_cart'")),
        _row("event_rules", "search_has_query", _bad("event_type = 'search' AND k % 10 = 0"), _bad("event_type = 'search'")),
    ]),
    (SILVER,),
)
def event_rules(spark, d):
    query_text = F.when(F.col("k") % 10 != 0, F.concat(F.lit("item "), F.col("k").cast("string")))
    return _flat(q.check_event_rules(silver(spark, d).withColumn("search_query", query_text)))


ORDERS = """totals AS (SELECT transaction_id, count(*) AS items,
    CAST(sum(quantity * unit_price) * 100 AS BIGINT) AS sub, CAST(sum(tax_amount) * 100 AS BIGINT) AS tax,
    CAST(sum(discount_amount) * 100 AS BIGINT) AS disc FROM lines GROUP BY 1),
order_rows AS (SELECT o_orderkey, coalesce(items, 0) AS items, CASE WHEN o_orderkey % 100 = 0 THEN 1 ELSE 0 END AS off
  FROM orders LEFT JOIN totals ON CAST(o_orderkey AS VARCHAR) = transaction_id)"""


@query(
    "\nUNION ALL\n".join([
        _row("order_rules", "total_reconciles", _bad("off = 1"), source="order_rows"),
        _row("order_rules", "has_items_and_count_matches", _bad("items = 0"), source="order_rows"),
    ]),
    (LINES, ORDERS),
)
def order_rules(spark, d):
    """Orders rebuilt from their lines; every 100th total is off by a cent, and orders without lines fail."""
    cents = lambda c: F.coalesce((F.sum(c) * 100).cast("bigint"), F.lit(0))
    sums = lines(spark, d).withColumn("gross", F.col("quantity") * F.col("unit_price")).groupBy("transaction_id").agg(
        F.count("*").alias("item_count"), cents("gross").alias("subtotal_cents"), cents("tax_amount").alias("tax_cents"),
        cents("discount_amount").alias("discount_cents"),
    )
    heads = given(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("transaction_id"), "o_orderkey")
    rows = heads.join(sums, "transaction_id", "left").na.fill(0).withColumn("shipping_cents", F.lit(500))
    off = F.when(F.col("o_orderkey") % 100 == 0, 1).otherwise(0)
    total = F.col("subtotal_cents") + F.col("tax_cents") + F.col("shipping_cents") - F.col("discount_cents") + off
    return _flat(q.check_orders(rows.withColumns({"total_cents": total, "total_items": F.col("item_count")})))


@query(_row("metric_rows", "metric_name_format", _bad("NOT regexp_matches(metric_name, '^[a-z0-9_.]+$')"), source="metrics"), (SILVER, GOLD, METRICS))
def metric_row_checks(spark, d):
    return _flat(q.check_metric_rows(metric_history(spark, d)))


@query(
    "\nUNION ALL\n".join([
        _row("metric_rows", "set_membership_status", _bad("status NOT IN ('running','success','failed','timeout')"), source="runs"),
        _row("metric_rows", "no_duplicate_run_id", _bad("n > 1"), source="(SELECT run_id, count(*) AS n FROM runs GROUP BY 1) r"),
    ]),
    (RUNS,),
)
def run_row_checks(spark, d):
    return _flat(q.check_run_rows(runs(spark, d)))


@query(
    "\nUNION ALL\n".join([
        _row("metric_rows", "set_membership_severity", "0", source="checks WHERE status <> 'passed'"),
        _row("metric_rows", "set_membership_status", "0", source="checks WHERE status <> 'passed'"),
        _row("metric_rows", "set_membership_status", _bad("status NOT IN ('passed','warning','failed')"), source="checks"),
    ]),
    (SILVER, CHECKS),
)
def alert_and_result_checks(spark, d):
    return _flat(q.check_alert_rows(alerts(spark, d)).union(q.check_result_rows(check_history(spark, d))))


@query(
    "\nUNION ALL\n".join([
        _row(q.UNIQUE, "no_duplicate_event_id", _bad("n > 1"), source="(SELECT event_id, count(*) AS n FROM silver GROUP BY 1) s"),
        _row(q.UNIQUE, "no_duplicate_session_id_event_type", _bad("n > 1"),
             source="(SELECT session_id, event_type, count(*) AS n FROM silver GROUP BY 1, 2) s"),
    ]),
    (SILVER,),
)
def duplicate_checks(spark, d):
    rows = silver(spark, d)
    return _flat(q.check_duplicates(rows, ["event_id"]).union(q.check_duplicates(rows, ["session_id", "event_type"])))


@query(
    """SELECT 'completeness_freshness' AS suite, 'arrival_within_limit' AS name, count(*) FILTER (WHERE late) = 0 AS passed,
      count(*) AS tested, count(*) FILTER (WHERE late) AS failed
    FROM (SELECT "timestamp" + k * INTERVAL 1 MINUTE > date_trunc('second', "timestamp") + INTERVAL 1 HOUR AS late
      FROM (SELECT * FROM silver UNION ALL SELECT * FROM silver WHERE CAST(event_id AS BIGINT) % 50 = 0) s
      WHERE CAST(event_id AS BIGINT) % 97 <> 0) a""",
    (SILVER,),
)
def arrival_check(spark, d):
    """Broker time against the event time inside the message."""
    raw = messages(spark, d)
    text = F.get_json_object(F.col("value").cast("string"), "$.timestamp")
    rows = with_event_time(raw.select(F.col("timestamp").alias("arrived"), text.alias("timestamp"))).where("event_ts is not null")
    return _flat(q.check_arrival(rows, "event_ts", "arrived", timedelta(hours=1)))


@query(
    """SELECT 'weights' AS suite, 'weight_sums_to_one_per_event_type' AS name, TRUE AS passed, count(DISTINCT event_type) AS tested,
    CAST(0 AS BIGINT) AS failed FROM silver""",
    (SILVER,),
)
def weight_check(spark, d):
    """Device shares of every event type sum to one."""
    counts = silver(spark, d).groupBy("event_type", "device_type").agg(F.count("*").alias("n"))
    totals = counts.groupBy("event_type").agg(F.sum("n").alias("total"))
    shares = counts.join(totals, "event_type").withColumn("weight", F.col("n") / F.col("total"))
    return _flat(q.check_weights(shares, "event_type", "weight"))


@query(
    """SELECT s.n AS bronze_events, g.n AS silver_events, g.n AS gold_events, s.n - g.n AS bronze_minus_silver, 0::BIGINT AS silver_minus_gold
    FROM (SELECT count(*) AS n FROM silver) s, (SELECT count(*) AS n FROM silver WHERE native_type <> 'error') g""",
    (SILVER,),
)
def layer_reconciliation(spark, d):
    from rillmark.operators.aggregates import hourly_metrics

    kept = silver(spark, d).where(F.col("native_type") != "error")
    return q.reconcile_layers(given(spark, d, "events"), kept, hourly_metrics(kept))


@query(
    """SELECT dataset AS table_name, CAST(checked_at AS DATE) AS check_date,
      CAST(CAST(count(*) FILTER (WHERE status = 'passed') AS DOUBLE) / count(*) * 100 AS DECIMAL(5,2)) AS quality_score,
      count(*) AS total_checks, count(*) FILTER (WHERE status = 'passed') AS passed_checks,
      count(*) - count(*) FILTER (WHERE status = 'passed') AS failed_checks FROM checks GROUP BY 1, 2""",
    (SILVER, CHECKS),
)
def quality_scores(spark, d):
    return q.quality_scores(check_history(spark, d))
