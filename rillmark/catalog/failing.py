"""Registered queries on rows that break rules: every check has rows that fail, in numbers that the SQL counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillmark.catalog.quality import _bad, _flat, _row
from rillmark.catalog.registry import AS_OF, query
from rillmark.catalog.tables import ALERTS, CHECKS, GOLD, METRICS, RUNS, SILVER, alerts, given, metric_history, runs, silver, silver_of
from rillmark.functions.ordered import with_running
from rillmark.operators import aggregates as agg
from rillmark.operators import orders
from rillmark.operators import quality as q
from rillmark.operators import warehouse as wh
from rillmark.schemas import ORDER_STATUSES, PAYMENT_METHODS
from rillmark.sinks.mart import write_metrics
from rillmark.session import scratch_path
from rillmark.sources.tables import Lake, read_table
from rillmark.streaming.queries import rejected


@query(
    "\nUNION ALL\n".join(
        f"SELECT 'uniqueness_{c}' AS name, count(DISTINCT {c}) AS distinct_values, round(CAST(count(*) - count(DISTINCT {c}) AS DOUBLE) / count(*) * 100, 1) AS duplication_pct FROM silver"
        for c in ("user_id", "session_id")
    ),
    (SILVER,),
)
def unique_profile_values(spark, d):
    """The figures in the details of the uniqueness checks."""
    rows = q.check_unique_profile(silver(spark, d))
    details = F.regexp_replace("details", ",(?=[0-9])", "")
    return rows.select(
        "name", F.regexp_extract(details, "distinct ([0-9]+)", 1).cast("bigint").alias("distinct_values"),
        F.regexp_extract(details, "duplication ([0-9.]+)%", 1).cast("double").alias("duplication_pct"),
    )


@query("SELECT event_type, count(DISTINCT user_id) AS distinct_values, TRUE AS within_bound FROM silver GROUP BY 1", (SILVER,))
def approx_users_error(spark, d):
    """Exact users per type, and whether the sketch is within three of its standard errors of 1 %."""
    exact = agg.distinct_per_group(silver(spark, d), ["event_type"], "user_id")
    both = agg.approx_users(silver(spark, d), ["event_type"]).join(exact, "event_type")
    off = F.abs(F.col("approx_users") - F.col("distinct_values"))
    return both.select("event_type", "distinct_values", (off <= F.col("distinct_values") * 0.03).alias("within_bound"))


@query(
    "\nUNION ALL\n".join([
        _row("metric_rows", "metric_name_format", _bad("hour(recorded_at) % 5 = 0"), source="metrics"),
        _row("metric_rows", "set_membership_status", _bad("duration_seconds % 3 = 0"), source="runs"),
        _row("metric_rows", "no_duplicate_run_id", _bad("day(started_at) % 2 = 0"), source="runs"),
    ]),
    (SILVER, GOLD, METRICS, RUNS),
)
def failing_metric_and_run_rows(spark, d):
    """Metric names in upper case, runs with a status that does not exist, runs recorded twice."""
    named = metric_history(spark, d).withColumn("metric_name", F.when(F.hour("recorded_at") % 5 == 0, F.upper("metric_name")).otherwise(F.col("metric_name")))
    rows = runs(spark, d)
    odd = rows.withColumn("status", F.when(F.col("duration_seconds") % 3 == 0, "lost").otherwise(F.col("status")))
    twice = rows.unionByName(rows.where(F.day("started_at") % 2 == 0))
    status = q.check_run_rows(odd).where("name = 'set_membership_status'")
    return _flat(q.check_metric_rows(named).union(status).union(q.check_run_rows(twice).where("name = 'no_duplicate_run_id'")))


@query(
    "\nUNION ALL\n".join([
        _row("metric_rows", "set_membership_severity", _bad("severity = 'info'"), source="alerts"),
        _row("metric_rows", "set_membership_status", _bad("status = 'resolved'"), source="alerts"),
    ]),
    (SILVER, CHECKS, ALERTS),
)
def failing_alert_rows(spark, d):
    """Alerts with a severity and a status that do not exist."""
    rows = alerts(spark, d)
    severity = F.when(F.col("severity") == "info", "whatever").otherwise(F.col("severity"))
    status = F.when(F.col("status") == "resolved", "asleep").otherwise(F.col("status"))
    return _flat(q.check_alert_rows(rows.withColumns({"severity": severity, "status": status})))


@query(
    "\nUNION ALL\n".join([
        _row("event_rules", "cart_event_has_product", _bad("event_type = 'add_to_cart' AND k % 7 = 0"), _bad("event_type = 'add_to_cart'")),
        _row("event_rules", "search_has_query", _bad("event_type = 'search' AND k % 10 = 0"), _bad("event_type = 'search'")),
    ]),
    (SILVER,),
)
def failing_event_rules(spark, d):
    """Cart events without a product and searches with a blank text."""
    rows = silver(spark, d).withColumn("product_id", F.when(F.col("k") % 7 != 0, F.col("product_id")))
    return _flat(q.check_event_rules(rows.withColumn("search_query", F.when(F.col("k") % 10 == 0, "").otherwise("text"))))


@query(
    "\nUNION ALL\n".join([
        _row("order_rules", "total_reconciles", _bad("o_orderkey % 9 = 0"), source="orders"),
        _row("order_rules", "has_items_and_count_matches", _bad("o_orderkey % 11 = 0"), source="orders"),
        _row("order_rules", "set_membership_payment_method", _bad("o_custkey % 8 >= 6"), source="orders"),
        _row("order_rules", "set_membership_order_status", _bad("o_orderstatus = 'P'"), source="orders"),
    ])
)
def failing_order_rules(spark, d):
    """Orders that break each of the four rules: total, items, payment method, status."""
    rows = given(spark, d, "orders")
    pays = F.array(*[F.lit(p) for p in (*PAYMENT_METHODS, "cheque", "barter")])
    status = F.when(F.col("o_orderstatus") == "O", ORDER_STATUSES[0]).when(F.col("o_orderstatus") == "F", ORDER_STATUSES[3]).otherwise("lost")
    amount = F.lit(1000).cast("bigint")
    return _flat(q.check_orders(rows.select(
        amount.alias("subtotal_cents"), F.lit(70).alias("tax_cents"), F.lit(500).alias("shipping_cents"), F.lit(20).alias("discount_cents"),
        F.when(F.col("o_orderkey") % 9 == 0, 1551).otherwise(1550).alias("total_cents"),
        F.lit(2).alias("item_count"), F.when(F.col("o_orderkey") % 11 == 0, 3).otherwise(2).alias("total_items"),
        F.element_at(pays, (F.col("o_custkey") % 8 + 1).cast("int")).alias("payment_method"), status.alias("order_status"),
    )))


@query(
    """SELECT 'weights' AS suite, 'weight_sums_to_one_per_event_type' AS name, FALSE AS passed, count(DISTINCT event_type) AS tested,
    count(DISTINCT event_type) FILTER (WHERE event_type IN ('search', 'page_view')) AS failed FROM silver""",
    (SILVER,),
)
def failing_weights(spark, d):
    """Shares of two event types are too large by a tenth."""
    counts = silver(spark, d).groupBy("event_type", "device_type").agg(F.count("*").alias("n"))
    totals = counts.groupBy("event_type").agg(F.sum("n").alias("total"))
    grown = F.when(F.col("event_type").isin("search", "page_view"), 1.1).otherwise(1.0)
    return _flat(q.check_weights(counts.join(totals, "event_type").withColumn("weight", F.col("n") / F.col("total") * grown), "event_type", "weight"))


@query(
    """SELECT CASE CAST(event_id AS BIGINT) % 7 WHEN 1 THEN 'unknown_device_type' WHEN 2 THEN 'unknown_event_type' WHEN 3 THEN 'missing_required'
      WHEN 4 THEN 'bad_time' END AS reasons, count(*) AS n FROM silver WHERE CAST(event_id AS BIGINT) % 7 BETWEEN 1 AND 4 GROUP BY 1""",
    (SILVER,),
)
def rejected_by_one_rule(spark, d):
    """Messages that break one rule each are rejected for that rule alone."""
    rows = silver_of(given(spark, d, "events"))
    kind = F.col("event_id").cast("bigint") % 7
    moment = F.concat(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    payload = F.to_json(F.struct(
        "event_id", F.when(kind == 4, "yesterday").otherwise(moment).alias("timestamp"),
        F.when(kind != 3, F.col("user_id")).alias("user_id"), "session_id",
        F.when(kind == 2, "teleport").otherwise(F.lit("search")).alias("event_type"),
        F.when(kind == 1, "fridge").otherwise(F.lit("mobile")).alias("device_type"),
    ))
    sent = rows.select(payload.cast("binary").alias("value"), F.col("event_id").cast("bigint").alias("kafka_offset"))
    return rejected(sent).groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count("*").alias("n"))


@query("SELECT l_suppkey AS order_id, count(*) AS item_count, TRUE AS items_ok FROM lineitem GROUP BY 1")
def paged_orders(spark, d):
    """Orders of hundreds of lines, sent in pages, are whole again when they are judged."""
    lines = given(spark, d, "lineitem").select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", F.lit(1).alias("one"))
    numbered = with_running(lines, ["l_suppkey"], "l_shipdate", ["l_orderkey", "l_linenumber"], {"line_no": ("sum", "one")})
    pages = orders.nest_items(numbered.withColumnRenamed("l_suppkey", "order_id"), "order_id", "line_no", ["l_partkey"])
    totals = lines.groupBy(F.col("l_suppkey").alias("order_id")).agg(F.sum("one").alias("total_items"))
    amounts = {c: F.lit(0) for c in ("subtotal_cents", "tax_cents", "shipping_cents", "discount_cents", "total_cents")}
    whole = orders.whole_orders(pages.join(totals, "order_id").withColumns(amounts), "order_id")
    return q.order_flags(whole).select("order_id", "item_count", "items_ok")


@query(
    """SELECT l_partkey AS product_id, arg_max(l_orderkey, l_orderkey * 10 + l_linenumber) AS brand,
      CAST(arg_max(l_extendedprice, l_orderkey * 10 + l_linenumber) AS DECIMAL(12,2)) AS unit_price FROM lineitem GROUP BY 1"""
)
def products_of_last_arrival(spark, d):
    """Products that arrive many times in one batch: the last by order counts."""
    rows = given(spark, d, "lineitem").select(
        F.col("l_partkey").alias("product_id"), F.lit("p").alias("product_name"), F.lit("c").alias("category"), F.col("l_orderkey").alias("brand"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"), F.lit(1).cast("decimal(10,2)").alias("cost"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sent"),
    )
    return wh.dim_product(None, rows, ["sent"]).select("product_id", "brand", "unit_price")


@query("SELECT metric_name, count(*) AS n FROM metrics WHERE recorded_at = (SELECT max(recorded_at) FROM metrics) GROUP BY 1", (SILVER, GOLD, METRICS))
def metrics_written_twice(spark, d):
    """Figures of one time written by two runs are there once."""
    lake = Lake(scratch_path(spark, "mart"))
    rows = metric_history(spark, d)
    newest = rows.join(F.broadcast(rows.agg(F.max("recorded_at").alias("newest"))), F.col("recorded_at") == F.col("newest")).drop("newest")  # one row
    for _ in range(2):
        write_metrics(newest.withColumn("recorded_at", F.col("recorded_at").cast("timestamp")), lake, None, AS_OF)
    return read_table(spark, lake, "pipeline_metrics").groupBy("metric_name").agg(F.count("*").alias("n"))


GATE_SQL = "SELECT 'good' AS run_id, TRUE AS approved UNION ALL SELECT 'bad', count(*) FILTER (WHERE native_type = 'error') = 0 FROM silver UNION ALL SELECT 'none', FALSE"


@query(GATE_SQL, (SILVER,))
def gate_by_report(spark, d):
    """Three runs of one time, the last of them good: each is judged by its own report."""
    from rillmark.plans.jobs import approved
    from rillmark.sinks.mart import write_report

    lake = Lake(scratch_path(spark, "gate"))
    native = {"native_type": ("view", "click", "signup", "purchase")}
    rows = silver(spark, d)
    for run_id, checks in (("bad", q.check_domain(rows, native)), ("good", q.check_domain(rows, {"device_type": ("mobile", "desktop", "tablet")}))):
        write_report(q.report(checks, AS_OF.isoformat(), run_id, f"2024-01-31T00:00:0{len(run_id)}"), lake.reports)
    verdicts = [(run_id, approved(spark, lake, run_id)) for run_id in ("good", "bad", "none")]
    return spark.createDataFrame(verdicts, "run_id string, approved boolean")
