"""The given tables in the shapes that the operators work on, in Spark and as SQL."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.catalog.registry import AS_OF, AS_OF_SQL
from rillmark.functions.columns import cents, json_tag
from rillmark.functions.lookup import lookup_join
from rillmark.functions.ordered import with_running
from rillmark.operators.aggregates import hourly_metrics, kpis
from rillmark.schemas import DEVICE_TYPES
from rillmark.operators.warehouse import dim_product, open_versions, scd2_upsert

STAGE_OF = {
    "view": "page_view", "click": "search", "signup": "add_to_cart",
    "error": "checkout_started", "purchase": "checkout_completed",
}
VERSION_DAY = date(1998, 1, 1)


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- events -------------------------------------------------------------------


def silver_of(events: DataFrame) -> DataFrame:
    """Events as conformed clickstream rows (also for streams)."""
    tagged = events.withColumn("k", json_tag(F.col("props"), "k").cast("int"))
    kind = F.col("event_type")
    stage = F.when(F.lit(False), kind)
    for native, name in STAGE_OF.items():
        stage = stage.when(kind == native, name)
    device = F.try_element_at(F.array(*[F.lit(name) for name in DEVICE_TYPES]), F.col("k") % 3 + 1)
    return tagged.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("session_id"),
        stage.otherwise(kind).alias("event_type"),
        kind.alias("native_type"),
        F.concat(F.lit("prod_"), F.col("k").cast("string")).alias("product_id"),
        F.col("value").alias("price"),
        device.alias("device_type"),
        F.col("ts").alias("timestamp"),
        F.to_date("ts").alias("event_date"),
        "k",
    )


def silver(spark, sf_dir) -> DataFrame:
    return silver_of(given(spark, sf_dir, "events"))


SILVER = """silver AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
    CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
    CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'search' WHEN 'signup' THEN 'add_to_cart'
      WHEN 'error' THEN 'checkout_started' WHEN 'purchase' THEN 'checkout_completed' ELSE event_type END AS event_type,
    event_type AS native_type, 'prod_' || CAST(k AS VARCHAR) AS product_id, value AS price,
    CASE k % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' WHEN 2 THEN 'tablet' END AS device_type,
    ts AS "timestamp", CAST(ts AS DATE) AS event_date, k
  FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events) e)"""


def messages(spark, sf_dir) -> DataFrame:
    """Events as raw messages: ISO times, every 50th one sent twice, every 97th cut short."""
    rows = given(spark, sf_dir, "events")
    base = silver_of(rows)
    payload = F.to_json(
        F.struct(
            "event_id",
            F.concat(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("timestamp"),
            "user_id", "session_id", "event_type", "device_type", "product_id", "price",
        )
    )
    number = F.col("event_id").cast("bigint")
    text = F.when(number % 97 == 0, F.substr(payload, F.lit(1), F.lit(20))).otherwise(payload)
    copies = F.when(number % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.select(
        F.col("user_id").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit("clickstream").alias("topic"),
        F.pmod(F.col("k"), F.lit(4)).alias("partition"),
        number.alias("offset"),
        (F.col("timestamp") + F.make_dt_interval(mins=F.col("k"))).cast("timestamp").alias("timestamp"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def gold(spark, sf_dir) -> DataFrame:
    return hourly_metrics(silver(spark, sf_dir))


_CENTS = "CAST(sum(CAST(round({0} * 100) AS BIGINT)) AS DOUBLE) / 100"

GOLD = f"""gold AS (
  SELECT event_date, CAST(hour("timestamp") AS INTEGER) AS event_hour, event_type, device_type,
    count(*) AS event_count, count(user_id) AS user_events, count(DISTINCT user_id) AS unique_users,
    count(price) AS priced_count, {_CENTS.format('price')} / count(price) AS avg_price, {_CENTS.format('price')} AS total_value
  FROM silver GROUP BY 1, 2, 3, 4)"""


def kpi_sql(by: str) -> str:
    """The exported figures as SQL, grouped by ``by`` (a list of columns ending in a comma, or nothing)."""
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    group_tag = f"GROUP BY {by}"
    count = 'CAST(sum(event_count) AS DOUBLE)'
    of = "CAST(sum(event_count) FILTER (WHERE event_type = '{0}') AS DOUBLE)".format
    hour = "event_date + event_hour * INTERVAL 1 HOUR"
    plain = {
        ("pipeline.revenue.total", "USD"): _CENTS.format("total_value"),
        ("pipeline.events.total", "count"): count,
        ("pipeline.users.unique", "count"): "CAST(sum(user_events) AS DOUBLE)",
        ("pipeline.order.avg_value", "USD"): "CAST(sum(CAST(avg_price AS DECIMAL(28,10))) AS DOUBLE) / count(avg_price)",
        ("pipeline.order.avg_value_weighted", "USD"): f"{_CENTS.format('total_value')} / CAST(sum(priced_count) AS DOUBLE)",
        ("pipeline.events.rate", "events/sec"): f"{count} / CAST(epoch(max({hour})) - epoch(min({hour})) + 3600 AS DOUBLE)",
        ("business.conversion.overall", "percent"): f"coalesce(coalesce({of('checkout_completed')}, 0) / {of('page_view')} * 100, 0)",
        ("pipeline.quality.score", "percent"): "CAST(count(*) FILTER (WHERE event_type IS NOT NULL AND event_date IS NOT NULL "
        "AND device_type IS NOT NULL AND event_count IS NOT NULL) AS DOUBLE) / count(*) * 100",
    }
    for stage in ("page_view", "add_to_cart", "checkout_started", "checkout_completed"):
        plain[(f"business.funnel.{stage}", "count")] = of(stage)
    parts = [
        f"SELECT {by} '{name}' AS metric_name, {value} AS metric_value, '{unit}' AS metric_unit, "
        f"CAST(NULL AS VARCHAR) AS tag FROM gold {group}"
        for (name, unit), value in plain.items()
    ]
    parts += [
        f"SELECT {by} 'pipeline.events.{short}' AS metric_name, {count} AS metric_value, 'count' AS metric_unit, "
        f"{column} AS tag FROM gold {group_tag} {column}"
        for short, column in (("by_type", "event_type"), ("by_device", "device_type"))
    ]
    return "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") kpi WHERE metric_value IS NOT NULL"


def metric_history(spark, sf_dir) -> DataFrame:
    """The exported figures of every hour, recorded when the hour ended."""
    hourly = kpis(gold(spark, sf_dir), ["event_date", "event_hour"])
    ended = F.col("event_date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("event_hour") + 1)
    return hourly.withColumn("recorded_at", ended).drop("event_date", "event_hour")


METRICS = f"""hourly_kpis AS ({kpi_sql('event_date, event_hour, ')}),
metrics AS (SELECT metric_name, metric_value, metric_unit, tag,
    event_date + (event_hour + 1) * INTERVAL 1 HOUR AS recorded_at FROM hourly_kpis)"""


def runs(spark, sf_dir) -> DataFrame:
    """One run per hour of events; failed when more than a quarter of its events are errors."""
    events = given(spark, sf_dir, "events")
    hours = events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("started_at")).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors")
    )
    n = F.col("n")
    status = F.when(F.col("errors") * 4 > n, "failed").when(n % 7 == 0, "running").otherwise("success")
    seconds = F.when(F.col("status") != "running", n * 7)
    return hours.withColumn("status", status).select(
        F.lit("lake_refresh").alias("pipeline_name"),
        F.concat(F.lit("run_"), F.date_format("started_at", "yyyyMMddHH")).alias("run_id"),
        "status",
        "started_at",
        (F.col("started_at") + F.make_dt_interval(secs=seconds)).alias("completed_at"),
        seconds.alias("duration_seconds"),
        n.alias("events_processed"),
        F.col("errors").alias("events_failed"),
    )


RUNS = """hours AS (SELECT date_trunc('hour', ts) AS started_at, count(*) AS n,
    count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1),
rated AS (SELECT *, CASE WHEN errors * 4 > n THEN 'failed' WHEN n % 7 = 0 THEN 'running' ELSE 'success' END AS status FROM hours),
runs AS (SELECT 'lake_refresh' AS pipeline_name, 'run_' || strftime(started_at, '%Y%m%d%H') AS run_id, status, started_at,
    CASE WHEN status <> 'running' THEN started_at + n * 7 * INTERVAL 1 SECOND END AS completed_at,
    CASE WHEN status <> 'running' THEN n * 7 END AS duration_seconds, n AS events_processed, errors AS events_failed FROM rated)"""


def check_history(spark, sf_dir) -> DataFrame:
    """Two checks per day and device: few high prices, few errors."""
    days = silver(spark, sf_dir).groupBy("event_date", "device_type").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("price") > 150).alias("high"),
        F.count_if(F.col("native_type") == "error").alias("errors"),
    )
    pairs = F.array(
        F.struct(F.lit("price_limit").alias("check_name"), F.col("high").alias("records_failed")),
        F.struct(F.lit("error_share").alias("check_name"), F.col("errors").alias("records_failed")),
    )
    rows = days.select("event_date", "device_type", "n", F.inline(pairs))
    failed, n = F.col("records_failed"), F.col("n")
    return rows.select(
        "check_name",
        F.concat(F.lit("silver."), F.col("device_type")).alias("dataset"),
        F.when(failed == 0, "passed").when(failed * 5 <= n, "warning").otherwise("failed").alias("status"),
        n.alias("records_checked"),
        "records_failed",
        (failed * 100 / n).alias("failure_rate"),
        (F.col("event_date").cast("timestamp_ntz") + F.lit(timedelta(hours=23))).alias("checked_at"),
    )


CHECKS = """check_days AS (SELECT event_date, device_type, count(*) AS n, count(*) FILTER (WHERE price > 150) AS high,
    count(*) FILTER (WHERE native_type = 'error') AS errors FROM silver GROUP BY 1, 2),
check_pairs AS (SELECT 'price_limit' AS check_name, event_date, device_type, n, high AS records_failed FROM check_days
    UNION ALL SELECT 'error_share', event_date, device_type, n, errors FROM check_days),
checks AS (SELECT check_name, 'silver.' || device_type AS dataset,
    CASE WHEN records_failed = 0 THEN 'passed' WHEN records_failed * 5 <= n THEN 'warning' ELSE 'failed' END AS status,
    n AS records_checked, records_failed, CAST(records_failed * 100 AS DOUBLE) / n AS failure_rate,
    event_date + INTERVAL 23 HOUR AS checked_at FROM check_pairs)"""


def alerts(spark, sf_dir) -> DataFrame:
    """An alert per check that did not pass; alerts of the last three days still fire."""
    rate = F.col("failure_rate")
    open_checks = check_history(spark, sf_dir).where(F.col("status") != "passed")
    return open_checks.select(
        F.concat_ws(":", "check_name", "dataset").alias("alert_name"),
        F.when(rate > 25, "critical").when(rate > 15, "warning").otherwise("info").alias("severity"),
        F.when(F.col("checked_at") > F.lit(AS_OF - timedelta(days=3)).cast("timestamp_ntz"), "firing").otherwise("resolved").alias("status"),
        F.concat(F.lit("check "), F.col("status")).alias("message"),
        rate.alias("actual_value"),
        F.lit(15.0).alias("threshold_value"),
        F.col("checked_at").alias("triggered_at"),
    )


ALERTS = f"""alerts AS (SELECT check_name || ':' || dataset AS alert_name,
    CASE WHEN failure_rate > 25 THEN 'critical' WHEN failure_rate > 15 THEN 'warning' ELSE 'info' END AS severity,
    CASE WHEN checked_at > {AS_OF_SQL} - INTERVAL 3 DAY THEN 'firing' ELSE 'resolved' END AS status,
    'check ' || status AS message, failure_rate AS actual_value, CAST(15.0 AS DOUBLE) AS threshold_value,
    checked_at AS triggered_at FROM checks WHERE status <> 'passed')"""


def resources(spark, sf_dir) -> DataFrame:
    """Event values read as resource samples per minute."""
    rows = silver(spark, sf_dir)
    return rows.select(
        F.col("device_type").alias("host"),
        F.when(F.col("k") % 2 == 0, "cpu").otherwise("memory").alias("resource_type"),
        F.col("price").alias("metric_value"),
        F.date_trunc("minute", "timestamp").cast("timestamp_ntz").alias("recorded_at"),
    )


RESOURCES = """resources AS (SELECT device_type AS host, CASE WHEN k % 2 = 0 THEN 'cpu' ELSE 'memory' END AS resource_type,
    price AS metric_value, date_trunc('minute', "timestamp") AS recorded_at FROM silver)"""


# ---- orders, customers, products ------------------------------------------------


def customer_id_of_order() -> Column:
    return F.col("o_custkey").cast("string")


def product_id_of_line() -> Column:
    return F.concat(F.lit("prod_"), F.col("l_partkey").cast("string"))


def order_items(spark, sf_dir) -> DataFrame:
    """Order lines as given, under the name that orders have for their key."""
    return given(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")


def order_heads(spark, sf_dir) -> DataFrame:
    return given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")


def lines_of(items: DataFrame, heads: DataFrame, *more: str, keys_from: DataFrame | None = None) -> DataFrame:
    """Order lines with customer and time of their order, and the columns ``more`` of either; texts and amounts are made behind the join."""
    quantity = F.col("l_quantity").cast("int")
    unit = (F.floor(cents(F.col("l_extendedprice")) / quantity).cast("decimal(16,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")
    gross = quantity * unit
    return lookup_join(items, heads, ["o_orderkey"], "inner", keys_from=keys_from).select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        customer_id_of_order().alias("customer_id"),
        product_id_of_line().alias("product_id"),
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        quantity.alias("quantity"),
        unit.alias("unit_price"),
        (gross * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,2)").alias("discount_amount"),
        (gross * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,2)").alias("tax_amount"),
        F.col("o_orderdate").alias("sold_at"),
        *more,
    )


def lines(spark, sf_dir) -> DataFrame:
    """Order lines with customer and time of their order."""
    return lines_of(order_items(spark, sf_dir), order_heads(spark, sf_dir))


LINES = """line_base AS (SELECT *, CAST(l_quantity AS INTEGER) AS q,
    CAST((CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)) * 0.01 AS DECIMAL(18,2)) AS unit
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
lines AS (SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    'prod_' || CAST(l_partkey AS VARCHAR) AS product_id, l_partkey, l_suppkey, l_linenumber, q AS quantity, unit AS unit_price,
    CAST(CAST(q AS DECIMAL(6,0)) * unit * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS discount_amount,
    CAST(CAST(q AS DECIMAL(6,0)) * unit * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS tax_amount,
    o_orderdate AS sold_at FROM line_base)"""


def numbered_lines(spark, sf_dir) -> DataFrame:
    """Lines numbered inside their order by all item fields; an order too large for a task is split by product range."""
    tie = ["l_suppkey", "l_linenumber", "quantity", "unit_price", "discount_amount", "tax_amount"]
    rows = lines(spark, sf_dir).withColumn("one", F.lit(1))
    split = F.floor(F.col("l_partkey") / 256)
    return with_running(rows, ["transaction_id"], "l_partkey", tie, {"line_no": ("sum", "one")}, large_chunk=split).drop("one")


NUMBERED = """numbered AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY l_partkey, l_suppkey, l_linenumber,
    quantity, unit_price, discount_amount, tax_amount) AS line_no FROM lines)"""


def customer_rows(spark, sf_dir) -> DataFrame:
    rows = given(spark, sf_dir, "customer")
    return rows.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_tier"),
        F.col("c_nationkey").cast("string").alias("country"),
    )


def customer_dim(spark, sf_dir) -> DataFrame:
    """Customers with history: those with even keys changed their tier on one day."""
    base = customer_rows(spark, sf_dir)
    first = open_versions(base, "customer_id", F.lit(date(1990, 1, 1)))
    even = base.where(F.col("customer_id").cast("bigint") % 2 == 0)
    changed = even.withColumn("customer_tier", F.concat("customer_tier", F.lit("_PLUS")))
    return scd2_upsert(first, changed, "customer_id", ["customer_tier"], F.lit(VERSION_DAY))


CUSTOMER_DIM = """customer_dim AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, c_mktsegment AS customer_tier,
    CAST(c_nationkey AS VARCHAR) AS country, DATE '1990-01-01' AS effective_date,
    CASE WHEN c_custkey % 2 = 0 THEN DATE '1998-01-01' END AS expiration_date, c_custkey % 2 <> 0 AS is_current FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), c_name, c_mktsegment || '_PLUS', CAST(c_nationkey AS VARCHAR), DATE '1998-01-01', NULL, TRUE
  FROM customer WHERE c_custkey % 2 = 0)"""


def product_rows(spark, sf_dir) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(10,2)")
    return given(spark, sf_dir, "part").select(
        F.concat(F.lit("prod_"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        price.alias("unit_price"),
        (price * F.lit(Decimal("0.60"))).cast("decimal(10,2)").alias("cost"),
    )


def product_dim(spark, sf_dir) -> DataFrame:
    return dim_product(None, product_rows(spark, sf_dir))


PRODUCT_ROWS = """product_rows AS (SELECT 'prod_' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
    p_brand AS brand, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
    CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 0.60 AS DECIMAL(10,2)) AS cost FROM part)"""
