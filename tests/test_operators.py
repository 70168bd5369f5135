"""Operators on small hand-written frames: nulls, ties, empty input, zero denominators."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rillmark.operators import aggregates as agg
from rillmark.operators import behaviour as beh
from rillmark.operators import layers, links, mart, orders
from rillmark.operators import quality as q
from rillmark.operators import warehouse as wh
from rillmark.schemas import CATEGORIES
from rillmark.sinks.messages import to_messages
from rillmark.sinks.tables import append_new, apply_retention, write_compacted, write_partitions

T0 = datetime(2024, 1, 1, 10)
EVENT = "event_id string, user_id string, session_id string, event_type string, device_type string, price double, timestamp timestamp, event_date date, product_id string"


def event(i, kind, minute=0, user="u1", session="s1", price=None, device="mobile", product=None):
    at = T0 + timedelta(minutes=minute)
    return (str(i), user, session, kind, device, price, at, at.date(), product)


@pytest.fixture(scope="module")
def shop(spark):
    """Two sessions: one bought, one only put something into the cart."""
    return spark.createDataFrame(
        [
            event(1, "search", 0),
            event(2, "page_view", 1, price=19.99, product="p1"),
            event(3, "add_to_cart", 2, price=19.99, product="p1"),
            event(4, "add_to_cart", 3, price=5.01, product="p2"),
            event(5, "checkout_started", 4),
            event(6, "checkout_completed", 5),
            event(7, "page_view", 0, "u2", "s2", 7.0, "desktop", "p3"),
            event(8, "add_to_cart", 1, "u2", "s2", 7.0, "desktop", "p3"),
            event(9, "page_view", 600, None, "s3", 1.0, "tablet"),
        ],
        EVENT,
    ).cache()


# ---- aggregates -------------------------------------------------------------------


def test_hourly_counts_users_and_rows_with_a_user(shop):
    out = {(r["event_type"], r["device_type"]): r for r in agg.hourly_metrics(shop).collect()}
    tablet = out[("page_view", "tablet")]
    assert (tablet["event_count"], tablet["user_events"], tablet["unique_users"]) == (1, 0, 0)
    cart = out[("add_to_cart", "mobile")]
    assert (cart["event_count"], cart["unique_users"], cart["total_value"], cart["avg_price"]) == (2, 1, 25.0, 12.5)
    assert out[("search", "mobile")]["avg_price"] is None


def test_kpis_by_hand(shop):
    out = {(r["metric_name"], tuple((r["tags"] or {}).items())): r["metric_value"] for r in agg.kpis(agg.hourly_metrics(shop)).collect()}
    assert out[("pipeline.events.total", ())] == 9
    assert out[("business.conversion.overall", ())] == pytest.approx(100 / 3)
    assert out[("pipeline.events.by_type", (("event_type", "add_to_cart"),))] == 3
    assert out[("business.funnel.checkout_completed", ())] == 1
    assert out[("pipeline.quality.score", ())] == 100


def test_conversion_without_page_views_is_zero(shop):
    gold = agg.hourly_metrics(shop.where("event_type = 'search'"))
    out = {r["metric_name"]: r["metric_value"] for r in agg.kpis(gold).collect()}
    assert out["business.conversion.overall"] == 0.0 and "business.funnel.page_view" not in out


def test_latency_is_nearest_rank(spark):
    df = spark.range(1, 101).select(F.lit(T0).alias("a"), (F.lit(T0) + F.make_dt_interval(secs=F.col("id"))).alias("b"))
    row = agg.latency_summary(df, "a", "b").first()
    assert (row["samples"], row["mean_latency"], row["p_latency"]) == (100, 50.5, 96)


def test_shares_add_up(shop):
    assert sum(r["share_pct"] for r in agg.distribution(shop, "event_type").collect()) == pytest.approx(100)
    assert "SinglePartition" not in plan(agg.distribution(shop, "event_type")).split("Subquery")[0].replace("rangepartitioning", "")


# ---- behaviour ----------------------------------------------------------------------


def test_funnel_and_zero_guard(shop):
    out = {r["session_id"]: tuple(r)[1:] for r in beh.session_funnel(shop).collect()}
    assert out == {"s1": (1, 1, 1, 1, 1), "s2": (1, 0, 1, 0, 0), "s3": (1, 0, 0, 0, 0)}
    none_searched = beh.step_conversion(beh.session_funnel(shop.where("session_id = 's2'"))).first()
    assert tuple(none_searched) == (0.0, None, 0.0, None)


def test_ordered_funnel_stops_at_a_stage_out_of_order(shop):
    out = {r["session_id"]: tuple(r)[1:] for r in beh.session_funnel(shop, ordered=True).collect()}
    assert out["s1"] == (1, 0, 0, 0, 0)  # the search came before the page view
    assert out["s2"] == (1, 0, 0, 0, 0)


def test_cohorts_over_two_months(spark):
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 5)), ("a", datetime(2024, 2, 5)), ("b", datetime(2024, 1, 9)), ("c", datetime(2024, 2, 1)), ("a", None)],
        "user_id string, timestamp timestamp",
    ).withColumn("event_type", F.lit("page_view"))
    out = rows(beh.cohort_retention(df))
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    assert out == [(jan, jan, 2, 100.0), (jan, feb, 1, 50.0), (feb, feb, 1, 100.0)]
    assert beh.cohort_retention(df, anchor="purchase").count() == 0


def test_rfm_prefers_cart_total(spark):
    df = spark.createDataFrame(
        [("a", "checkout_completed", None, 30.0, T0), ("b", "checkout_completed", 4.0, None, T0 - timedelta(days=3))],
        "user_id string, event_type string, price double, cart_total double, timestamp timestamp",
    )
    out = {r["user_id"]: r for r in beh.rfm(df, datetime(2024, 1, 11), value=F.coalesce("cart_total", "price")).collect()}
    assert (out["a"]["monetary"], out["a"]["recency"], out["a"]["rfm_score"]) == (30.0, 10, "212")
    assert (out["b"]["monetary"], out["b"]["recency"], out["b"]["rfm_score"]) == (4.0, 13, "121")


def test_journeys_keep_order_and_cut_before_the_shuffle(shop):
    out = {r["user_id"]: r["journey_path"] for r in beh.journeys(shop).collect()}
    assert out == {"u1": ["search", "page_view", "add_to_cart", "add_to_cart", "checkout_started"]}
    assert "WindowGroupLimit" in plan(beh.journeys(shop))


def test_sessions_split_by_gap_and_by_purchase(spark):
    minutes = [0, 29, 59, 60 + 31 + 59, 400, 401]
    kinds = ["page_view", "checkout_completed", "page_view", "page_view", "page_view", "page_view"]
    df = spark.createDataFrame([event(i, k, m) for i, (m, k) in enumerate(zip(minutes, kinds))] + [event(99, "search", 5, None)], EVENT)
    by_gap = {r["event_id"]: r["session_number"] for r in beh.sessionize(df, timedelta(minutes=30)).collect()}
    assert by_gap == {"0": 1, "1": 1, "2": 1, "3": 2, "4": 3, "5": 3, "99": None}
    ends = {r["event_id"]: r["session_number"] for r in beh.sessionize(df, timedelta(minutes=30), "checkout_completed").collect()}
    assert ends == {"0": 1, "1": 1, "2": 2, "3": 3, "4": 4, "5": 4, "99": None}


def test_long_session_of_a_hot_user(spark):
    """One user with an event every ten minutes for a month is one session, over 700 chunks."""
    df = spark.range(4320).select(
        F.col("id").cast("string").alias("event_id"), F.lit("hot").alias("user_id"), F.lit("page_view").alias("event_type"),
        (F.lit(T0) + F.make_dt_interval(mins=F.col("id") * 10)).alias("timestamp"),
    )
    out = beh.sessionize(df, timedelta(minutes=30)).agg(F.max("session_number"), F.min("session_start"), F.max("session_start")).first()
    assert tuple(out) == (1, T0, T0)


def test_gaps(shop):
    out = beh.gaps(shop, "timestamp", ["event_type"], ["event_id"], timedelta(minutes=30)).collect()
    assert [(r["event_type"], r["gap_seconds"]) for r in out] == [("page_view", 599 * 60)]


def test_running_cart(shop):
    out = {r["event_id"]: (r["cart_item_count"], r["cart_total"]) for r in beh.running_cart(shop).collect()}
    assert out == {"3": (1, 19.99), "4": (2, 25.0), "8": (1, 7.0)}


# ---- orders ---------------------------------------------------------------------------


def test_only_completed_carts_become_orders(shop):
    out = orders.assemble_orders(shop).orderBy("line_no").collect()
    assert [(r["session_id"], r["line_no"], r["product_id"], r["price_cents"], r["total_items"]) for r in out] == [
        ("s1", 1, "p1", 1999, 2), ("s1", 2, "p2", 501, 2),
    ]


def test_items_survive_nesting_in_pages(spark):
    lines = spark.range(1, 26).select(F.lit("o").alias("o"), F.col("id").alias("line_no"), (F.col("id") * 3).alias("product_id"))
    nested = orders.nest_items(lines, "o", "line_no", ["product_id"], 10)
    assert sorted(len(r["items"]) for r in nested.collect()) == [5, 10, 10]
    assert rows(layers.explode_items(nested, ["o"]).select("product_id")) == rows(lines.select("product_id"))


@pytest.mark.parametrize(
    "price, tier, country, pct, expected",
    [
        ("19.99", "regular", "US", None, (1999, 139, 500, 0, 2638)),
        ("19.99", "new", "DE", None, (1599, 111, 1500, 0, 3210)),
        ("100.00", "regular", "DE", None, (10000, 700, 0, 0, 10700)),
        ("83.21", "regular", "US", 0.25, (8321, 582, 500, 2080, 7323)),
        ("60.00", "vip", "US", 0.10, (12000, 840, 0, 1200, 11640)),
        ("1.00", None, "US", None, (100, 7, 500, 0, 607)),
    ],
)
def test_order_pricing(spark, price, tier, country, pct, expected):
    lines = spark.createDataFrame([("o", "u", country, Decimal(price), pct)], "order_id string, user_id string, country string, price decimal(10,2), discount_pct double")
    users = spark.createDataFrame([("u", tier)], "user_id string, tier string")
    row = orders.price_orders(lines, users).first()
    names = ("subtotal_cents", "tax_cents", "shipping_cents", "discount_cents", "total_cents")
    assert tuple(row[n] for n in names) == expected
    checked = q.order_flags(orders.price_orders(lines, users).withColumn("item_count", F.col("total_items"))).first()
    assert checked["total_ok"] and checked["items_ok"]


def test_order_checks(spark):
    df = spark.createDataFrame(
        [(4200, 300, 250, 50, 4700, 1, [1]), (4200, 300, 250, 50, 4701, 1, [1]), (1, 0, 0, 0, 1, 0, []), (1, 0, 0, 0, 1, 2, [1])],
        "subtotal_cents long, tax_cents long, shipping_cents long, discount_cents long, total_cents long, total_items int, items array<int>",
    )
    assert {r["name"]: r["failed"] for r in q.check_orders(df).collect()} == {"total_reconciles": 1, "has_items_and_count_matches": 2}


# ---- layers ----------------------------------------------------------------------------


def _raw(spark, texts):
    data = [(None, t.encode() if t is not None else None, "clickstream", 0, i, T0) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")


GOOD = '{"event_id":"1","user_id":"u","session_id":"s","event_type":"search","device_type":"mobile","timestamp":"2024-01-31T23:59:59Z","price":1.5}'


def test_parse_good_and_bad_text(spark):
    texts = [GOOD, GOOD[:30], GOOD.replace("1.5", '"many"'), "", None, GOOD.replace("2024-01-31T23:59:59Z", "garbage")]
    parsed = layers.parse_events(layers.with_lineage(_raw(spark, texts)))
    good, bad = layers.split_malformed(parsed)
    assert parsed.count() == 6
    assert {r["kafka_offset"] for r in bad.collect()} >= {1, 2}
    first = good.where("kafka_offset = 0").first()
    assert (first["event_hour"], str(first["event_date"]), str(first["event_month"])) == (23, "2024-01-31", "2024-01-01")
    assert good.where("kafka_offset = 5").first()["event_ts"] is None


def test_json_is_parsed_once_per_row(spark):
    parsed = layers.parse_events(layers.with_lineage(_raw(spark, [GOOD])))
    valid, _ = layers.split_invalid(parsed.where("_corrupt_record is null"))
    assert plan(valid).count("from_json") == 1


def test_rejects_carry_all_reasons(spark):
    texts = [GOOD, GOOD.replace("search", "flying"), GOOD.replace("mobile", "fridge").replace('"u"', "null")]
    _, bad = layers.split_invalid(layers.parse_events(_raw(spark, texts)))
    assert sorted(r["reasons"] for r in bad.collect()) == [["missing_required", "unknown_device_type"], ["unknown_event_type"]]


def test_dedupe_keeps_the_first_and_separates_sessions(spark):
    df = spark.createDataFrame([("s1", "e", 3), ("s1", "e", 1), ("s2", "e", 2)], "session_id string, event_id string, o int")
    assert rows(layers.dedupe(df, ["session_id", "event_id"], ["o"])) == [("s1", "e", 1), ("s2", "e", 2)]
    assert layers.dedupe(df, ["session_id", "event_id"]).count() == 2


def test_categories_by_priority(spark):
    df = spark.createDataFrame([("BOOKS about laptops",), ("new laptops",), ("board games",), ("nothing",), (None,)], "t string")
    out = [r["search_category"] for r in layers.categorise_queries(df, "t", CATEGORIES).collect()]
    assert out == ["Books", "Electronics", "Toys & Games", None, None]


def test_messages_have_a_key_and_keep_nulls(spark):
    df = spark.createDataFrame([("u", "t", None), (None, "t", None), ("", "t", "x")], "user_id string, transaction_id string, note string")
    out = to_messages(df).collect()
    assert [r["key"] for r in out] == ["u", "t", "t"] and '"note":null' in out[0]["value"]


# ---- joins --------------------------------------------------------------------------------


def test_as_of_join_takes_the_last_at_or_before(spark):
    at = lambda m: T0 + timedelta(minutes=m)
    points = spark.createDataFrame([(1, "a", at(0)), (2, "a", at(10)), (3, "a", at(500)), (4, "b", at(5))], "id int, k string, ts timestamp")
    history = spark.createDataFrame([("a", at(10), 1.0), ("a", at(100), 2.0), ("a", at(600), 3.0)], "k string, ts timestamp, v double")
    out = {r["id"]: r["v"] for r in links.as_of_join(points, history, ["k"], "ts", "v").collect()}
    assert out == {1: None, 2: 1.0, 3: 2.0, 4: None}


def test_orphans_include_null_keys(spark):
    fact = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert rows(links.orphans(fact, spark.createDataFrame([("a",)], "k string"), "k")) == [("b",), (None,)]


# ---- quality --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def clean(spark):
    """1,000 rows, 100 sessions of one user each."""
    kinds = F.array(*[F.lit(k) for k in ("page_view", "search", "add_to_cart", "checkout_started", "checkout_completed")])
    devices = F.array(*[F.lit(k) for k in ("mobile", "desktop", "tablet")])
    i = F.col("id")
    return spark.range(1000).select(
        (i % 50).cast("string").alias("user_id"), (i % 100).cast("string").alias("session_id"),
        F.get(kinds, (i % 5).cast("int")).alias("event_type"), F.get(devices, (i % 3).cast("int")).alias("device_type"),
        (F.lit(T0) + F.make_dt_interval(mins=i)).alias("timestamp"), (i % 490 + 10).cast("double").alias("price"), (i % 9 + 1).cast("int").alias("quantity"),
    )


def test_nineteen_expectations_pass(clean):
    checks = q.run_suites(clean, T0)
    assert checks.count() == 19 and checks.where("not passed").count() == 0
    assert q.gate(checks).first()["approved"]


def test_empty_table_gives_no_checks_and_a_blocked_gate(clean):
    checks = q.run_suites(clean.where("false"), T0)
    assert checks.count() == 0
    assert q.gate(checks).first()["approved"] is False


def test_gate_policies_differ(clean):
    bad_price = q.run_suites(clean.withColumn("price", F.lit(-1.0)), T0)
    assert not q.gate(bad_price, q.VALIDATION_POLICY).first()["approved"]
    assert q.gate(bad_price, q.WRITE_POLICY).first()["approved"]


def test_null_prices_by_policy(clean):
    some = clean.withColumn("price", F.when(F.col("price") > 100, F.col("price")))
    assert q.check_range(some).where("not passed").count() == 0
    assert q.check_range(some, nulls="fail").where("not passed").count() == 1


def test_missing_columns_fail(clean):
    out = {r["name"]: r["passed"] for r in q.check_not_null(clean.drop("user_id")).collect()}
    assert out["no_nulls_user_id"] is False
    assert q.check_schema(clean.drop("user_id")).where("not passed").count() == 1
    assert q.check_schema(clean.withColumn("timestamp", F.col("timestamp").cast("string"))).where("not passed").count() == 1


def test_session_with_two_users(clean):
    mixed = clean.withColumn("user_id", F.when(F.col("price") == 10, "other").otherwise(F.col("user_id")))
    assert q.check_one_to_one(mixed).first()["failed"] > 0


def test_single_row_checks_are_one_pass(clean):
    checks = q.not_null_checks(clean) + q.range_checks(clean) + q.domain_checks(clean) + q.complete_checks(clean)
    assert plan(q.evaluate(clean, checks)).count("Range (") == 1


def test_report_round_trip(spark, clean):
    nested = q.report(q.run_suites(clean, T0), "2024-01-01T00:00:00").first()
    assert nested["total_suites"] == 7 and nested["summary"]["total_passed"] == 19


def test_weights(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 0.5), ("b", 0.7), ("c", 1.2), ("c", -0.2)], "g string, w double")
    assert q.check_weights(df, "g", "w").first()["failed"] == 2


# ---- mart ------------------------------------------------------------------------------------


METRICS = "metric_name string, metric_value double, recorded_at timestamp"


def test_rate_needs_two_points(spark):
    one = spark.createDataFrame([("m", 5.0, T0)], METRICS)
    assert mart.metric_rate(one, "m", timedelta(minutes=5), T0).first()["rate_per_sec"] is None
    two = spark.createDataFrame([("m", 5.0, T0 - timedelta(minutes=10)), ("m", 35.0, T0)], METRICS)
    assert mart.metric_rate(two, "m", timedelta(minutes=5), T0).first()["rate_per_sec"] == pytest.approx(0.1)
    assert mart.metric_rate(two, "m", timedelta(minutes=5), T0, exact=True).first()["rate_per_sec"] == pytest.approx(0.05)


def test_alerts_by_severity_then_age(spark):
    data = [("a", "info", "firing", 1), ("b", "critical", "firing", 2), ("c", "warning", "firing", 3), ("d", "warning", "firing", 4), ("e", "critical", "resolved", 5)]
    df = spark.createDataFrame([(n, s, st, "m", 1.0, 2.0, T0 + timedelta(minutes=m)) for n, s, st, m in data],
                               "alert_name string, severity string, status string, message string, actual_value double, threshold_value double, triggered_at timestamp")
    out = mart.active_alerts(df, T0 + timedelta(minutes=10)).collect()
    assert [r["alert_name"] for r in out] == ["b", "d", "c", "a"] and out[0]["age_seconds"] == 480


def test_alert_rules(spark):
    point = lambda name, value, minute: (name, float(value), T0 - timedelta(minutes=minute))
    df = spark.createDataFrame(
        [point("pipeline.events.rate", 5, 1), point("pipeline.events.rate", 7, 4), point("pipeline.events.rate", 99, 30),
         point("pipeline.error.rate", 9, 2), point("pipeline.error.rate", 1, 12)],
        METRICS,
    )
    out = {r["alert_name"]: r["status"] for r in mart.evaluate_alerts(df, mart.ALERT_RULES, T0).collect()}
    assert out == {"low_event_rate": "firing", "failed_run": "resolved", "error_rate": "resolved", "no_events": "firing"}


def test_bands(spark):
    df = spark.createDataFrame([("pipeline.events.rate", 9.9), ("pipeline.events.rate", 10.0), ("pipeline.events.rate", 40.0),
                                ("pipeline.run.duration", 601.0), ("pipeline.run.duration", 600.0), ("pipeline.run.duration", 1.0), ("x", 1.0)],
                               "metric_name string, metric_value double")
    assert [r["band"] for r in mart.band(df).collect()] == ["critical", "warning", "normal", "critical", "warning", "normal", None]


# ---- warehouse --------------------------------------------------------------------------------


def test_date_dimension(spark):
    dim = wh.dim_date(spark)
    assert dim.count() == 1096
    row = dim.where("date_key = 20241230").first()
    assert (row["day_of_week"], row["day_name"], row["week_of_year"], row["quarter_actual"], row["is_weekend"]) == (1, "Monday", 1, 4, False)


def test_customer_history(spark):
    schema = "customer_id string, name string, tier string"
    day = lambda d: F.lit(date(2024, 1, d))
    dim = wh.open_versions(spark.createDataFrame([("1", "a", "new"), ("2", "b", "new"), ("3", "c", "vip")], schema), "customer_id", day(1))
    step = wh.scd2_upsert(dim, spark.createDataFrame([("1", "a", "vip"), ("2", "b", "new"), ("4", "d", "new")], schema), "customer_id", ["tier"], day(10))
    out = [(r["customer_id"], r["tier"], str(r["effective_date"]), str(r["expiration_date"]), r["is_current"]) for r in step.orderBy("customer_id", "effective_date").collect()]
    assert out == [
        ("1", "new", "2024-01-01", "2024-01-10", False), ("1", "vip", "2024-01-10", "None", True),
        ("2", "new", "2024-01-01", "None", True), ("3", "vip", "2024-01-01", "None", True), ("4", "new", "2024-01-10", "None", True),
    ]
    assert step.select("customer_key").distinct().count() == 5
    again = wh.scd2_upsert(step, spark.createDataFrame([("1", "a", "vip")], schema), "customer_id", ["tier"], day(20))
    assert rows(again) == rows(step)
    same_day = wh.scd2_upsert(step, spark.createDataFrame([("1", "a", "regular")], schema), "customer_id", ["tier"], day(10))
    assert same_day.where("customer_id = '1'").count() == 2
    assert same_day.where("customer_id = '1' and is_current").first()["tier"] == "regular"


# ---- sinks --------------------------------------------------------------------------------------


def test_partition_overwrite_is_idempotent(spark, shop, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(shop, path, ["event_date"])
    write_partitions(shop.where("event_type = 'search'"), path, ["event_date"])
    assert spark.read.parquet(path).count() == 1
    write_partitions(shop, path, ["event_date"])
    write_partitions(shop, path, ["event_date"])
    assert spark.read.parquet(path).count() == 9


def test_compaction_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(1000).select((F.col("id") % 2).alias("day"), "id", F.lit("x").alias("kind"))
    df.repartition(20).write.partitionBy("day").parquet(path)
    write_compacted(spark, path, F.col("day") == 0, ["day"], ["kind", "id"], 3)
    back = spark.read.parquet(path)
    assert rows(back.select("day", "id")) == rows(df.select("day", "id"))
    files = back.where("day = 0").withColumn("f", F.input_file_name()).select("f").distinct().count()
    assert files <= 3


def test_insert_if_absent_and_retention(spark, tmp_path):
    path = str(tmp_path / "a")
    append_new(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), path, ["k"])
    append_new(spark.createDataFrame([(1, "c"), (2, "d")], "k int, v string"), path, ["k"])
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [1, 2]
    old = spark.createDataFrame([(T0,), (T0 - timedelta(days=8),)], "t timestamp")
    assert apply_retention(old, "t", timedelta(days=7), T0).count() == 1


# ---- arrivals ---------------------------------------------------------------------------------


def test_arrivals_of_one_key_must_agree_or_be_ordered(spark):
    columns = "customer_id string, customer_name string, customer_tier string, country string"
    first = wh.open_versions(spark.createDataFrame([("c0", "a", "new", "US")], columns), "customer_id", F.lit(date(2020, 1, 1)))
    today = F.lit(date(2024, 1, 1))

    def upsert(rows, **order):
        frame = spark.createDataFrame(rows, columns + (", sent int" if order else ""))
        out = wh.scd2_upsert(first, frame, "customer_id", ["customer_tier"], today, **order)
        return rows_of(out.select("customer_id", "customer_tier", "is_current"))

    rows_of = rows
    same = ("c1", "b", "vip", "DE")
    assert upsert([same, same]) == [("c0", "new", True), ("c1", "vip", True)]
    with pytest.raises(Exception, match="different rows arrive for one key: c1"):
        upsert([same, ("c1", "b", "new", "DE")])
    ordered = [("c0", "a", "vip", "US", 2), ("c0", "a", "zzz", "US", 1), ("c1", "b", "new", "DE", 5)]
    assert upsert(ordered, order=["sent"]) == [("c0", "new", False), ("c0", "vip", True), ("c1", "new", True)]


def test_surrogate_keys_tell_null_from_text(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("", "a"), (None, "a"), ("a\x1f=b", None), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(wh.surrogate_key("x", "y")).collect()]
    assert len(set(keys)) == 6 and all(len(k) == 32 for k in keys)


def test_pages_of_an_order_are_judged_together(spark):
    lines = spark.range(1, 151).select(F.lit("o").alias("order_id"), F.col("id").alias("line_no"), (F.col("id") * 3).alias("product_id"))
    pages = orders.nest_items(lines, "order_id", "line_no", ["product_id"])
    assert sorted(len(r["items"]) for r in pages.collect()) == [50, 100]
    sums = {c: F.lit(0) for c in ("subtotal_cents", "tax_cents", "shipping_cents", "discount_cents", "total_cents")}
    checks = {r["name"]: r["failed"] for r in q.check_orders(pages.withColumns(sums | {"total_items": F.lit(150)})).collect()}
    assert checks == {"total_reconciles": 0, "has_items_and_count_matches": 0}


@pytest.mark.parametrize("most", [0, 500_000])
def test_stored_rows_once(spark, monkeypatch, most):
    monkeypatch.setattr(layers, "BROADCAST_KEYS", most)
    df = spark.range(2000).select((F.col("id") % 1700).cast("string").alias("k"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("x"), (-F.col("id")).alias("at"))
    for keys in (["k"], ["x"]):
        assert rows(layers.dedupe_stored(df, keys, ["at"])) == rows(layers.dedupe(df, keys, ["at"]))
    text = plan(layers.dedupe_stored(df, ["k"], ["at"]))
    assert "BroadcastHashJoin" in text or not most
    assert layers.dedupe_stored(df.limit(0), ["k"], ["at"]).count() == 0
