"""Registered queries: hourly table, distributions, customer analytics."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from rillmark.catalog.registry import AS_OF, AS_OF_SQL, query
from rillmark.catalog.tables import GOLD, SILVER, given, gold, kpi_sql, silver
from rillmark.functions.columns import since
from rillmark.operators import aggregates as agg
from rillmark.operators import audience as aud
from rillmark.operators import behaviour as beh
from rillmark.operators import layers, orders
from rillmark.schemas import CATEGORIES
from rillmark.session import cut_lineage

CENTS = "CAST(sum(CAST(round({0} * 100) AS BIGINT)) AS DOUBLE) / 100"
STAGES = (("viewed", "page_view"), ("searched", "search"), ("added_cart", "add_to_cart"),
          ("started_checkout", "checkout_started"), ("purchased", "checkout_completed"))
STEP_SQL = ", ".join(
    f"CAST(sum({b}) AS DOUBLE) / nullif(CAST(sum({a}) AS DOUBLE), 0) * 100 AS {a}_to_{b}_pct"
    for (a, _), (b, _) in zip(STAGES, STAGES[1:])
)
FLAGS_SQL = ", ".join(f"max(CASE WHEN event_type = '{kind}' THEN 1 ELSE 0 END) AS {name}" for name, kind in STAGES)
FUNNEL = f"funnel AS (SELECT session_id, {FLAGS_SQL} FROM silver GROUP BY session_id)"


@query("SELECT * FROM gold", (SILVER, GOLD))
def hourly_metrics(spark, d):
    return gold(spark, d)


@query(
    """SELECT event_date, event_hour, event_type, device_type, event_count, user_events, priced_count, avg_price, total_value,
      TRUE AS users_close FROM gold""",
    (SILVER, GOLD),
)
def hourly_metrics_approx(spark, d):
    """Approximate users, reported as being within 5 % of the exact count."""
    rows = agg.hourly_metrics(silver(spark, d), "approx").drop("users_sketch")
    exact = gold(spark, d).select(*agg.HOUR_KEYS, F.col("unique_users").alias("exact_users"))
    close = F.abs(F.col("unique_users") - F.col("exact_users")) <= F.greatest(F.lit(1.0), F.col("exact_users") * 0.05)
    return rows.join(exact, agg.HOUR_KEYS).withColumn("users_close", close).drop("unique_users", "exact_users")


@query("SELECT event_type, TRUE AS users_close FROM silver GROUP BY event_type", (SILVER,))
def merged_user_sketches(spark, d):
    """Users per type merged from hourly sketches, within 5 % of the exact count."""
    hourly = agg.hourly_metrics(silver(spark, d), "approx")
    exact = agg.distinct_per_group(silver(spark, d), ["event_type"], "user_id")
    both = agg.merged_users(hourly, ["event_type"]).join(exact, "event_type")
    return both.select(
        "event_type", (F.abs(F.col("unique_users") - F.col("distinct_values")) <= F.col("distinct_values") * 0.05).alias("users_close")
    )


@query("SELECT event_type, TRUE AS users_close FROM silver GROUP BY event_type", (SILVER,))
def approx_users_by_type(spark, d):
    exact = agg.distinct_per_group(silver(spark, d), ["event_type"], "user_id")
    both = agg.approx_users(silver(spark, d), ["event_type"]).join(exact, "event_type")
    return both.select(
        "event_type", (F.abs(F.col("approx_users") - F.col("distinct_values")) <= F.col("distinct_values") * 0.05).alias("users_close")
    )


@query("SELECT event_type, count(DISTINCT user_id) AS distinct_values FROM silver GROUP BY 1", (SILVER,))
def distinct_users_by_type(spark, d):
    return agg.distinct_per_group(silver(spark, d), ["event_type"], "user_id")


@query(
    """SELECT event_type, count(*) AS n, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100 AS share_pct
    FROM silver GROUP BY 1""",
    (SILVER,),
)
def event_distribution(spark, d):
    return agg.distribution(silver(spark, d), "event_type")


@query(
    """SELECT device_type, count(*) AS n, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100 AS share_pct
    FROM silver GROUP BY 1""",
    (SILVER,),
)
def device_distribution(spark, d):
    return agg.distribution(silver(spark, d), "device_type")


@query(
    """SELECT c_mktsegment, count(*) AS n, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100 AS share_pct
    FROM customer GROUP BY 1"""
)
def tier_distribution(spark, d):
    return agg.distribution(given(spark, d, "customer"), "c_mktsegment")


@query(
    """SELECT count(*) AS total_rows, count(event_type) AS valid_rows,
    CAST(count(event_type) AS DOUBLE) / count(*) * 100 AS valid_pct FROM silver""",
    (SILVER,),
)
def valid_row_rate(spark, d):
    return agg.valid_rate(silver(spark, d), "event_type")


@query(
    f"""SELECT *, CAST(total_user_events AS DOUBLE) / total_events * 100 AS users_per_event_pct,
      revenue / CAST(total_user_events AS DOUBLE) AS revenue_per_user
    FROM (SELECT {CENTS.format('total_value')} AS revenue, CAST(sum(event_count) AS BIGINT) AS total_events,
      CAST(sum(user_events) AS BIGINT) AS total_user_events,
      CAST(sum(CAST(avg_price AS DECIMAL(28,10))) AS DOUBLE) / count(avg_price) AS mean_avg_price FROM gold) t""",
    (SILVER, GOLD),
)
def gold_rollup(spark, d):
    return agg.gold_rollup(gold(spark, d))


@query(f"SELECT metric_name, metric_value, metric_unit, tag FROM ({kpi_sql('')}) k", (SILVER, GOLD))
def exported_kpis(spark, d):
    rows = agg.kpis(gold(spark, d))
    tag = F.coalesce(F.try_element_at("tags", F.lit("event_type")), F.try_element_at("tags", F.lit("device_type")))
    return rows.withColumn("tag", tag).drop("tags")


@query("SELECT * FROM funnel", (SILVER, FUNNEL))
def session_funnel(spark, d):
    return beh.session_funnel(silver(spark, d))


FIRSTS = "firsts AS (SELECT session_id, " + ", ".join(
    f"min(CASE WHEN event_type = '{kind}' THEN \"timestamp\" END) AS t{i}" for i, (_, kind) in enumerate(STAGES)
) + " FROM silver GROUP BY 1)"
REACHED = "SELECT session_id, " + ", ".join(
    f"CASE WHEN t0 IS NOT NULL{''.join(f' AND t{j} >= t{j-1}' for j in range(1, i + 1))} THEN 1 ELSE 0 END AS {name}"
    for i, (name, _) in enumerate(STAGES)
) + " FROM firsts"


@query(REACHED, (SILVER, FIRSTS))
def session_funnel_ordered(spark, d):
    return beh.session_funnel(silver(spark, d), ordered=True)


def _in_order_sql(limit: str) -> tuple[str, ...]:
    """A common table per stage: its events behind one that reached the stage before."""
    near = f' AND e."timestamp" <= b."timestamp" + INTERVAL {limit}' if limit else ""
    out = [f"r0 AS (SELECT session_id, \"timestamp\", event_id FROM silver WHERE event_type = '{STAGES[0][1]}')"]
    for i, (_, kind) in list(enumerate(STAGES))[1:]:
        out.append(
            f"""r{i} AS (SELECT e.session_id, e."timestamp", e.event_id FROM silver e WHERE e.event_type = '{kind}' AND EXISTS (
  SELECT 1 FROM r{i - 1} b WHERE b.session_id = e.session_id AND (b."timestamp" < e."timestamp" OR b."timestamp" = e."timestamp" AND b.event_id < e.event_id){near}))"""
        )
    flags = ", ".join(f"CASE WHEN session_id IN (SELECT session_id FROM r{i}) THEN 1 ELSE 0 END AS {name}" for i, (name, _) in enumerate(STAGES))
    return (*out, f"in_order AS (SELECT session_id, {flags} FROM (SELECT DISTINCT session_id FROM silver) s)")


@query("SELECT * FROM in_order", (SILVER, *_in_order_sql("")))
def session_funnel_in_order(spark, d):
    return beh.funnel_in_order(silver(spark, d))


@query("SELECT * FROM in_order", (SILVER, *_in_order_sql("90 MINUTE")))
def session_funnel_within(spark, d):
    """Stages in order, each step within an hour and a half."""
    return beh.funnel_in_order(silver(spark, d), within=timedelta(minutes=90))


@query(f"SELECT {STEP_SQL} FROM in_order", (SILVER, *_in_order_sql("")))
def step_conversion_in_order(spark, d):
    return beh.step_conversion(beh.funnel_in_order(silver(spark, d)))


@query(f"SELECT {STEP_SQL} FROM funnel", (SILVER, FUNNEL))
def step_conversion(spark, d):
    return beh.step_conversion(beh.session_funnel(silver(spark, d)))


@query(
    f"SELECT device_type, {STEP_SQL} FROM (SELECT session_id, device_type, {FLAGS_SQL} FROM silver GROUP BY 1, 2) f GROUP BY 1",
    (SILVER,),
)
def step_conversion_by_device(spark, d):
    return beh.step_conversion(beh.session_funnel(silver(spark, d), by=("device_type",)), by=("device_type",))


def _cohort_sql(grain: str, anchor: str) -> str:
    return f"""SELECT cohort_period, event_period, count(DISTINCT user_id) AS users,
      CAST(count(DISTINCT user_id) AS DOUBLE) / CAST(max(CASE WHEN event_period = cohort_period THEN count(DISTINCT user_id) END)
        OVER (PARTITION BY cohort_period) AS DOUBLE) * 100 AS retention_pct
    FROM (SELECT user_id, CAST(date_trunc('{grain}', "timestamp") AS DATE) AS event_period,
        CAST(date_trunc('{grain}', min({anchor}) OVER (PARTITION BY user_id)) AS DATE) AS cohort_period FROM silver) c
    WHERE event_period >= cohort_period GROUP BY 1, 2"""


@query(_cohort_sql("month", '"timestamp"'), (SILVER,))
def cohort_retention_monthly(spark, d):
    return beh.cohort_retention(silver(spark, d))


@query(_cohort_sql("week", '"timestamp"'), (SILVER,))
def cohort_retention_weekly(spark, d):
    return beh.cohort_retention(silver(spark, d), grain="week")


@query(_cohort_sql("week", "CASE WHEN event_type = 'checkout_completed' THEN \"timestamp\" END"), (SILVER,))
def cohort_retention_by_purchase(spark, d):
    return beh.cohort_retention(silver(spark, d), anchor="purchase", grain="week")


RFM = f"""rfm_base AS (SELECT user_id, CAST(date_diff('day', CAST(max("timestamp") AS DATE), CAST({AS_OF_SQL} AS DATE)) AS INTEGER) AS recency,
    count(*) AS frequency, {CENTS.format('price')} AS monetary FROM silver WHERE event_type = 'checkout_completed' GROUP BY 1)"""


@query("SELECT * FROM rfm_base", (SILVER, RFM))
def rfm_base(spark, d):
    return beh.rfm_base(silver(spark, d), AS_OF)


@query(
    """SELECT *, CAST(r_quartile AS VARCHAR) || CAST(f_quartile AS VARCHAR) || CAST(m_quartile AS VARCHAR) AS rfm_score
    FROM (SELECT *, CAST(ntile(4) OVER (ORDER BY recency DESC, user_id) AS INTEGER) AS r_quartile,
      CAST(ntile(4) OVER (ORDER BY frequency, user_id) AS INTEGER) AS f_quartile,
      CAST(ntile(4) OVER (ORDER BY monetary, user_id) AS INTEGER) AS m_quartile FROM rfm_base) q""",
    (SILVER, RFM),
)
def rfm_segments(spark, d):
    return beh.rfm(silver(spark, d), AS_OF)


@query(
    """SELECT date, dau, avg(dau) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS dau_7day_avg
    FROM (SELECT CAST("timestamp" AS DATE) AS date, count(DISTINCT user_id) AS dau FROM silver GROUP BY 1) d
    ORDER BY date DESC LIMIT 30""",
    (SILVER,),
)
def daily_active_users(spark, d):
    return beh.daily_active(silver(spark, d))


JOURNEYS = """SELECT user_id, string_agg(event_type, '>' ORDER BY step) AS journey_path, count(*) AS steps
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", event_id) AS step FROM silver) s
    WHERE step <= 5 GROUP BY 1 HAVING count(*) >= 3"""


@query(JOURNEYS, (SILVER,))
def user_journeys(spark, d):
    return beh.journeys(silver(spark, d)).withColumn("journey_path", F.array_join("journey_path", ">"))


@query(JOURNEYS + " ORDER BY user_id LIMIT 10", (SILVER,))
def user_journeys_top10(spark, d):
    return beh.journeys(silver(spark, d), limit=10).withColumn("journey_path", F.array_join("journey_path", ">"))


def _session_sql(gap: str, end_on: str) -> str:
    return f"""session_marks AS (SELECT *, CASE WHEN prev IS NULL OR "timestamp" > prev + INTERVAL {gap} {end_on} THEN 1 ELSE 0 END AS opens
    FROM (SELECT *, lag("timestamp") OVER w AS prev, lag(event_type) OVER w AS prev_type FROM silver
      WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", event_id)) p),
sessions AS (SELECT *, CAST(sum(opens) OVER w AS BIGINT) AS session_number,
    max(CASE WHEN opens = 1 THEN "timestamp" END) OVER w AS session_start
    FROM session_marks WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", event_id ROWS UNBOUNDED PRECEDING))"""


@query(
    "SELECT event_id, user_id, \"timestamp\", session_number, session_start FROM sessions", (SILVER, _session_sql("12 HOUR", ""))
)
def sessions_by_gap(spark, d):
    out = beh.sessionize(silver(spark, d), timedelta(hours=12))
    return out.select("event_id", "user_id", "timestamp", "session_number", "session_start")


@query(
    """SELECT user_id, session_number, count(*) AS events, min("timestamp") AS started_at, max("timestamp") AS ended_at,
      CAST(floor(epoch(max("timestamp") - min("timestamp"))) AS BIGINT) AS duration_seconds,
      arg_min(event_type, "timestamp") AS first_event, arg_max(event_type, "timestamp") AS last_event
    FROM sessions GROUP BY 1, 2""",
    (SILVER, _session_sql("12 HOUR", "OR prev_type = 'checkout_completed'")),
)
def session_statistics(spark, d):
    out = beh.sessionize(silver(spark, d), timedelta(hours=12), end_on="checkout_completed")
    return beh.session_stats(out, ["user_id", "session_number"])


@query(
    """SELECT user_id, prev AS gap_start, "timestamp" AS gap_end, CAST(floor(epoch("timestamp" - prev)) AS BIGINT) AS gap_seconds
    FROM (SELECT *, lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp", event_id) AS prev FROM silver) p
    WHERE "timestamp" > prev + INTERVAL 2 DAY""",
    (SILVER,),
)
def gaps_per_user(spark, d):
    return beh.gaps(silver(spark, d), "timestamp", ["user_id"], ["event_id"], timedelta(days=2))


@query(
    """SELECT event_type, prev AS gap_start, "timestamp" AS gap_end, CAST(floor(epoch("timestamp" - prev)) AS BIGINT) AS gap_seconds
    FROM (SELECT *, lag("timestamp") OVER (PARTITION BY event_type ORDER BY "timestamp", event_id) AS prev FROM silver) p
    WHERE "timestamp" > prev + INTERVAL 30 MINUTE""",
    (SILVER,),
)
def gaps_per_event_type(spark, d):
    """Holes of more than 30 minutes; a handful of series, each far too long for one task."""
    return beh.gaps(silver(spark, d), "timestamp", ["event_type"], ["event_id"], timedelta(minutes=30))


@query(
    f"""SELECT session_id, "timestamp", event_id, product_id, price, count(*) OVER w AS cart_item_count,
      CAST(sum(CAST(round(price * 100) AS BIGINT)) OVER w AS DOUBLE) / 100 AS cart_total
    FROM silver WHERE event_type = 'add_to_cart'
    WINDOW w AS (PARTITION BY session_id ORDER BY "timestamp", event_id ROWS UNBOUNDED PRECEDING)""",
    (SILVER,),
)
def running_cart(spark, d):
    return beh.running_cart(silver(spark, d))


@query(
    """SELECT a.session_id, a."timestamp", a.event_id, a.product_id, CAST(round(a.price * 100) AS BIGINT) AS price_cents, 1 AS quantity,
      row_number() OVER (PARTITION BY a.session_id ORDER BY a."timestamp", a.event_id) AS line_no, total_items, completed_at, h.user_id
    FROM silver a JOIN (SELECT session_id, count(*) FILTER (WHERE event_type = 'add_to_cart') AS total_items,
        max("timestamp") FILTER (WHERE event_type = 'checkout_completed') AS completed_at, max(user_id) AS user_id
      FROM silver GROUP BY 1) h ON a.session_id = h.session_id
    WHERE a.event_type = 'add_to_cart' AND completed_at IS NOT NULL""",
    (SILVER,),
)
def assembled_orders(spark, d):
    return orders.assemble_orders(silver(spark, d)).drop("device_type")


@query(
    f"""SELECT CAST(hour("timestamp") AS INTEGER) AS slot, count(*) AS events,
      count(*) / (CAST(sum(count(*)) OVER () AS DOUBLE) / count(*) OVER ()) AS multiplier FROM silver GROUP BY 1""",
    (SILVER,),
)
def traffic_by_hour(spark, d):
    return agg.traffic_profile(silver(spark, d), "hour")


@query(
    f"""SELECT CAST(isodow("timestamp") AS INTEGER) AS slot, count(*) AS events,
      count(*) / (CAST(sum(count(*)) OVER () AS DOUBLE) / count(*) OVER ()) AS multiplier FROM silver GROUP BY 1""",
    (SILVER,),
)
def traffic_by_weekday(spark, d):
    return agg.traffic_profile(silver(spark, d), "weekday")


@query(f"""SELECT product_id, {CENTS.format('price')} AS value FROM silver GROUP BY 1 ORDER BY value DESC, product_id LIMIT 10""", (SILVER,))
def top_products(spark, d):
    from rillmark.functions.columns import money_sum

    return agg.top_n(silver(spark, d), ["product_id"], money_sum(F.col("price")), 10)


@query("SELECT DISTINCT event_type FROM silver", (SILVER,))
def event_type_names(spark, d):
    return agg.names(silver(spark, d), "event_type")


@query(
    f"""SELECT count(*) AS events, CAST(count(*) AS DOUBLE) / 3600 AS events_per_sec FROM silver
    WHERE "timestamp" > {AS_OF_SQL} - INTERVAL 1 HOUR""",
    (SILVER,),
)
def events_last_hour(spark, d):
    return agg.recent_rate(silver(spark, d), "timestamp", timedelta(hours=1), AS_OF)


@query(f'SELECT event_id, "timestamp" FROM silver WHERE "timestamp" > {AS_OF_SQL} - INTERVAL 24 HOUR', (SILVER,))
def events_last_day(spark, d):
    return since(silver(spark, d), "timestamp", timedelta(hours=24), AS_OF).select("event_id", "timestamp")


@query(
    f"""SELECT CAST("timestamp" AS DATE) AS date, count(DISTINCT user_id) AS buyers, {CENTS.format('price')} AS revenue
    FROM silver WHERE event_type = 'checkout_completed' GROUP BY 1""",
    (SILVER,),
)
def revenue_trend(spark, d):
    from rillmark.functions.columns import money_sum

    bought = layers.filter_type(silver(spark, d), "checkout_completed")
    return bought.groupBy(F.to_date("timestamp").alias("date")).agg(
        F.countDistinct("user_id").alias("buyers"), money_sum(F.col("price")).alias("revenue")
    )


@query(
    """SELECT native_type, count(*) AS total, count(*) FILTER (WHERE price <= 100) AS succeeded,
      CAST(count(*) FILTER (WHERE price <= 100) AS DOUBLE) / count(*) * 100 AS success_pct FROM silver GROUP BY 1""",
    (SILVER,),
)
def success_rate_by_type(spark, d):
    return agg.success_rate(silver(spark, d), F.col("price") <= 100, ["native_type"])


@query(
    f"""SELECT p_type, count(*) AS products, min(p_retailprice) AS min_price, max(p_retailprice) AS max_price,
      {CENTS.format('p_retailprice')} / count(p_retailprice) AS avg_price FROM part GROUP BY 1"""
)
def catalog_profile(spark, d):
    return agg.catalog_profile(given(spark, d, "part"), "p_type", "p_retailprice")


_TRIES = [(c, c) for c in CATEGORIES] + [(s, c) for c, subs in CATEGORIES.items() for s in subs]


@query(
    "SELECT doc_id, CASE "
    + " ".join(f"WHEN contains(lower(text), '{w.lower()}') THEN '{c}'" for w, c in _TRIES)
    + " END AS search_category FROM documents"
)
def search_categories(spark, d):
    texts = given(spark, d, "documents").select("doc_id", "text")
    return layers.categorise_queries(texts, "text", CATEGORIES).select("doc_id", "search_category")


@query(
    """SELECT event_id, event_type, "timestamp" FROM silver WHERE event_id IS NOT NULL AND event_type IS NOT NULL
    AND "timestamp" IS NOT NULL ORDER BY "timestamp", event_id LIMIT 20""",
    (SILVER,),
)
def sample_rows(spark, d):
    return layers.sample_rows(silver(spark, d), ["event_id", "event_type", "timestamp"], ["timestamp", "event_id"], 20)


# ---- users over spans of days, quantiles: from stored sets and sketches ------------

DAYS = """days AS (SELECT DISTINCT user_id, CAST("timestamp" AS DATE) AS day FROM silver WHERE user_id IS NOT NULL),
cohorts AS (SELECT user_id, min(day) AS day FROM days GROUP BY 1)"""


def _sets(spark, d):
    """Daily sets from two loads: the users of the second half of the month get numbers behind those of the first."""
    events, half = silver(spark, d), F.col("timestamp") < "2024-01-16"
    first = cut_lineage(aud.user_numbers(events.where(half)))
    return events, cut_lineage(aud.user_numbers(events.where(~half), first))


@query(
    """SELECT e.day, count(DISTINCT x.user_id) AS users FROM (SELECT DISTINCT day FROM days) e JOIN days x ON x.day <= e.day AND x.day > e.day - 7 GROUP BY 1""",
    (SILVER, DAYS),
)
def active_users_seven_days(spark, d):
    events, numbers = _sets(spark, d)
    return aud.rolling_active(aud.daily_sets(events, numbers), 7)


@query(
    """SELECT c.day, o.n AS "offset", count(DISTINCT c.user_id) AS cohort_users, count(DISTINCT x.user_id) AS users
    FROM cohorts c CROSS JOIN (SELECT CAST(unnest([1, 3, 7]) AS INTEGER) AS n) o LEFT JOIN days x ON x.user_id = c.user_id AND x.day = c.day + o.n GROUP BY 1, 2""",
    (SILVER, DAYS),
)
def users_retained_after(spark, d):
    events, numbers = _sets(spark, d)
    return aud.retained(aud.cohort_sets(numbers), aud.daily_sets(events, numbers), [1, 3, 7])


@query(
    """SELECT day, TRUE AS near FROM days a WHERE EXISTS (SELECT 1 FROM days b WHERE b.day = a.day + 7) GROUP BY 1""", (SILVER, DAYS),
)
def users_back_after_a_week_sketched(spark, d):
    """Estimates of the overlap of two days, held against the exact sets: within five standard errors of the union."""
    events, numbers = _sets(spark, d)
    sets = cut_lineage(aud.daily_sets(events, numbers))
    exact = aud.retained(sets, sets, [7]).select("day", F.col("users").alias("exact"), F.col("cohort_users"))
    about = aud.sketched_overlap(aud.daily_sketches(events), 7)
    bound = 5 * F.col("cohort_users") / F.sqrt(F.lit(2.0**aud.THETA_BITS - 1))
    return about.join(exact, "day").select("day", (F.abs(F.col("users") - F.col("exact")) <= bound).alias("near"))


@query(
    """SELECT event_type, rank, TRUE AS within FROM (SELECT DISTINCT event_type FROM silver WHERE price IS NOT NULL) t, (SELECT CAST(unnest([0.05, 0.5, 0.95, 0.99]) AS DOUBLE) AS rank) r""",
    (SILVER,),
)
def price_quantiles_merged(spark, d):
    """Quantiles per event type from sketches per hour, and whether their ranks are within the bound, by counting."""
    events = silver(spark, d)
    hourly = agg.quantile_sketches(events, ["event_type", "event_date", F.hour("timestamp").alias("event_hour")], "price")
    found = cut_lineage(agg.merged_quantiles(hourly, ["event_type"], [0.05, 0.5, 0.95, 0.99]))
    errors = agg.rank_errors(events, found, ["event_type"], "price")
    return errors.select("event_type", "rank", (F.col("rank_error") <= agg.RANK_ERROR).alias("within"))
