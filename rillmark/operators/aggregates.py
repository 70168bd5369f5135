"""Group aggregates: hourly table, distributions, roll-ups, rates and profiles."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.functions.columns import cents, exact_mean, money_avg, money_sum, percent, since
from rillmark.functions.ranking import with_running_total
from rillmark.schemas import KPI_STAGES

HOUR_KEYS = ["event_date", "event_hour", "event_type", "device_type"]


def hourly_metrics(silver: DataFrame, distinct: str = "exact") -> DataFrame:
    """One row per date, hour, event type and device.

    ``user_events`` counts rows with a user; ``unique_users`` counts users,
    exactly or (``distinct="approx"``) within 1 %. The approximate form also
    carries a sketch that can be merged over groups.
    """
    users = {
        "exact": [F.countDistinct("user_id").alias("unique_users")],
        "approx": [
            F.approx_count_distinct("user_id", 0.01).alias("unique_users"),
            F.hll_sketch_agg("user_id", 14).alias("users_sketch"),
        ],
    }[distinct]
    return (
        silver.select("event_date", F.hour("timestamp").alias("event_hour"), "event_type", "device_type", "user_id", "price")
        .groupBy(*HOUR_KEYS)
        .agg(
            F.count("*").alias("event_count"),
            F.count("user_id").alias("user_events"),
            *users,
            F.count("price").alias("priced_count"),
            money_avg(F.col("price")).alias("avg_price"),
            money_sum(F.col("price")).alias("total_value"),
        )
    )


def merged_users(gold: DataFrame, by: list[str]) -> DataFrame:
    """Users per coarser group from the sketches of the hourly table."""
    return gold.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("users_sketch")).alias("unique_users"))


def approx_users(df: DataFrame, by: list[str], user: str = "user_id", rsd: float = 0.01) -> DataFrame:
    return df.groupBy(*by).agg(F.approx_count_distinct(user, rsd).alias("approx_users"))


def distinct_per_group(df: DataFrame, by: list[str], column: str) -> DataFrame:
    return df.groupBy(*by).agg(F.countDistinct(column).alias("distinct_values"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value with their share of all rows, most frequent first.

    The total is a scalar subquery: a window over all groups would put a column
    with very many values into one task.
    """
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    share = percent(F.col("n"), df.agg(F.count("*")).scalar())
    return counts.select(column, "n", share.alias("share_pct")).orderBy(F.desc("n"), column)


def valid_rate(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count(column).alias("valid_rows"),
        percent(F.count(column), F.count("*")).alias("valid_pct"),
    )


def gold_rollup(gold: DataFrame) -> DataFrame:
    """Totals of the hourly table with the two derived ratios.

    ``total_user_events`` adds up per-group counts; it is not a number of people.
    """
    sums = gold.agg(
        money_sum(F.col("total_value")).alias("revenue"),
        F.sum("event_count").alias("total_events"),
        F.sum("user_events").alias("total_user_events"),
        exact_mean(F.col("avg_price")).alias("mean_avg_price"),
    )
    return sums.select(
        "*",
        percent(F.col("total_user_events"), F.col("total_events")).alias("users_per_event_pct"),
        F.try_divide("revenue", F.col("total_user_events").cast("double")).alias("revenue_per_user"),
    )


def success_rate(df: DataFrame, ok: Column, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("succeeded"),
        percent(F.count_if(ok), F.count("*")).alias("success_pct"),
    )


def latency_summary(df: DataFrame, start: str, end: str, by: list[str] | None = None, p: float = 0.95) -> DataFrame:
    """Mean and nearest-rank percentile of ``end - start`` in seconds.

    The percentile is exact: latencies are whole seconds, so they are first
    counted per value, and the running count is taken over the distinct values;
    without groups by parts of the range, so no task holds all values.
    """
    by = by or []
    spread = df.select(*by, F.timestamp_diff("SECOND", F.col(start), F.col(end)).alias("latency")).where(
        F.col("latency").isNotNull()
    )
    counts = spread.groupBy(*by, "latency").agg(F.count("*").alias("n"))
    if by:
        whole = Window.partitionBy(*by)
        reached = F.sum("n").over(whole.orderBy("latency").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        placed = counts.select(*by, "latency", "n", reached.alias("reached"), F.sum("n").over(whole).alias("_total"))
    else:
        placed = with_running_total(counts, [F.col("latency")], "n", "reached")
    placed = placed.withColumn("skip", F.floor(F.col("_total") * p))
    return placed.groupBy(*by).agg(
        F.sum("n").alias("samples"),
        (F.sum(F.col("latency") * F.col("n")).cast("double") / F.sum("n")).alias("mean_latency"),
        F.min(F.when(F.col("reached") > F.col("skip"), F.col("latency"))).alias("p_latency"),
    )


def catalog_profile(products: DataFrame, by: str, price: str) -> DataFrame:
    """Products and price range per category."""
    return products.groupBy(by).agg(
        F.count("*").alias("products"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        money_avg(F.col(price)).alias("avg_price"),
    )


def traffic_profile(df: DataFrame, unit: str, ts: str = "timestamp") -> DataFrame:
    """Events per hour of day or ISO weekday, relative to the mean of the groups."""
    moment = F.col(ts)
    slot = F.hour(moment) if unit == "hour" else (F.weekday(moment) + 1)
    counts = df.groupBy(slot.cast("int").alias("slot")).agg(F.count("*").alias("events"))
    mean = F.sum("events").over(Window.partitionBy()) / F.count("*").over(Window.partitionBy())
    return counts.select("slot", "events", (F.col("events") / mean).alias("multiplier"))


def top_n(df: DataFrame, by: list[str], value: Column, n: int) -> DataFrame:
    """The ``n`` groups with the largest value."""
    return df.groupBy(*by).agg(value.alias("value")).orderBy(F.desc("value"), *by).limit(n)


def names(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def row_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def recent_rate(df: DataFrame, ts: str, interval: timedelta, as_of: datetime) -> DataFrame:
    """Events of the trailing interval and their rate per second."""
    seconds = interval.total_seconds()
    return since(df, ts, interval, as_of).agg(
        F.count("*").alias("events"), (F.count("*") / F.lit(seconds)).alias("events_per_sec")
    )


def kpis(gold: DataFrame, by: list[str] | None = None) -> DataFrame:
    """All exported figures of the hourly table as metric rows, in one pass.

    One aggregation per (event type, device) shrinks the table to a few dozen
    rows per group; totals and tagged rows are grouping sets of those.
    """
    by = by or []
    hour_start = F.to_timestamp(F.col("event_date")) + F.make_dt_interval(hours=F.col("event_hour"))
    complete = F.col("event_type").isNotNull() & F.col("event_date").isNotNull() & F.col("device_type").isNotNull()
    cells = gold.groupBy(*by, "event_type", "device_type").agg(
        F.sum("event_count").alias("events"),
        F.sum("user_events").alias("user_events"),
        F.sum(cents(F.col("total_value"))).alias("value_cents"),
        F.sum(F.col("avg_price").cast("decimal(28,10)")).alias("avg_sum"),
        F.count("avg_price").alias("avg_rows"),
        F.sum("priced_count").alias("priced"),
        F.count("*").alias("rows"),
        F.count_if(complete & F.col("event_count").isNotNull()).alias("complete_rows"),
        F.min(hour_start).alias("first_hour"),
        F.max(hour_start).alias("last_hour"),
    )
    of_type = {s: F.sum(F.when(F.col("event_type") == s, F.col("events"))) for s in KPI_STAGES}
    revenue = F.sum("value_cents").cast("double") / 100
    span = F.timestamp_diff("SECOND", F.min("first_hour"), F.max("last_hour")) + 3600
    plain = F.array(
        _metric("pipeline.revenue.total", revenue, "USD"),
        _metric("pipeline.events.total", F.sum("events"), "count"),
        _metric("pipeline.users.unique", F.sum("user_events"), "count"),
        _metric("pipeline.order.avg_value", F.try_divide(F.sum("avg_sum").cast("double"), F.sum("avg_rows")), "USD"),
        _metric("pipeline.order.avg_value_weighted", F.try_divide(revenue, F.sum("priced")), "USD"),
        _metric("pipeline.events.rate", F.try_divide(F.sum("events"), span), "events/sec"),
        _metric(
            "business.conversion.overall",
            F.coalesce(percent(F.coalesce(of_type["checkout_completed"], F.lit(0)), of_type["page_view"]), F.lit(0.0)),
            "percent",
        ),
        _metric("pipeline.quality.score", percent(F.sum("complete_rows"), F.sum("rows")), "percent"),
        *[_metric(f"business.funnel.{stage}", counted, "count") for stage, counted in of_type.items()],
    )
    sets = [[F.col(c) for c in keys] for keys in (by, [*by, "event_type"], [*by, "device_type"])]
    rolled = cells.groupingSets(sets, *by, "event_type", "device_type").agg(
        plain.alias("_plain"),
        F.sum("events").alias("_events"),
        F.grouping("event_type").alias("_all_types"),
        F.grouping("device_type").alias("_all_devices"),
    )
    metrics = (
        F.when((F.col("_all_types") == 1) & (F.col("_all_devices") == 1), F.col("_plain"))
        .when(F.col("_all_devices") == 1, _tagged("event_type", "pipeline.events.by_type"))
        .otherwise(_tagged("device_type", "pipeline.events.by_device"))
    )
    return rolled.select(*by, F.inline(metrics)).where(F.col("metric_value").isNotNull())


def _metric(name: str, value: Column, unit: str, tags: Column | None = None) -> Column:
    return F.struct(
        F.lit(name).alias("metric_name"),
        value.cast("double").alias("metric_value"),
        F.lit(unit).alias("metric_unit"),
        (F.lit(None) if tags is None else tags).cast("map<string,string>").alias("tags"),
    )


def _tagged(column: str, name: str) -> Column:
    return F.array(_metric(name, F.col("_events"), "count", F.create_map(F.lit(column), F.col(column))))


#: Size parameter of a quantile sketch, and the rank error that is promised for it. The error of one quantile at 99 % confidence is about a quarter of that.
QUANTILE_K, RANK_ERROR = 800, 0.0133


def quantile_sketches(df: DataFrame, by: list[str], value: str, k: int = QUANTILE_K) -> DataFrame:
    """(by, n, sketch): a mergeable quantile sketch of ``value`` per group; nulls and NaN are left out."""
    number = F.col(value).cast("double")
    rows = df.where(number.isNotNull() & ~F.isnan(number)).withColumn("_value", number)
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.kll_sketch_agg_double("_value", k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: list[str], ranks: list[float], k: int = QUANTILE_K) -> DataFrame:
    """(by, rank, n, value): quantiles of coarser groups from the sketches of finer ones; no value is read again.

    The share of values below ``value`` is within ``RANK_ERROR`` of the asked rank.
    """
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("_sketch"))
    at = lambda r: F.struct(F.lit(float(r)).alias("rank"), F.kll_sketch_get_quantile_double("_sketch", F.lit(float(r))).alias("value"))
    return merged.select(*by, "n", F.inline(F.array(*[at(r) for r in ranks]))).select(*by, "rank", "n", "value")


def rank_errors(df: DataFrame, quantiles: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, rank, value, rank_error): how far the rank of each value lies from the one asked for, by counting."""
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    met = rows.join(F.broadcast(quantiles.select(*by, "rank", "value")), by)  # a row per group and rank
    counted = met.groupBy(*by, "rank", "value").agg(F.count("*").alias("_n"), F.count_if(F.col("_v") < F.col("value")).alias("_less"), F.count_if(F.col("_v") <= F.col("value")).alias("_upto"))
    low, high = F.col("_less") / F.col("_n"), F.col("_upto") / F.col("_n")
    return counted.select(*by, "rank", "value", F.greatest(low - F.col("rank"), F.col("rank") - high, F.lit(0.0)).alias("rank_error"))
