"""Customer analytics: funnels, cohorts, RFM, active users, journeys, sessions, carts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.functions.columns import cents, money_sum, percent
from rillmark.functions.ordered import chunk_of, with_chain, with_previous, with_running
from rillmark.functions.ranking import quartile
from rillmark.schemas import FUNNEL_STAGES


def session_funnel(
    df: DataFrame, stages: dict[str, str] = FUNNEL_STAGES, ordered: bool = False, by: tuple[str, ...] = ()
) -> DataFrame:
    """One 0/1 flag per stage and session.

    The plain form asks whether the stage occurs at all. ``ordered`` also asks
    that the first event of a stage is not earlier than that of the stage
    before, which must have been reached itself.
    """
    keys = ["session_id", *by]
    if not ordered:
        flags = [F.max(F.when(F.col("event_type") == kind, 1).otherwise(0)).alias(name) for name, kind in stages.items()]
        return df.groupBy(*keys).agg(*flags)
    firsts = [F.min(F.when(F.col("event_type") == kind, F.col("timestamp"))).alias(name) for name, kind in stages.items()]
    reached, previous, out = F.lit(True), None, []
    for name in stages:
        here = F.col(name).isNotNull()
        reached = reached & (here if previous is None else here & (F.col(name) >= F.col(previous)))
        out.append(F.coalesce(reached, F.lit(False)).cast("int").alias(name))
        previous = name
    return df.groupBy(*keys).agg(*firsts).select(*keys, *out)


def funnel_in_order(
    df: DataFrame, stages: dict[str, str] = FUNNEL_STAGES, within: timedelta | None = None, by: tuple[str, ...] = ()
) -> DataFrame:
    """One 0/1 flag per stage and session: the stages up to it occur in this order, other events in between or not.

    Events are ordered by time, then event id. With ``within`` a step may take no longer
    than that. An event reaches its stage if the latest event that reached the stage before
    is near enough; the latest is the best, as any other is further away. So each stage is
    one running value over the session, and a long session is cut into chunks that hand it
    on. A session without any stage has zeros; rows without a session are left out.
    """
    keys, order = ["session_id", *by], list(stages)
    at = lambda name: f"_at_{name}"
    here = lambda name: F.col("event_type") == stages[name]
    rows = df.where(F.col("session_id").isNotNull() & F.col("timestamp").isNotNull())
    staged = rows.where(F.col("event_type").isin(*stages.values())).select(*keys, "timestamp", "event_id", "event_type")
    staged = staged.withColumn(at(order[0]), F.when(here(order[0]), F.col("timestamp")))
    steps = []
    for before, name in zip(order, order[1:]):
        last = F.col(f"_last_{before}")
        near = last.isNotNull() if within is None else F.col("timestamp") <= last + F.lit(within)
        steps.append((f"_last_{before}", "last", at(before), {at(name): F.when(here(name) & near, F.col("timestamp"))}))
    reached = with_chain(staged, keys, "timestamp", ["event_id"], steps)
    flags = reached.groupBy(*keys).agg(*[F.max(F.col(at(name)).isNotNull().cast("int")).alias(name) for name in order])
    nothing = rows.select(*keys, *[F.lit(0).alias(name) for name in order])
    return flags.unionByName(nothing).groupBy(*keys).agg(*[F.max(name).alias(name) for name in order])


def step_conversion(funnel: DataFrame, stages: dict[str, str] = FUNNEL_STAGES, by: tuple[str, ...] = ()) -> DataFrame:
    """Percentage of sessions that go from each stage to the next."""
    order = list(stages)
    steps = [percent(F.sum(b), F.sum(a)).alias(f"{a}_to_{b}_pct") for a, b in zip(order, order[1:])]
    return funnel.groupBy(*by).agg(*steps)


def cohort_retention(
    df: DataFrame, anchor: str = "any", grain: str = "month", purchase_type: str = "checkout_completed"
) -> DataFrame:
    """Distinct users per (cohort period, activity period).

    The anchor is a user's first event, or the first purchase. Events shrink to
    one row per user and period before anything else is done per user.
    """
    is_anchor = F.lit(True) if anchor == "any" else F.col("event_type") == purchase_type
    active = df.where(F.col("user_id").isNotNull() & F.col("timestamp").isNotNull()).groupBy(
        "user_id", F.to_date(F.date_trunc(grain, "timestamp")).alias("event_period")
    ).agg(F.min(F.when(is_anchor, F.col("timestamp"))).alias("anchor_ts"))
    first = F.min("anchor_ts").over(Window.partitionBy("user_id"))
    placed = active.select("event_period", F.to_date(F.date_trunc(grain, first)).alias("cohort_period")).where(
        F.col("event_period") >= F.col("cohort_period")
    )
    cells = placed.groupBy("cohort_period", "event_period").agg(F.count("*").alias("users"))
    size = F.max(F.when(F.col("event_period") == F.col("cohort_period"), F.col("users"))).over(
        Window.partitionBy("cohort_period")
    )
    return cells.select(
        "cohort_period", "event_period", "users", percent(F.col("users"), size).alias("retention_pct")
    ).orderBy("cohort_period", "event_period")


def rfm_base(df: DataFrame, as_of: datetime, purchase_type: str = "checkout_completed", value: Column | None = None) -> DataFrame:
    """Days since the last purchase, number of purchases and money spent, per user."""
    spent = F.col("price") if value is None else value
    return (
        df.where((F.col("event_type") == purchase_type) & F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.datediff(F.lit(as_of).cast("date"), F.max("timestamp")).alias("recency"),
            F.count("*").alias("frequency"),
            money_sum(spent).alias("monetary"),
        )
    )


def rfm(df: DataFrame, as_of: datetime, purchase_type: str = "checkout_completed", value: Column | None = None) -> DataFrame:
    """RFM quartiles and score; ties go by user id, and quartile 4 is the best in each measure."""
    out = quartile(rfm_base(df, as_of, purchase_type, value), [F.desc("recency"), F.col("user_id")], "r_quartile")
    out = quartile(out, [F.col("frequency"), F.col("user_id")], "f_quartile")
    out = quartile(out, [F.col("monetary"), F.col("user_id")], "m_quartile")
    digits = [F.col(c).cast("string") for c in ("r_quartile", "f_quartile", "m_quartile")]
    return out.withColumn("rfm_score", F.concat(*digits))


def daily_active(df: DataFrame, window_rows: int = 7, last: int | None = 30) -> DataFrame:
    """Distinct users per day with a moving average over days; the newest ``last`` days."""
    per_day = df.groupBy(F.to_date("timestamp").alias("date")).agg(F.countDistinct("user_id").alias("dau"))
    # one row per day is left here, so the window over all days is small by construction
    trailing = Window.orderBy("date").rowsBetween(-(window_rows - 1), 0)
    out = per_day.withColumn(f"dau_{window_rows}day_avg", F.avg("dau").over(trailing)).orderBy(F.desc("date"))
    return out if last is None else out.limit(last)


def journeys(df: DataFrame, max_steps: int = 5, min_steps: int = 3, limit: int | None = None) -> DataFrame:
    """First steps of every user as a list, for users with enough of them.

    The rank filter is applied inside each input partition before the shuffle,
    so no user sends more than ``max_steps`` rows per task.
    """
    step = F.row_number().over(Window.partitionBy("user_id").orderBy("timestamp", "event_id"))
    first = df.select("user_id", "event_type", "timestamp", "event_id", step.alias("step")).where(F.col("step") <= max_steps)
    listed = first.groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct("step", "event_type"))).alias("_steps"), F.count("*").alias("steps")
    )
    out = listed.where(F.col("steps") >= min_steps).select(
        "user_id", F.transform("_steps", lambda s: s["event_type"]).alias("journey_path"), "steps"
    )
    return out if limit is None else out.orderBy("user_id").limit(limit)


def sessionize(
    df: DataFrame, gap: timedelta, end_on: str | None = None, by: str = "user_id", ts: str = "timestamp", tie: str = "event_id",
    chunk: str | None = None,
) -> DataFrame:
    """Add the session number and start of every event of a user.

    A session ends after a pause longer than ``gap`` or, with ``end_on``, after
    an event of that type. Users are worked on chunk by chunk (see
    ``functions.ordered``): only a chunk's first event needs to know what came
    before, and that is one row per user and chunk.
    """
    ends = F.lit(False) if end_on is None else F.coalesce(F.col("event_type") == end_on, F.lit(False))
    chunked = df.withColumns({"_chunk": chunk_of(df, [by], ts, chunk), "_ends": ends})
    inside = Window.partitionBy(by, "_chunk").orderBy(ts, tie)
    upto_here = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = chunked.withColumns(
        {"_prev": F.lag(ts).over(inside), "_prev_ends": F.lag("_ends").over(inside), "_next": F.lead(ts).over(inside)}
    ).withColumn("_opens", F.when(F.col("_prev").isNotNull(), _breaks(F.col("_prev"), F.col("_prev_ends"), F.col(ts), gap)).otherwise(0))

    opened_at = F.when(F.col("_opens") == 1, F.col(ts))
    heads = local.groupBy(by, "_chunk").agg(
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
        F.max(F.when(F.col("_next").isNull(), F.col("_ends"))).alias("_last_ends"),
        F.sum("_opens").alias("_opened"),
        F.max(opened_at).alias("_last_start"),
    )
    along = Window.partitionBy(by).orderBy("_chunk")
    upto, earlier = along.rowsBetween(Window.unboundedPreceding, 0), along.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        heads.withColumns({"_prior": F.lag("_last").over(along), "_prior_ends": F.lag("_last_ends").over(along)})
        .withColumn(
            "_head_opens",
            F.when(F.col("_prior").isNull(), 1).otherwise(_breaks(F.col("_prior"), F.col("_prior_ends"), F.col("_first"), gap)),
        )
        .withColumn("_head_start", F.when(F.col("_head_opens") == 1, F.col("_first")))
        .select(
            by,
            "_chunk",
            (F.coalesce(F.sum("_opened").over(earlier), F.lit(0)) + F.sum("_head_opens").over(upto)).alias("_skip"),
            F.greatest(F.max("_head_start").over(upto), F.max("_last_start").over(earlier)).alias("_carried_start"),
        )
    )
    here = local.withColumns({"_number": F.sum("_opens").over(upto_here), "_start": F.max(opened_at).over(upto_here)})
    return here.join(carried, [by, "_chunk"], "left").select(
        *[F.col(c) for c in df.columns],
        F.when(F.col(by).isNotNull(), F.col("_skip") + F.col("_number")).alias("session_number"),
        F.when(F.col(by).isNotNull(), F.coalesce("_start", "_carried_start")).alias("session_start"),
    )


def _breaks(before: Column, before_ends: Column, moment: Column, gap: timedelta) -> Column:
    return F.when((moment > before + F.lit(gap)) | before_ends, 1).otherwise(0)


def session_stats(sessions: DataFrame, keys: list[str], ts: str = "timestamp") -> DataFrame:
    """Length, first and last event of every session."""
    order = F.struct(ts, "event_id")
    return sessions.groupBy(*keys).agg(
        F.count("*").alias("events"),
        F.min(ts).alias("started_at"),
        F.max(ts).alias("ended_at"),
        F.timestamp_diff("SECOND", F.min(ts), F.max(ts)).alias("duration_seconds"),
        F.min_by("event_type", order).alias("first_event"),
        F.max_by("event_type", order).alias("last_event"),
    )


def gaps(df: DataFrame, ts: str, by: list[str], tie: list[str], threshold: timedelta, chunk: str | None = None) -> DataFrame:
    """Holes in a series: consecutive rows further apart than the threshold."""
    paired = with_previous(df.select(*by, ts, *tie), by, ts, tie, {"gap_start": ts}, chunk)
    hole = F.col(ts) > F.col("gap_start") + F.lit(threshold)
    return paired.where(hole).select(
        *by,
        "gap_start",
        F.col(ts).alias("gap_end"),
        F.timestamp_diff("SECOND", F.col("gap_start"), F.col(ts)).alias("gap_seconds"),
    )


def running_cart(df: DataFrame, by: str = "session_id", ts: str = "timestamp", tie: str = "event_id") -> DataFrame:
    """Cart adds with the cart's total and item count after each of them."""
    adds = df.where(F.col("event_type") == "add_to_cart").select(
        by, ts, tie, "product_id", "price", cents(F.col("price")).alias("_cents"), F.lit(1).alias("_one")
    )
    run = with_running(adds, [by], ts, [tie], {"_sum": ("sum", "_cents"), "cart_item_count": ("sum", "_one")})
    return run.withColumn("cart_total", F.col("_sum").cast("double") / 100).drop("_cents", "_one", "_sum")
