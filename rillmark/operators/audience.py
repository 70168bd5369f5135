"""Users over any span of days from stored daily sets, without reading events again.

Exact sets are bitmaps over dense user numbers: a row per day and bucket of 32,768 users
(4 kB at most), so a union is an OR, an intersection an AND and a count a sum over buckets.
Sets within a bound are theta sketches, one per day whatever the number of users; they
unite and intersect too. Both are additive tables: a new day adds rows, a new question
reads only the days it is about. Users without an id count nowhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.functions.ranking import with_global_rank

#: log2 of the entries of a theta sketch; counts beyond that many users have a relative standard error of 1 / sqrt(2 ** 14 - 1), 0.8 %.
THETA_BITS = 14


def user_numbers(events: DataFrame, known: DataFrame | None = None, user: str = "user_id", ts: str = "timestamp") -> DataFrame:
    """(user, number, first_day): dense numbers from 1 by user id; new users go behind the ``known`` ones, whose numbers stay.

    ``first_day`` is the earliest day seen; an earlier day that comes late moves it.
    """
    days = events.where(F.col(user).isNotNull() & F.col(ts).isNotNull()).groupBy(user).agg(F.to_date(F.min(ts)).alias("first_day"))
    if known is None:
        return with_global_rank(days, [F.col(user)], "number").select(user, "number", "first_day")
    met = days.join(known.select(user, "number", F.col("first_day").alias("_known")), user, "full")
    old = met.where("number is not null").select(user, "number", F.least("first_day", "_known").alias("first_day"))
    fresh = with_global_rank(met.where("number is null").select(user, "first_day"), [F.col(user)], "number")
    most = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    return old.unionByName(fresh.select(user, (F.col("number") + most).alias("number"), "first_day"))


def bitmaps(numbered: DataFrame, by: list[str]) -> DataFrame:
    """(by, bucket, users): bitmaps of the column ``number``. Of a hot day or bucket tasks send one bitmap each."""
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    return numbered.groupBy(*by, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users"))


def daily_sets(events: DataFrame, numbers: DataFrame, user: str = "user_id", ts: str = "timestamp") -> DataFrame:
    """(day, bucket, users) of the users active on each day."""
    rows = events.where(F.col(ts).isNotNull()).select(user, F.to_date(ts).alias("day")).distinct()
    return bitmaps(rows.join(numbers.select(user, "number"), user), ["day"])


def cohort_sets(numbers: DataFrame) -> DataFrame:
    """(day, bucket, users) of the users first seen on each day."""
    return bitmaps(numbers.withColumnRenamed("first_day", "day"), ["day"])


def united(sets: DataFrame, by: list[str]) -> DataFrame:
    """Users in any of the sets of each group: (by, users)."""
    merged = sets.groupBy(*by, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("users")).alias("users"))


def active_between(sets: DataFrame, first, last) -> DataFrame:
    """One row: users active on any day from ``first`` to ``last``."""
    inside = sets.where(F.col("day").between(F.lit(first), F.lit(last)))
    return united(inside, []).select(F.coalesce("users", F.lit(0)).alias("users"))


def rolling_active(sets: DataFrame, days: int) -> DataFrame:
    """(day, users): users active in the ``days`` days up to each day that has any; a set takes part in ``days`` windows."""
    ends = sets.select("day").distinct().withColumnRenamed("day", "_end")
    spread = sets.withColumn("_end", F.explode(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.date_add("day", i))))
    return united(spread.join(ends, "_end", "left_semi"), ["_end"]).withColumnRenamed("_end", "day")


def retained(cohorts: DataFrame, sets: DataFrame, offsets: list[int]) -> DataFrame:
    """(day, offset, cohort_users, users): users of each cohort who were active ``offset`` days later, by intersection."""
    offset = F.explode(F.array(*[F.lit(k) for k in offsets])).alias("offset")
    asked = cohorts.select("day", offset, "bucket", "users")
    answered = sets.select(F.col("day").alias("_day"), offset, "bucket", "users").select(F.date_sub("_day", F.col("offset")).alias("day"), "offset", "bucket", "users")
    both = asked.unionByName(answered).groupBy("day", "offset", "bucket").agg(F.count("*").alias("_n"), F.bitmap_and_agg("users").alias("users")).where("_n = 2")
    kept = both.groupBy("day", "offset").agg(F.sum(F.bitmap_count("users")).alias("users"))
    size = united(cohorts, ["day"]).withColumnRenamed("users", "cohort_users").withColumn("offset", offset)
    return size.join(kept, ["day", "offset"], "left").select("day", "offset", "cohort_users", F.coalesce("users", F.lit(0)).alias("users"))


def daily_sketches(events: DataFrame, user: str = "user_id", ts: str = "timestamp") -> DataFrame:
    """(day, users): a theta sketch of the users of each day."""
    rows = events.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
    return rows.groupBy(F.to_date(ts).alias("day")).agg(F.theta_sketch_agg(user, THETA_BITS).alias("users"))


def sketched_between(sketches: DataFrame, first, last) -> DataFrame:
    """One row: about how many users were active on any day from ``first`` to ``last``."""
    inside = sketches.where(F.col("day").between(F.lit(first), F.lit(last)))
    return inside.agg(F.theta_sketch_estimate(F.theta_union_agg("users")).alias("users")).select(F.coalesce("users", F.lit(0)).alias("users"))


def sketched_overlap(sketches: DataFrame, days: int) -> DataFrame:
    """(day, users): about how many users of each day were active ``days`` days later too."""
    later = sketches.select(F.date_sub("day", days).alias("day"), F.col("users").alias("_later"))
    return sketches.join(later, "day").select("day", F.theta_sketch_estimate(F.theta_intersection("users", "_later")).alias("users"))
