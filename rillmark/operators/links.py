"""Joins of facts with dimensions, histories and check results."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.functions.columns import date_key
from rillmark.functions.lookup import lookup_join
from rillmark.functions.ordered import with_running


def with_date_key(fact: DataFrame, ts: str) -> DataFrame:
    return fact.withColumn("date_key", date_key(F.col(ts)))


def with_product(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return lookup_join(fact, dim, ["product_id"], "left")


def with_user(fact: DataFrame, users: DataFrame) -> DataFrame:
    return lookup_join(fact, users, ["user_id"], "left")


def with_dim_as_of(fact: DataFrame, dim: DataFrame, key: str, ts: str) -> DataFrame:
    """The dimension version that was valid at the time of the fact."""
    return lookup_join(fact, dim, [key], "left", valid=(ts, "effective_date", "expiration_date"))


def with_dim_current(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return lookup_join(fact, dim.where("is_current"), [key], "left")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row; a null key has none either."""
    return lookup_join(fact, dim.select(key).distinct(), [key], "left_anti")


def value_as_of(metrics: DataFrame, t: datetime) -> DataFrame:
    """Last value of every metric at or before ``t``."""
    return (
        metrics.where(F.col("recorded_at") <= F.lit(t))
        .groupBy("metric_name")
        .agg(F.max_by("metric_value", "recorded_at").alias("metric_value"), F.max("recorded_at").alias("recorded_at"))
    )


def as_of_join(points: DataFrame, history: DataFrame, by: list[str], ts: str, value: str) -> DataFrame:
    """For every point the history's last value at or before it (same ``by`` and ``ts`` columns)."""
    keep = points.columns
    left = points.withColumns({value: F.lit(None), "_rank": F.lit(1)})
    right = history.select(*by, ts, value).withColumn("_rank", F.lit(0))
    both = left.unionByName(right, allowMissingColumns=True)
    filled = with_running(both, by, ts, ["_rank"], {"_value": ("last", value)})
    return filled.where("_rank = 1").select(*keep, F.col("_value").alias(value))


def attach_gate(runs: DataFrame, checks: DataFrame) -> DataFrame:
    """Runs with the verdict of their checks; a run without checks has none.

    Checks tell by a flag ``passed``, or by a ``status`` as the jobs store them.
    """
    passed = F.col("passed") if "passed" in checks.columns else F.col("status") == "passed"
    verdict = checks.groupBy("run_id").agg(
        F.count("*").alias("checks"), F.count_if(~passed).alias("failed_checks")
    )
    joined = lookup_join(runs, verdict, ["run_id"], "left")
    return joined.withColumn("gate_passed", F.col("failed_checks") == 0)
