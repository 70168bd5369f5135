"""States of quality checks that merge: one per partition of a table, verdicts over any set of partitions from states alone.

Checks on single rows keep how many rows were tested and how many failed, freshness the
newest time, completeness filled and all cells, uniqueness a sketch per column: a row per
partition. The one-to-one check keeps the lowest and the highest parent of each child in a
partition: a child has more than one parent if these differ over all its partitions. That
table has a row per child and partition and is read whole when states are merged; the
checked table is not read at all.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.functions.columns import has_columns, percent
from rillmark.operators.quality import (
    COMPLETE, NULLS, REFERENCE, SCHEMA, UNIQUE, UNIQUE_COLUMNS, Check, domain_checks, evaluate, fresh_checks, not_null_checks,
    range_checks, row_check, schema_checks, timestamp_checks,
)

#: log2 of the registers of a sketch; distinct values are estimated with a relative standard error of 0.8 %.
SKETCH_BITS = 14


def additive_checks(df: DataFrame, ts: str = "timestamp") -> list[Check]:
    """The checks of the suites whose counts add up over partitions."""
    checks = schema_checks(df) + not_null_checks(df) + range_checks(df) + domain_checks(df)
    return checks + (timestamp_checks(ts) if has_columns(df, ts) else [])


def check_states(df: DataFrame, part: str, checks: list[Check] | None = None, columns: list[str] | None = None, ts: str = "timestamp") -> DataFrame:
    """(part, rows, tallies, filled, cells, newest, sketches) for every partition, null as one of them.

    ``checks`` are additive ones, by default those of the suites; ``columns`` those whose
    cells are counted, by default all. Partitions are pre-aggregated before the shuffle.
    """
    checks = additive_checks(df, ts) if checks is None else checks
    columns = df.columns if columns is None else columns
    tallies = [
        F.struct(
            F.lit(c.suite).alias("suite"), F.lit(c.name).alias("name"), c.tested.cast("bigint").alias("tested"), c.failed.cast("bigint").alias("failed"),
            (c.details if c.suite == SCHEMA and c.details is not None else F.lit(None).cast("string")).alias("note"),
        )
        for c in checks
    ]
    sketches = [_sketch(df, c).alias(f"sketch_{c}") for c in UNIQUE_COLUMNS]
    newest = F.max(ts) if has_columns(df, ts) else F.lit(None).cast("timestamp")
    return df.groupBy(F.col(part)).agg(
        F.count("*").alias("rows"), F.array(*tallies).alias("tallies"), sum((F.count(c) for c in columns[1:]), F.count(columns[0])).alias("filled"),
        (F.count("*") * len(columns)).alias("cells"), newest.alias("newest"), *sketches,
    )


def _sketch(df: DataFrame, column: str) -> Column:
    if not has_columns(df, column):
        return F.lit(None).cast("binary")
    return F.hll_sketch_agg(F.col(column).cast("string"), SKETCH_BITS)


def parent_states(df: DataFrame, part: str, child: str = "session_id", parent: str = "user_id") -> DataFrame:
    """(part, child, lowest, highest) parent of each child in each partition; both null where no parent is known."""
    return df.where(F.col(child).isNotNull()).groupBy(F.col(part), F.col(child).alias("child")).agg(F.min(parent).alias("lowest"), F.max(parent).alias("highest"))


def merged_checks(states: DataFrame, as_of: datetime, backfill: bool = True, max_age: timedelta = timedelta(hours=1), min_pct: float = 95) -> DataFrame:
    """Verdicts of the additive checks, freshness, completeness and uniqueness over all given states."""
    n = F.sum("rows")
    tallies = states.select(F.inline("tallies")).groupBy("suite", "name").agg(F.sum("tested").alias("tested"), F.sum("failed").alias("failed"), F.max("note").alias("note"))
    counts = F.concat_ws("", F.col("failed").cast("string"), F.lit(" of "), F.col("tested").cast("string"), F.lit(" rows failed"))
    additive = tallies.select("suite", "name", (F.col("failed") == 0).alias("passed"), "tested", "failed", F.coalesce("note", counts).alias("details"))

    score = percent(F.sum("filled"), F.sum("cells"))
    details = F.concat_ws("", F.lit("completeness "), F.format_number(score, 2), F.lit("%"))
    whole = [Check(COMPLETE, f"data_completeness_{min_pct:g}_percent", F.sum("cells"), F.sum("cells") - F.sum("filled"), score >= min_pct, details)]
    whole += [replace(check, tested=n) for check in fresh_checks("newest", max_age, as_of, backfill)]
    for column in UNIQUE_COLUMNS:
        distinct = F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{column}"))
        some = (distinct > 0) & (n > 0)
        share = percent(F.greatest(n - distinct, F.lit(0)), n)
        about = F.concat_ws("", F.lit("distinct about "), distinct.cast("string"), F.lit(", duplication "), F.format_number(share, 1), F.lit("%"))
        whole.append(Check(UNIQUE, f"uniqueness_{column}", n, F.when(some, 0).otherwise(1), some, about))
    return additive.union(evaluate(states, whole))


def merged_one_to_one(parents: DataFrame, child: str = "session_id", parent: str = "user_id") -> DataFrame:
    """Verdict of the one-to-one check over all given parent states."""
    per_child = parents.groupBy("child").agg(F.min("lowest").alias("lowest"), F.max("highest").alias("highest"))
    differ = F.coalesce(F.col("lowest") != F.col("highest"), F.lit(False))
    return evaluate(per_child, [row_check(REFERENCE, f"{child}_has_one_{parent}", differ)])


def merged_suites(states: DataFrame, parents: DataFrame | None, as_of: datetime, backfill: bool = True) -> DataFrame:
    """All seven suites as ``run_suites`` gives them, from states; no rows where the partitions have none."""
    checks = merged_checks(states, as_of, backfill)
    checks = checks if parents is None else checks.union(merged_one_to_one(parents))
    some = F.max(F.when(F.col("suite") == NULLS, F.col("tested"))).over(Window.partitionBy())  # a few dozen rows
    return checks.withColumn("_rows", some).where("_rows > 0").drop("_rows")
