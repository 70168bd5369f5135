"""Keep the check states of a partitioned table up to date by reading only partitions whose files changed.

A partition is known by the names and sizes of its files, so whoever wrote it, a job, a
stream or a compaction, is noticed. States carry that mark and count only while it is the
current one: states of dropped or emptied partitions, and those of a lost run, count for
nothing. The table of marks is written last; a run that is lost before is done again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.functions.columns import has_columns
from rillmark.operators.check_states import additive_checks, check_states, parent_states
from rillmark.sinks.compaction import data_files
from rillmark.sinks.tables import write_partitions

#: How a partition without a value is named, in folders and in the states.
NO_VALUE, NONE = "__HIVE_DEFAULT_PARTITION__", "none"


@dataclass(frozen=True)
class States:
    """Current states, and what this run read to make them current."""

    rows: DataFrame
    parents: DataFrame | None
    parts_read: tuple[str, ...]
    rows_read: int


def partition_marks(spark: SparkSession, path: str, by: str, made_with: str = "") -> dict[str, str]:
    """Partition value -> digest of its file names and sizes, and of what the states are made with."""
    found: dict[str, list[str]] = {}
    for folder, files in data_files(spark, path).items():
        values = [step.partition("=")[2] for step in folder.split("/") if step.startswith(f"{by}=")]
        if values:
            part = NONE if values[-1] == NO_VALUE else values[-1]
            found.setdefault(part, []).extend(f"{name}:{size}" for name, size in files)
    return {part: hashlib.sha256("\n".join([made_with, *sorted(files)]).encode()).hexdigest() for part, files in found.items()}


def known_marks(spark: SparkSession, root: str) -> dict[str, str]:
    try:
        return {r["part"]: r["mark"] for r in spark.read.schema("part string, mark string").parquet(f"{root}/marks").collect()}  # a row per partition
    except AnalysisException:
        return {}


def refresh_states(spark: SparkSession, path: str, root: str, by: str, read: Callable[[DataFrame], DataFrame] = lambda df: df) -> States:
    """States below ``root`` of the Parquet table at ``path``, partitioned by ``by``; only changed partitions are read.

    ``read`` turns stored rows into those that are checked and keeps ``by``. Other columns or
    checks than last time count as a change of all partitions.
    """
    stored = spark.read.parquet(path)
    checked = read(stored)
    made_with = ",".join([f"{f.name}:{f.dataType.simpleString()}" for f in checked.schema.fields] + [f"{c.suite}.{c.name}" for c in additive_checks(checked)])
    marks = partition_marks(spark, path, by, made_with)
    known = known_marks(spark, root)
    changed = sorted(part for part, mark in marks.items() if known.get(part) != mark)
    paired = has_columns(checked, "session_id", "user_id")
    current = spark.createDataFrame(sorted(marks.items()), "part string, mark string")
    if changed:
        value = F.coalesce(F.col(by).cast("string"), F.lit(NONE))
        rows = checked if len(changed) == len(marks) else read(stored.where(value.isin(*changed)))
        mark = lambda df: df.withColumn("part", value).drop(by).join(F.broadcast(current), "part")  # noqa: E731  a row per partition
        write_partitions(mark(check_states(rows, by)), f"{root}/rows", ["part"])
        if paired:
            write_partitions(mark(parent_states(rows, by)), f"{root}/parents", ["part"])
    if marks != known:
        current.coalesce(1).write.mode("overwrite").parquet(f"{root}/marks")
    if not marks:
        empty = check_states(checked, by).withColumns({"part": F.lit(NONE), "mark": F.lit("")}).drop(by)
        return States(empty, None, (), 0)

    def now(name: str) -> DataFrame:
        df = spark.read.parquet(f"{root}/{name}")
        return df.withColumn("part", F.col("part").cast("string")).join(F.broadcast(current), ["part", "mark"], "left_semi")

    states = now("rows")
    read_now = states.where(F.col("part").isin(*changed)).agg(F.sum("rows")).first()[0] if changed else 0
    return States(states, now("parents") if paired else None, tuple(changed), read_now or 0)
