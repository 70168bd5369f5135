"""Named tables on a lake path, and how to read them."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.schemas import REPORT

LAYOUT = {
    "bronze_clickstream": "bronze/clickstream",
    "bronze_transactions": "bronze/transactions",
    "silver_clickstream": "silver/clickstream",
    "silver_rejected": "silver/clickstream_rejected",
    "silver_late": "silver/clickstream_late",
    "silver_stream_rejected": "silver/clickstream_stream_rejected",
    "silver_batches": "silver/clickstream_batches",
    "gold_cells": "gold/cells",
    "gold_hourly": "gold/hourly_metrics",
    "pipeline_metrics": "metrics/pipeline_metrics",
    "pipeline_runs": "metrics/pipeline_runs",
    "data_quality_checks": "metrics/data_quality_checks",
    "system_resources": "metrics/system_resources",
    "business_metrics": "metrics/business_metrics",
    "alerts": "metrics/alerts",
    "stream_progress": "metrics/stream_progress",
}


#: Conditions under which a source counts as not there.
UNREADABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DATA_SOURCE_NOT_FOUND")


@dataclass(frozen=True)
class Lake:
    """Where the tables are. One registry for every job, whatever the format."""

    root: str
    file_format: str = "parquet"
    tables: dict[str, str] = field(default_factory=lambda: dict(LAYOUT))

    def path(self, name: str) -> str:
        return os.path.join(self.root, self.tables[name])

    def checkpoint(self, query: str) -> str:
        return os.path.join(self.root, "_checkpoints", query)

    @property
    def reports(self) -> str:
        return os.path.join(self.root, "quality/reports")


def read_table(spark: SparkSession, lake: Lake, name: str, merge_schema: bool = False) -> DataFrame:
    """A registered table with its partition columns; partitions without the filter's dates are not opened."""
    return spark.read.format(lake.file_format).option("mergeSchema", str(merge_schema).lower()).load(lake.path(name))


def read_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Every Parquet file below the paths as one table, whatever the folder depth."""
    reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
    return reader.parquet(*paths)


def first_readable(spark: SparkSession, candidates: list[tuple[str, str]]) -> DataFrame:
    """The first ``(format, path)`` that is there. There is no made-up stand-in for missing data.

    Only a missing path, an empty folder or a missing connector leads to the next one. A
    table that is there but cannot be read, say for its permissions, is an error.
    """
    problems = []
    for file_format, path in candidates:
        try:
            return spark.read.format(file_format).load(path)
        except AnalysisException as error:  # no such path, no such format, or nothing to take a schema from
            if error.getCondition() not in UNREADABLE:
                raise
            problems.append(f"{file_format} {path}: {error.getCondition()}")
        except (PySparkException, Py4JJavaError) as error:
            if "[DATA_SOURCE_NOT_FOUND]" not in str(error):
                raise
            problems.append(f"{file_format} {path}: no connector")
    raise FileNotFoundError("no readable source: " + "; ".join(problems))


def exists(spark: SparkSession, lake: Lake, name: str) -> bool:
    try:
        read_table(spark, lake, name)
        return True
    except AnalysisException:
        return False


def layer_status(spark: SparkSession, lake: Lake) -> DataFrame:
    """One row per registered table: whether it is there and how many rows it has."""
    frames = []
    for name in lake.tables:
        if exists(spark, lake, name):
            frames.append(
                read_table(spark, lake, name).agg(
                    F.lit(name).alias("table_name"), F.lit(True).alias("available"), F.count("*").alias("row_count")
                )
            )
        else:
            frames.append(spark.range(1).select(F.lit(name), F.lit(False), F.lit(0).cast("bigint")))
    out = frames[0].toDF("table_name", "available", "row_count")
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def latest_report(spark: SparkSession, reports_dir: str) -> DataFrame | None:
    """The quality report with the newest time, of several the one written last; None when none was ever written."""
    try:
        stored = spark.read.schema(REPORT).json(reports_dir)
    except AnalysisException:
        return None
    return stored.orderBy(F.desc("timestamp"), F.desc_nulls_last("written_at"), F.desc_nulls_last("run_id")).limit(1)


def report_of_run(spark: SparkSession, reports_dir: str, run_id: str) -> DataFrame | None:
    """The report that a run wrote, whatever else was written since; None when it wrote none."""
    try:
        stored = spark.read.schema(REPORT).json(reports_dir).where(F.col("run_id") == run_id)
    except AnalysisException:
        return None
    return stored if stored.head(1) else None


def register_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Make every existing table available to SQL by its name."""
    found = [name for name in lake.tables if exists(spark, lake, name)]
    for name in found:
        read_table(spark, lake, name).createOrReplaceTempView(name)
    return found


def run_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """SQL over the given frames, written as ``{name}`` in the text."""
    return spark.sql(text, **frames)
