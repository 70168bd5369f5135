"""Writes into the metrics mart: metric rows, run rows, quality reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.schemas import METRIC, RUN
from rillmark.sinks.tables import write_partitions
from rillmark.sources.tables import Lake


def metric_rows(rows: DataFrame, recorded_at: datetime | None = None) -> DataFrame:
    """Metric rows in table order, stamped when they carry no time of their own."""
    if "recorded_at" not in rows.columns:
        stamp = F.lit(recorded_at) if recorded_at else F.current_timestamp()
        rows = rows.withColumn("recorded_at", stamp)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in METRIC.fields])


def run_key(as_of: datetime) -> str:
    """Partition value of the rows of one run time."""
    return as_of.isoformat(timespec="seconds").replace(":", "-")


def write_run_rows(rows: DataFrame, lake: Lake, table: str, as_of: datetime) -> None:
    """Rows of a run time into a table partitioned by it; a repeated run replaces what it wrote before."""
    write_partitions(rows.withColumn("run_at", F.lit(run_key(as_of))), lake.path(table), ["run_at"])


def write_metrics(rows: DataFrame, lake: Lake, jdbc: dict[str, str] | None = None, recorded_at: datetime | None = None, source: str = "figures") -> None:
    """All rows of a run time in one write; the same source writing again for it replaces its rows.

    ``jdbc`` options append them to a database as well, tags as JSON; there repeated runs need a key on the table.
    """
    stamped = metric_rows(rows, recorded_at)
    key = run_key(recorded_at) if recorded_at else "unstamped"
    keyed = stamped.withColumns({"run_at": F.lit(key), "written_by": F.lit(source)})
    if recorded_at:
        write_partitions(keyed, lake.path("pipeline_metrics"), ["run_at", "written_by"])
    else:
        keyed.write.mode("append").partitionBy("run_at", "written_by").parquet(lake.path("pipeline_metrics"))
    if jdbc:
        stamped.withColumn("tags", F.to_json("tags")).write.mode("append").format("jdbc").options(**jdbc).save()


def run_row(
    spark: SparkSession, name: str, run_id: str, started: datetime, completed: datetime, status: str,
    processed: int, failed: int = 0, error: str | None = None,
) -> DataFrame:
    """The record of one real run."""
    seconds = int((completed - started).total_seconds())
    return spark.createDataFrame([(name, run_id, status, started, completed, seconds, processed, failed, error, None)], RUN)


def write_run(row: DataFrame, lake: Lake, csv_fallback: str | None = None) -> None:
    """Append a run row; where the table cannot be written, a CSV line keeps the record."""
    try:
        by = ["run_at"] if "run_at" in row.columns else []
        row.write.mode("append").partitionBy(*by).parquet(lake.path("pipeline_runs"))
    except Exception:
        if csv_fallback is None:
            raise
        row.write.mode("append").csv(csv_fallback)


def write_report(report: DataFrame, directory: str) -> None:
    """Add one report to the folder of JSON reports."""
    report.write.mode("append").json(directory)
