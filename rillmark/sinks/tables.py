"""Partitioned and keyed writes that may be repeated without doubling rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitions(df: DataFrame, path: str, by: list[str], file_format: str = "parquet") -> None:
    """Replace exactly the partitions that the frame has rows for.

    The rebalance hint gathers a partition's rows into few files, and adaptive
    execution splits a partition that is too large for one task.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .format(file_format)
        .save(path)
    )


def append_rows(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    df.write.mode("append").format(file_format).save(path)


def append_new(new: DataFrame, path: str, keys: list[str]) -> None:
    """Insert the rows whose key the target does not have; further copies within the insert are ignored too."""
    append_rows(rows_to_insert(new, path, keys), path)


def rows_to_insert(new: DataFrame, path: str, keys: list[str]) -> DataFrame:
    rows = new.dropDuplicates(keys)
    try:
        target = new.sparkSession.read.parquet(path).select(*keys)
    except AnalysisException:
        return rows
    return rows.join(target, keys, "left_anti")


def apply_retention(df: DataFrame, ts_col: str, keep: timedelta, as_of: datetime) -> DataFrame:
    """Rows that are not older than ``keep`` at ``as_of``."""
    return df.where(F.col(ts_col) >= F.lit(as_of) - F.lit(keep))


def trim_table(spark: SparkSession, path: str, ts_col: str, keep: timedelta, as_of: datetime, by: str) -> list[str]:
    """Delete the partitions of ``by`` whose newest row is older than ``keep``; returns their values.

    Only whole partitions go, so nothing is rewritten and readers of the others are not disturbed.
    """
    try:
        rows = spark.read.parquet(path)
    except AnalysisException:
        return []
    newest = rows.groupBy(F.col(by).cast("string").alias("part")).agg(F.max(ts_col).alias("newest"))
    old = [r["part"] for r in newest.where(F.col("newest") < F.lit(as_of) - F.lit(keep)).collect()]  # one value per partition
    for value in old:
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={value}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return sorted(old)


def write_compacted(
    spark: SparkSession, path: str, partition: Column, by: list[str], cluster_by: list[str], files: int
) -> None:
    """Rewrite some partitions as ``files`` sorted files.

    Give more than one clustering column when single values are frequent, so
    that the range split can cut between rows of the same value.
    """
    rows = spark.read.parquet(path).where(partition)
    laid_out = rows.repartitionByRange(files, *by, *cluster_by).sortWithinPartitions(*by, *cluster_by)
    (
        laid_out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
