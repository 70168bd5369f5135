"""Insert-if-absent and uniqueness over a huge partitioned table by a stored index of its keys.

The index has, for each partition of the table, the 64-bit hashes of its keys: a few bytes
a row, in the table's own partition layout, below ``_keys`` where readers do not look. New
keys meet the hashes first. Only partitions with an equal hash are opened, and there the
keys themselves are compared, so equal hashes of different keys lose nothing.

A batch is staged, then its hashes are added, then its rows. A run that ends between these
leaves hashes without rows, which cost a look and decide nothing; it never leaves rows
without hashes. So a batch that is tried again gives the same table. One writer at a time.

Defined results: a key with a null in it equals no other, so it is always inserted and
never counts as repeated; of several new rows with one key any one is kept; a null
partition value is a partition like others. Partition columns are dates, numbers or text.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS, STAGED = "_keys", "_insert"
LABEL = "_partition"


@dataclass(frozen=True)
class Inserted:
    """Rows that a batch added, and the partitions whose rows were compared for it, as JSON."""

    rows: int
    opened: tuple[str, ...]


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def hash_name(rows: DataFrame, keys: list[str]) -> str:
    """Column of the index; it tells the keys and their types, as equal values of two types have different hashes."""
    return "hash_of_" + "_and_".join(f"{k}_{rows.schema[k].dataType.simpleString()}" for k in keys).translate(str.maketrans("(),<>: ", "_______"))


def _label(by: list[str]) -> Column:
    return F.to_json(F.struct(*by)).alias(LABEL)


def _hashes(rows: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    return rows.dropna(subset=keys).select(*by, F.xxhash64(*keys).alias(hash_name(rows, keys)))


def _index(rows: DataFrame, path: str, keys: list[str], by: list[str], since: Column | None = None) -> DataFrame:
    """(label of a partition, hash) as stored, of partitions that ``since`` holds for; ``rows`` gives the types."""
    spark, name = rows.sparkSession, hash_name(rows, keys)
    stored = spark.read.parquet(f"{path}/{KEYS}/rows")
    if name not in stored.columns:
        raise ValueError(f"the index of {path} is over other keys or types than {name}")
    layout = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in by)
    typed = spark.read.schema(f"`{name}` bigint, {layout}").parquet(f"{path}/{KEYS}/rows")
    return typed.where(F.lit(True) if since is None else since).select(_label(by), name)


def has_index(spark: SparkSession, path: str) -> bool:
    return _exists(spark, f"{path}/{KEYS}/rows/_SUCCESS")


def index_keys(rows: DataFrame, path: str, keys: list[str], by: list[str]) -> None:
    """(Re)build the index of the table ``rows`` that is stored at ``path``, partitioned by ``by``; reads keys only."""
    _hashes(rows, keys, by).hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(f"{path}/{KEYS}/rows")


def _partitions(rows: DataFrame, path: str, labels: list[str], by: list[str]) -> DataFrame:
    """Rows of some partitions, typed as ``rows``; the predicate is on partition columns alone, so no other file is opened."""
    return rows.sparkSession.read.schema(rows.schema).parquet(path).where(_label(by).isin(labels))


def insert_indexed(new: DataFrame, path: str, keys: list[str], by: list[str], since: Column | None = None) -> Inserted:
    """Append the rows of ``new`` whose key the table at ``path`` does not have, in any partition.

    A table that has no index yet gets one. ``new`` has the columns and types of the table.
    ``since``, a condition on the partition columns, bounds the index that is read where
    earlier partitions cannot have the keys.
    """
    spark, name = new.sparkSession, hash_name(new, keys)
    _delete(spark, f"{path}/{STAGED}")  # of a run that was lost
    work = f"{path}/{STAGED}/{uuid.uuid4().hex[:12]}"
    table = any(c for c in _children(spark, path) if c[0] not in "_.")
    if table and not has_index(spark, path):
        index_keys(spark.read.schema(new.schema).parquet(path), path, keys, by)
    rows, opened = new.dropDuplicates(keys), []
    if has_index(spark, path):
        rows.write.parquet(f"{work}/new")
        rows = spark.read.schema(new.schema).parquet(f"{work}/new")
        wanted = rows.dropna(subset=keys).select(*keys, F.xxhash64(*keys).alias(name))
        wanted.join(_index(new, path, keys, by, since), name).select(*keys, LABEL).write.parquet(f"{work}/hits")
        hits = spark.read.parquet(f"{work}/hits")
        opened = sorted(r[0] for r in hits.select(LABEL).distinct().collect())  # at most one value per partition of the table
        if opened:
            found = _partitions(new, path, opened, by).select(*keys).join(hits.select(*keys).distinct(), keys, "left_semi")
            rows = rows.join(found.distinct(), keys, "left_anti")
    rows.select(*new.columns).write.parquet(f"{work}/rows")
    fresh = spark.read.schema(new.schema).parquet(f"{work}/rows")
    count = fresh.count()
    if count:
        _hashes(fresh, keys, by).hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(f"{path}/{KEYS}/rows")
        fresh.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(path)
    _delete(spark, f"{path}/{STAGED}")
    return Inserted(count, tuple(opened))


def _children(spark: SparkSession, path: str) -> list[str]:
    if not _exists(spark, path):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)]


def repeated_keys(table: DataFrame, path: str, keys: list[str], by: list[str]) -> DataFrame:
    """(keys, rows) of keys that stand in more than one row of the whole table, from its index.

    ``table`` gives the types. Hashes are counted where they are before the shuffle; only
    partitions that hold a repeated hash are opened, and their keys counted.
    """
    if not has_index(table.sparkSession, path):
        index_keys(table, path, keys, by)
    name = hash_name(table, keys)
    index = _index(table, path, keys, by)
    twice = index.groupBy(name).agg(F.count("*").alias("n"), F.collect_set(LABEL).alias("labels")).where("n > 1")
    labels = sorted(r[0] for r in twice.select(F.explode("labels")).distinct().collect())  # at most one value per partition
    counted = _partitions(table, path, labels, by).dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("rows"))
    return counted.where("rows > 1")
