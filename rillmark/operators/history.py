"""Version history from a change log that arrives in any order.

The stored table is the log itself, cut into intervals: one row per key and effective time,
with the state that holds from there to the key's next change. A late change splits the
interval it falls into; a correction (same time, higher sequence) replaces it. What is
stored therefore depends on the set of changes alone, not on their order or batches.
Changes that change nothing are kept too, as an earlier one may come between later; a
reader who wants versions that differ takes ``versions``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.functions.ordered import with_previous
from rillmark.operators.links import as_of_join
from rillmark.sinks.tables import write_partitions

BUCKETS = 64
_DAY = 86_400_000_000


def _with_next(rows: DataFrame, key: str, names: dict[str, str]) -> DataFrame:
    """Values of the key's next row by ``effective_at``; long series are cut by day."""
    back = rows.withColumn("_back", -F.unix_micros(F.col("effective_at").cast("timestamp")))
    return with_previous(back, [key], "_back", [], names, large_chunk=F.floor(F.col("_back") / _DAY)).drop("_back")


def cut_intervals(changes: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """(key, effective_at, sequence, attributes, expires_at, is_current) of changes (key, effective_at, sequence, attributes).

    Of several changes of a key at one time the last by sequence counts, and by its
    attributes where sequences are equal. Rows without key or time are left out.
    """
    known = changes.where(F.col(key).isNotNull() & F.col("effective_at").isNotNull())
    last = known.groupBy(key, "effective_at").agg(F.max(F.struct("sequence", *attributes)).alias("_c")).select(key, "effective_at", "_c.*")
    cut = _with_next(last, key, {"expires_at": "effective_at"})
    return cut.withColumn("is_current", F.col("expires_at").isNull())


def merge_changes(path: str, changes: DataFrame, key: str, attributes: list[str], buckets: int = BUCKETS) -> None:
    """Bring ``changes`` into the history at ``path``; a repeated call changes nothing.

    The table is partitioned by a hash of the key. Only buckets that the changes touch are
    read and rewritten, and in them only keys that changed are cut anew.
    """
    spark = changes.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    new = changes.where(F.col(key).isNotNull() & F.col("effective_at").isNotNull()).select(key, "effective_at", "sequence", *attributes)
    touched = [r[0] for r in new.select(bucket).distinct().collect()]  # at most one value per bucket
    if not touched:
        return
    try:
        stored = spark.read.parquet(path).where(F.col("bucket").isin(touched))
    except AnalysisException:
        out = cut_intervals(new, key, attributes)
    else:
        keys = new.select(key).distinct()
        again = stored.join(keys, key, "left_semi").select(new.columns).unionByName(new)
        same = stored.join(keys, key, "left_anti").drop("bucket")
        out = same.unionByName(cut_intervals(again, key, attributes))
    write_partitions(out.withColumn("bucket", bucket), path, ["bucket"])


def versions(history: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """Intervals in which ``tracked`` stays the same: (key, tracked, effective_at, expires_at, is_current)."""
    now = F.struct(*tracked)
    rows = history.select(key, *tracked, "effective_at").withColumn("_now", now)
    rows = with_previous(rows, [key], "effective_at", [], {"_was": "_now"}, large_chunk="day")
    opened = rows.where(F.col("_was").isNull() | ~F.col("_now").eqNullSafe(F.col("_was"))).drop("_now", "_was")
    return _with_next(opened, key, {"expires_at": "effective_at"}).withColumn("is_current", F.col("expires_at").isNull())


def version_at(fact: DataFrame, history: DataFrame, key: str, ts: str, attributes: list[str]) -> DataFrame:
    """``fact`` with the attributes that held at its time, null before the first change.

    Facts and changes go through one ordered pass per key, so a key with many of both is
    no product of the two; long series are cut (``functions.ordered``).
    """
    states = history.select(key, F.col("effective_at").cast(fact.schema[ts].dataType).alias(ts), F.struct(*attributes).alias("_state"))
    met = as_of_join(fact, states, [key], ts, "_state")
    return met.select(*fact.columns, *[F.col(f"_state.{c}").alias(c) for c in attributes])
