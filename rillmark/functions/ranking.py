"""Exact ranks over a whole table, without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.session import cut_lineage

_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def with_global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Add 1..n in the given total order, plus ``_total`` = n.

    Rows are range-partitioned and sorted, then frozen by a checkpoint, because
    range bounds come from sampling and must not change between the two reads.
    Each row's rank is its position in its partition plus the sizes of the
    partitions before it (one row per partition, so the broadcast is bounded).
    """
    placed = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slot", F.monotonically_increasing_id())
    )
    located = placed.withColumn("_part", F.shiftright("_slot", _POSITION_BITS))
    sizes = located.groupBy("_part").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_skip"),
        F.sum("_rows").over(Window.partitionBy()).alias("_total"),
    )
    position = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return located.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_skip") + position + 1).alias(name), "_total"
    )


def with_running_total(df: DataFrame, order: list[Column], value: str, name: str = "running") -> DataFrame:
    """Add the sum of ``value`` up to and including each row of the total order, plus ``_total``.

    As for ranks, each partition sums its own rows and adds the sums of the partitions before it.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slot", F.monotonically_increasing_id())
    )
    located = placed.withColumn("_part", F.shiftright("_slot", _POSITION_BITS))
    sums = located.groupBy("_part").agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_part",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_sum").over(Window.partitionBy()).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return located.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.sum(value).over(inside) + F.col("_before")).alias(name), "_total"
    )


def bucket_of(rank: Column, total: Column, k: int) -> Column:
    """Bucket 1..k of a rank, sized as ``ntile(k)`` sizes them: the first buckets get the remainder."""
    small = F.floor(total / k)
    rest = total % k
    in_large = F.floor((rank - 1) / (small + 1)) + 1
    in_small = F.floor((rank - 1 - rest * (small + 1)) / F.greatest(small, F.lit(1))) + 1 + rest
    return F.when(rank <= rest * (small + 1), in_large).otherwise(in_small).cast("int")


def quartile(df: DataFrame, order: list[Column], name: str, k: int = 4) -> DataFrame:
    """Add the ``ntile(k)`` bucket of every row in the given total order."""
    ranked = with_global_rank(df, order, "_rank")
    return ranked.select(*df.columns, bucket_of(F.col("_rank"), F.col("_total"), k).alias(name))
