"""Tables stored between the steps of an operator, and bounds on what is broadcast."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rillmark.session import checkpoint_dir, scratch_path


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again.

    Cuts the lineage like a checkpoint and survives lost executors; columns are
    compressed and a reader takes only those it needs.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a stored table that no later step reads."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_column(column: pa.Array) -> pa.Array:
    """A string column without nulls (null counts as the empty text) and with 64-bit offsets."""
    return column.cast(pa.large_string()).fill_null("")


def row_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2 << 20, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each has at most ``rows`` rows and ``column`` about ``limit`` bytes, one row at least."""
    import numpy as np

    for batch in batches:
        text = text_column(batch.column(column))
        ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, min(first + rows, int(np.searchsorted(ends, ends[first] + limit, "right")) - 1))
            yield batch.slice(first, last - first)
            first = last


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` has it, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
