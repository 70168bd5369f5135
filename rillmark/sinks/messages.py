"""Rows as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_messages(df: DataFrame, key_cols: tuple[str, ...] = ("user_id", "transaction_id")) -> DataFrame:
    """Key and JSON value. The key is the first of ``key_cols`` that has a value; nulls stay in the JSON."""
    keys = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in key_cols if c in df.columns]
    return df.select(
        F.coalesce(*keys).alias("key"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    )
