"""Equi joins of a big table with a lookup table of unknown size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

SALTS = 32
COUNTED_BYTES = 8 * 1024**2
LEAST_SHARE = 0.001
#: Estimates from here on stand for no estimate, as those of rows that come from Python.
UNKNOWN_BYTES = 2**60


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan; nothing is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes; -1 when broadcasting is off."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def hot_keys(df: DataFrame, keys: list[str], salts: int = SALTS) -> list[Row]:
    """Keys with more than 1/(4*salts) of the rows each.

    There can be fewer than 4*salts of them, so the list is small whatever the
    size of the table. Only key columns are read, and rows are counted before
    the shuffle. Above ``COUNTED_BYTES`` a sample is counted, of frames whose size
    is not known all rows: the list decides how work is split, never what comes out.
    """
    rows = df.select(*keys)
    size = estimated_bytes(rows)
    share = COUNTED_BYTES / max(size, 1)
    if share < 1 and size < UNKNOWN_BYTES:
        rows = rows.sample(max(share, LEAST_SHARE), seed=0)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col("_n") * (4 * salts) > total).select(*keys).collect()


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "left",
    valid: tuple[str, str, str] | None = None,
    broadcast_bytes: int | None = None,
    salts: int = SALTS,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Join on equal keys, optionally with ``valid = (moment, from, to)``.

    ``valid`` keeps the dimension version with ``from <= moment < to`` (an open
    ``to`` never ends). A dimension whose size estimate is within
    ``broadcast_bytes`` (by default the session's threshold) is left to Catalyst,
    which broadcasts it. Beyond that the keys are counted first: rows of hot keys
    are spread over ``salts`` partitions and the dimension rows of those few keys
    are replicated; without hot keys it is an ordinary shuffled join. In a chain
    of joins give the first table as ``keys_from``, so that counting keys does
    not run the joins before.
    """
    if how not in ("inner", "left", "left_outer", "leftouter", "left_semi", "semi", "left_anti", "anti"):
        raise ValueError(f"a lookup keeps the rows of its first table; {how!r} is not supported, as copies of the second would show")
    limit = broadcast_limit(dim) if broadcast_bytes is None else broadcast_bytes
    if estimated_bytes(dim) <= limit:
        return _join(fact, dim, on, how, valid)
    hot = [] if fact.isStreaming else hot_keys(fact if keys_from is None else keys_from, on, salts)
    if not hot:
        return _join(fact, dim, on, how, valid)

    is_hot = is_one_of(on, hot)
    spread = F.when(is_hot, F.pmod(F.xxhash64(*fact.columns), F.lit(salts)).cast("int")).otherwise(0)
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_fact = fact.withColumn("_salt", spread)
    salted_dim = dim.withColumn("_salt", F.explode(copies))
    return _join(salted_fact, salted_dim, [*on, "_salt"], how, valid).drop("_salt")


def is_one_of(names: list[str], keys: list[Row]) -> Column:
    """True for rows whose key is in a short list; null equals null."""
    same = [reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.lit(key[n])) for n in names]) for key in keys]
    return reduce(lambda a, b: a | b, same)


def _join(fact: DataFrame, dim: DataFrame, on: list[str], how: str, valid) -> DataFrame:
    if valid is None:
        return fact.join(dim, on, how)
    moment, start, end = valid
    left, right = fact.alias("f"), dim.alias("d")
    same = [F.col(f"f.{key}") == F.col(f"d.{key}") for key in on]
    when = (F.col(f"f.{moment}") >= F.col(f"d.{start}")) & (
        F.col(f"d.{end}").isNull() | (F.col(f"f.{moment}") < F.col(f"d.{end}"))
    )
    joined = left.join(right, reduce(lambda a, b: a & b, same) & when, how)
    extra = [] if how in ("left_semi", "semi", "left_anti", "anti") else [F.col(f"d.{c}") for c in dim.columns if c not in on]
    return joined.select("f.*", *extra)
