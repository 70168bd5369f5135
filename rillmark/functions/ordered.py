"""Ordered computations over long series, without one task per long series.

A plain window puts a whole series into one task, which is right for series of a
bounded size. Series with more than ``LARGE_SERIES`` rows are cut into chunks: rows are
windowed inside their chunk, each chunk is reduced to one row, and only those rows are
windowed along the series. Chunks are calendar hours, and minutes for the few series
that hold a large share of the table, so a series with a third of all rows is spread
over as many tasks as it has minutes. Both ways give the same values. Rows whose key is
null belong to no series, are spread, and get nulls.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rillmark.functions.lookup import hot_keys, is_one_of
from rillmark.session import cut_lineage

_CHUNK = "_chunk"
#: Rows of a series that one task may order.
LARGE_SERIES = 500_000
#: Tasks that rows without a key are spread over.
SPREAD = 1024


def _by_size(df: DataFrame, by: list[str], plain, chunked) -> DataFrame:
    """``plain`` on the rows of small series and ``chunked`` on those of large ones.

    Series are counted first, with partial sums before the shuffle; the keys of the large
    ones are a small table, as each stands for many rows.
    """
    counts = df.where(_known(by)).groupBy(*by).agg(F.count("*").alias("_n"))
    large = cut_lineage(counts.where(F.col("_n") > LARGE_SERIES).select(*by, F.lit(True).alias("_large")))
    if large.isEmpty():
        return plain(df)
    flagged = df.join(large, by, "left")
    parts = [flagged.where(F.col("_large").isNull()), flagged.where("_large")]
    return plain(parts[0].select(*df.columns)).unionByName(chunked(parts[1].select(*df.columns)))


def _whole(by: list[str], ts: str, tie: list[str]) -> WindowSpec:
    """The window of a whole series; rows without a key are spread, as they get nulls anyway."""
    loose = F.when(~_known(by), F.pmod(F.xxhash64(ts, *tie), F.lit(SPREAD)))
    return Window.partitionBy(*by, loose).orderBy(ts, *tie)


def with_previous(
    df: DataFrame,
    by: list[str],
    ts: str,
    tie: list[str],
    columns: dict[str, str],
    chunk: Column | str | None = None,
    large_chunk: Column | str | None = None,
) -> DataFrame:
    """Add values of the preceding row of the series: ``columns`` maps new name to source.

    With ``chunk`` all series are cut by it, else large ones only, by ``large_chunk`` or by time.
    """
    if chunk is None:
        before = _whole(by, ts, tie)
        added = {name: F.when(_known(by), F.lag(source).over(before)) for name, source in columns.items()}
        return _by_size(df, by, lambda rows: rows.withColumns(added), lambda rows: _previous_by_chunk(rows, by, ts, tie, columns, large_chunk))
    return _previous_by_chunk(df, by, ts, tie, columns, chunk)


def _previous_by_chunk(df, by, ts, tie, columns, chunk) -> DataFrame:
    sources = list(dict.fromkeys(columns.values()))
    chunked = df.withColumn(_CHUNK, chunk_of(df, by, ts, chunk))
    inside = Window.partitionBy(*by, _CHUNK).orderBy(ts, *tie)
    here = chunked.withColumn("_before", F.lag(F.struct(*sources)).over(inside))

    # the time alone is a plain maximum, which aggregates by hash; other columns need the whole last row
    last = F.struct(F.max(ts).alias(ts)) if sources == [ts] else F.max_by(F.struct(*sources), F.struct(ts, *tie))
    ends = chunked.groupBy(*by, _CHUNK).agg(last.alias("_last"))
    along = Window.partitionBy(*by).orderBy(_CHUNK)
    carried = ends.select(*by, _CHUNK, F.lag("_last").over(along).alias("_carried"))

    joined = here.join(carried, [*by, _CHUNK], "left")
    in_series = _known(by)
    value = F.when(in_series, F.coalesce("_before", "_carried"))
    added = [value[source].alias(name) for name, source in columns.items()]
    return joined.select(*[F.col(c) for c in df.columns], *added)


def with_running(
    df: DataFrame,
    by: list[str],
    ts: str,
    tie: list[str],
    columns: dict[str, tuple[str, str]],
    chunk: Column | str | None = None,
    large_chunk: Column | str | None = None,
) -> DataFrame:
    """Add running aggregates up to and including each row.

    ``columns`` maps a new name to ``(kind, source)`` with kind ``sum``, ``max``,
    ``min`` or ``last`` (last value that is not null). With ``chunk`` all series are cut
    by it, else large ones only, by ``large_chunk`` or by time.
    """
    if chunk is None:
        upto = _whole(by, ts, tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        added = {name: F.when(_known(by), _window_form(kind, source).over(upto)) for name, (kind, source) in columns.items()}
        return _by_size(df, by, lambda rows: rows.withColumns(added), lambda rows: _running_by_chunk(rows, by, ts, tie, columns, large_chunk))
    return _running_by_chunk(df, by, ts, tie, columns, chunk)


def with_chain(df: DataFrame, by: list[str], ts: str, tie: list[str], steps: list[tuple[str, str, str, dict[str, Column]]]) -> DataFrame:
    """Running aggregates that build on each other, over one order of the series.

    Each step ``(name, kind, source, derived)`` adds a running aggregate as in
    ``with_running`` and then the columns ``derived`` from it, which later steps may use as
    source. Series are counted once; small ones are sorted once for all steps.
    """
    upto = _whole(by, ts, tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def plain(rows: DataFrame) -> DataFrame:
        for name, kind, source, derived in steps:
            rows = rows.withColumn(name, F.when(_known(by), _window_form(kind, source).over(upto))).withColumns(derived)
        return rows

    def chunked(rows: DataFrame) -> DataFrame:
        for name, kind, source, derived in steps:
            rows = _running_by_chunk(rows, by, ts, tie, {name: (kind, source)}, None).withColumns(derived)
        return rows

    return _by_size(df, by, plain, chunked)


def _running_by_chunk(df, by, ts, tie, columns, chunk) -> DataFrame:
    chunked = df.withColumn(_CHUNK, chunk_of(df, by, ts, chunk))
    inside = (
        Window.partitionBy(*by, _CHUNK).orderBy(ts, *tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    order = F.struct(ts, *tie)
    here = chunked.withColumns(
        {f"_in_{name}": _window_form(kind, source).over(inside) for name, (kind, source) in columns.items()}
    )
    totals = chunked.groupBy(*by, _CHUNK).agg(
        *[_group_form(kind, source, order).alias(name) for name, (kind, source) in columns.items()]
    )
    earlier = Window.partitionBy(*by).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *by,
        _CHUNK,
        *[_window_form(kind, name).over(earlier).alias(f"_c_{name}") for name, (kind, _) in columns.items()],
    )
    joined = here.join(carried, [*by, _CHUNK], "left")
    in_series = _known(by)
    added = [
        F.when(in_series, _merge(kind, F.col(f"_in_{name}"), F.col(f"_c_{name}"))).alias(name)
        for name, (kind, _) in columns.items()
    ]
    return joined.select(*[F.col(c) for c in df.columns], *added)


def chunk_of(df: DataFrame, by: list[str], ts: str, chunk: Column | str | None = None) -> Column:
    """The chunk of a row: the given expression or time unit, else hours or minutes by size of the series."""
    if isinstance(chunk, str):
        return F.date_trunc(chunk, F.col(ts))
    if chunk is not None:
        return chunk
    hot = hot_keys(df, by)
    hours = F.date_trunc("hour", F.col(ts))
    return F.when(is_one_of(by, hot), F.date_trunc("minute", F.col(ts))).otherwise(hours) if hot else hours


def _known(by: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in by])


def _window_form(kind: str, source: str) -> Column:
    if kind == "last":
        return F.last(source, ignorenulls=True)
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](source)


def _group_form(kind: str, source: str, order: Column) -> Column:
    if kind == "last":
        return F.max_by(F.col(source), F.when(F.col(source).isNotNull(), order))
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](source)


def _merge(kind: str, local: Column, carried: Column) -> Column:
    if kind == "sum":
        return F.when(local.isNull(), carried).otherwise(local + F.coalesce(carried, F.lit(0)))
    if kind == "last":
        return F.coalesce(local, carried)
    return F.greatest(local, carried) if kind == "max" else F.least(local, carried)
