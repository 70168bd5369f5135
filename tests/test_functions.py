"""Ordered, ranking and lookup building blocks, with skewed and degenerate input."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import plan, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from rillmark.functions import columns as c
from rillmark.functions import ordered
from rillmark.functions.lookup import hot_keys, lookup_join
from rillmark.functions.ordered import with_previous, with_running
from rillmark.functions.ranking import bucket_of, quartile, with_global_rank, with_running_total

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def series(spark):
    """2,000 rows, a third of them of one key, some with a null key, with ties in time."""
    rng = random.Random(7)
    data = []
    for i in range(2000):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(40)}"
        at = START + timedelta(minutes=rng.randrange(3 * 24 * 60))
        value = rng.randrange(-50, 100) if i % 7 else None
        data.append((key, at, i, value))
    return spark.createDataFrame(data, "key string, ts timestamp, id int, value int").cache()


@pytest.mark.parametrize("large", [0, 300, 10**6])
def test_previous_equals_plain_lag(series, monkeypatch, large):
    monkeypatch.setattr(ordered, "LARGE_SERIES", large)
    out = with_previous(series, ["key"], "ts", ["id"], {"prev_ts": "ts", "prev_value": "value"})
    w = Window.partitionBy("key").orderBy("ts", "id")
    known = F.col("key").isNotNull()
    plain = series.withColumns(
        {"prev_ts": F.when(known, F.lag("ts").over(w)), "prev_value": F.when(known, F.lag("value").over(w))}
    )
    assert rows(out) == rows(plain)


@pytest.mark.parametrize("large", [0, 300, 10**6])
@pytest.mark.parametrize("kind", ["sum", "max", "min", "last"])
def test_running_equals_plain_window(series, monkeypatch, kind, large):
    monkeypatch.setattr(ordered, "LARGE_SERIES", large)
    out = with_running(series, ["key"], "ts", ["id"], {"run": (kind, "value")})
    w = Window.partitionBy("key").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    form = {"sum": F.sum, "max": F.max, "min": F.min, "last": lambda v: F.last(v, ignorenulls=True)}[kind]
    plain = series.withColumn("run", F.when(F.col("key").isNotNull(), form("value").over(w)))
    assert rows(out) == rows(plain)


def test_running_never_windows_large_series_by_key_alone(series, monkeypatch):
    monkeypatch.setattr(ordered, "LARGE_SERIES", 0)
    text = plan(with_running(series, ["key"], "ts", ["id"], {"run": ("sum", "value")}))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "value" in line]
    assert all("_chunk" in line or "pmod" in line or "_w" in line for line in exchanges)
    assert "SinglePartition" not in text


@pytest.mark.parametrize("n", [0, 1, 3, 4, 10, 101, 1000])
def test_quartile_equals_ntile(spark, n):
    df = spark.range(n).select("id", (F.col("id") * 7919 % 13).alias("v"))
    out = quartile(df, [F.col("v"), F.col("id")], "q")
    plain = df.withColumn("q", F.ntile(4).over(Window.orderBy("v", "id")))
    assert rows(out) == rows(plain)


def test_quartile_of_equal_values(spark):
    df = spark.range(37).withColumn("v", F.lit(1))
    out = quartile(df, [F.desc("v"), F.col("id")], "q")
    assert [r["count"] for r in out.groupBy("q").count().orderBy("q").collect()] == [10, 9, 9, 9]


def test_global_rank_uses_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
        out = with_global_rank(df, [F.col("v")])
        assert out.where("rank <> v + 1").count() == 0
        assert out.rdd.getNumPartitions() > 1
        assert "Window" not in plan(out).split("BroadcastExchange")[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("n", [0, 1, 5, 997])
def test_running_total_equals_plain_window(spark, n):
    df = spark.range(n).select((F.col("id") * 7919 % 1009).alias("v"), (F.col("id") % 5).alias("w"))
    plain = df.withColumn("running", F.sum("w").over(Window.orderBy("v"))).withColumn("_total", F.lit(sum(k % 5 for k in range(n))).cast("bigint"))
    assert rows(with_running_total(df, [F.col("v")], "w")) == rows(plain)


@settings(max_examples=30, deadline=None)
@given(n=st.integers(1, 400), k=st.integers(1, 9))
def test_bucket_sizes(spark, n, k):
    sizes = spark.range(1, n + 1).select(bucket_of(F.col("id"), F.lit(n), k).alias("b")).groupBy("b").count().collect()
    counts = {r["b"]: r["count"] for r in sizes}
    assert counts == {b: n // k + (1 if b <= n % k else 0) for b in range(1, k + 1) if n // k + (1 if b <= n % k else 0)}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, series, how):
    dim = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("k1", "c"), ("zz", "d")], "key string, name string")
    salted = lookup_join(series, dim, ["key"], how, broadcast_bytes=-1, salts=4)
    assert rows(salted) == rows(series.join(dim, "key", how))


def test_salted_join_spreads_the_hot_key(spark, series):
    dim = spark.createDataFrame([("hot", "a")], "key string, name string")
    text = plan(lookup_join(series, dim, ["key"], "left", broadcast_bytes=-1, salts=4))
    assert "_salt" in text
    assert {r["key"] for r in hot_keys(series, ["key"], 4)} == {"hot"}


def test_null_keys_may_be_hot(spark):
    facts = spark.range(100).select(F.when(F.col("id") > 60, F.lit("a")).alias("key"), "id")
    dim = spark.createDataFrame([("a", 1)], "key string, n int")
    assert None in [r["key"] for r in hot_keys(facts, ["key"], 4)]
    assert lookup_join(facts, dim, ["key"], "left", broadcast_bytes=-1, salts=4).count() == 100


def test_validity_join_on_boundaries(spark):
    facts = spark.createDataFrame(
        [(1, "c", datetime(2024, 1, 1)), (2, "c", datetime(2024, 2, 1)), (3, "c", datetime(2023, 1, 1)), (4, "x", datetime(2024, 1, 1))],
        "id int, key string, at timestamp",
    )
    dim = spark.createDataFrame(
        [("c", 1, datetime(2024, 1, 1), datetime(2024, 2, 1)), ("c", 2, datetime(2024, 2, 1), None)],
        "key string, version int, a timestamp, b timestamp",
    )
    for limit in (-1, 1 << 30):
        out = lookup_join(facts, dim, ["key"], "left", valid=("at", "a", "b"), broadcast_bytes=limit, salts=1)
        assert {(r["id"], r["version"]) for r in out.collect()} == {(1, 1), (2, 2), (3, None), (4, None)}


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(0.0, 0.0, "2024-01-31T23:59:59Z"), (10.0, 4.0, "garbage"), (None, 1.0, None)], "a double, b double, t string")
    out = df.select(
        c.percent(F.col("b"), F.col("a")).alias("p"),
        c.event_time(F.col("t")).alias("t"),
        c.margin_pct(F.col("a").cast("decimal(10,2)"), F.col("b").cast("decimal(10,2)")).alias("m"),
    ).collect()
    assert [r["p"] for r in out] == [None, 40.0, None]
    assert [r["t"] for r in out] == [datetime(2024, 1, 31, 23, 59, 59), None, None]
    assert [None if r["m"] is None else float(r["m"]) for r in out] == [None, 60.0, None]


def test_prefix_tags_and_text(spark):
    df = spark.createDataFrame([("business.funnel.search", {"k": "v"}, " ABC "), ("other", None, None)], "n string, m map<string,string>, t string")
    out = df.select(
        c.strip_prefix(F.col("n"), "business.funnel.").alias("n"), c.tag(F.col("m"), "k").alias("k"), c.normalise_text(F.col("t")).alias("t")
    ).collect()
    assert [tuple(r) for r in out] == [("search", "v", "abc"), ("other", None, "unknown")]


def test_time_zone_offsets_are_one_instant(spark):
    df = spark.createDataFrame([("2024-01-31T23:30:45Z",), ("2024-01-31T18:30:45-05:00",)], "t string")
    out = df.select(F.to_date(c.event_time(F.col("t"))).alias("d"), F.hour(c.event_time(F.col("t"))).alias("h")).distinct().collect()
    assert [(str(r["d"]), r["h"]) for r in out] == [("2024-01-31", 23)]


def test_hot_keys_of_a_large_table_come_from_a_sample(spark, series, monkeypatch):
    from rillmark.functions import lookup

    monkeypatch.setattr(lookup, "COUNTED_BYTES", 1)
    monkeypatch.setattr(lookup, "LEAST_SHARE", 0.2)
    assert "hot" in {r["key"] for r in hot_keys(series, ["key"], 4)}
    dim = spark.createDataFrame([("hot", "a"), ("k1", "c")], "key string, name string")
    salted = lookup_join(series, dim, ["key"], "left", broadcast_bytes=-1, salts=4)
    assert rows(salted) == rows(series.join(dim, "key", "left"))


@pytest.mark.parametrize("how", ["right", "full", "right_outer", "outer", "cross"])
def test_lookups_keep_the_first_table(series, how):
    with pytest.raises(ValueError):
        lookup_join(series, series.select("key"), ["key"], how)


def test_hot_key_of_a_frame_of_unknown_size(spark):
    data = [("hot" if i % 10 else f"k{i}", i) for i in range(1000)]
    unknown = spark.createDataFrame(spark.sparkContext.parallelize(data), "key string, v int")
    assert [r["key"] for r in hot_keys(unknown, ["key"])] == ["hot"]


def test_scratch_paths_are_deleted_on_demand(spark, monkeypatch):
    import os

    from rillmark import session

    monkeypatch.setattr(session, "_scratch", [])
    path = session.scratch_path(spark, "some")
    spark.range(3).write.parquet(path)
    local = path.replace("file:", "")
    assert os.path.isdir(local) and session.clear_scratch(spark) == 1 and not os.path.exists(local)
