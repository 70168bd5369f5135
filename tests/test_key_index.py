"""Index of keys: same rows as the plain insert, only partitions with a hit are opened, and safe when a run is lost."""

import glob
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rillmark.session import scratch_path
from rillmark.sinks import key_index
from rillmark.sinks.key_index import insert_indexed, repeated_keys
from rillmark.sinks.tables import rows_to_insert

SCHEMA = "k bigint, name string, v double, day int"


def frame(spark, made):
    return spark.createDataFrame(made, SCHEMA)


def spoil(path, day):
    """Make the files of a partition unreadable."""
    names = glob.glob(f"{path.removeprefix('file:')}/day={day}/*")
    assert names
    for name in names:
        with open(name, "wb") as f:
            f.write(b"no parquet")


@pytest.mark.parametrize("seed", [1, 2])
def test_same_rows_as_the_plain_insert(spark, seed):
    draw = random.Random(seed)
    path = scratch_path(spark, "keyed")
    stored, keys = [], ["k", "name"]
    for _ in range(3):
        batch = [(draw.choice([None, *range(60)]), draw.choice(["a", "b", None, ""]), None, draw.choice([1, 2, 3, None])) for _ in range(40)]
        new = frame(spark, batch)
        before = {r[:2] for r in stored if None not in r[:2]}
        plain = rows_to_insert(new, path, keys).select(*keys) if stored else new.dropDuplicates(keys).select(*keys)
        expected = rows(plain)
        done = insert_indexed(new, path, keys, ["day"])
        table = spark.read.schema(SCHEMA).parquet(path)
        now = rows(table.select(*keys))
        assert done.rows == len(expected) and now == sorted([r[:2] for r in stored] + expected, key=str)
        stored = [tuple(r) for r in table.select("k", "name", "v", "day").collect()]
        assert not before & {e for e in expected if None not in e}
    assert rows(repeated_keys(table, path, keys, ["day"])) == []


def test_partitions_without_a_hit_are_not_opened(spark):
    path = scratch_path(spark, "keyed")
    insert_indexed(frame(spark, [(k, "x", 1.0, k % 5) for k in range(100)]), path, ["k"], ["day"])
    spoil(path, 0), spoil(path, 2)
    new = [(1, "y", 2.0, 9), (6, "y", 2.0, 2), (13, "y", 2.0, 9), (1000, "y", 2.0, 2), (1000, "z", 2.0, 2)]
    done = insert_indexed(frame(spark, new), path, ["k"], ["day"])
    assert (done.rows, done.opened) == (1, ('{"day":1}', '{"day":3}'))
    done = insert_indexed(frame(spark, [(2000, "y", 2.0, 0)]), path, ["k"], ["day"])
    assert (done.rows, done.opened) == (1, ())
    with pytest.raises(Exception):
        insert_indexed(frame(spark, [(2, "y", 2.0, 9)]), path, ["k"], ["day"])


def test_equal_hashes_of_different_keys_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(key_index.F, "xxhash64", lambda *keys: F.length(F.col(keys[0]).cast("string")).cast("bigint"))
    path = scratch_path(spark, "keyed")
    assert insert_indexed(frame(spark, [(k, "x", 1.0, 1) for k in range(5)]), path, ["k"], ["day"]).rows == 5
    assert insert_indexed(frame(spark, [(k, "x", 1.0, 2) for k in range(9)]), path, ["k"], ["day"]).rows == 4
    assert rows(repeated_keys(spark.read.schema(SCHEMA).parquet(path), path, ["k"], ["day"])) == []


def test_a_lost_run_is_made_good(spark):
    """Hashes without rows, a staged batch that was left, and a table that was there before its index."""
    path = scratch_path(spark, "keyed")
    frame(spark, [(1, "a", 1.0, 1), (2, "a", 1.0, 2), (2, "b", 1.0, 3)]).write.partitionBy("day").parquet(path)
    table = spark.read.schema(SCHEMA).parquet(path)
    assert rows(repeated_keys(table, path, ["k"], ["day"])) == [(2, 2)]
    lost = frame(spark, [(2, "c", 1.0, 4), (3, "c", 1.0, 4)])
    key_index._hashes(lost, ["k"], ["day"]).write.mode("append").partitionBy("day").parquet(f"{path}/_keys/rows")
    lost.write.parquet(f"{path}/_insert/lost/rows")
    assert spark.read.schema(SCHEMA).parquet(path).count() == 3  # readers see neither
    done = insert_indexed(lost, path, ["k"], ["day"])
    assert done.rows == 1 and insert_indexed(lost, path, ["k"], ["day"]).rows == 0
    assert rows(spark.read.schema(SCHEMA).parquet(path).select("k", "name", "day")) == [(1, "a", 1), (2, "a", 2), (2, "b", 3), (3, "c", 4)]


def test_empty_types_and_bounds(spark):
    path = scratch_path(spark, "keyed")
    assert insert_indexed(frame(spark, []), path, ["k"], ["day"]).rows == 0
    assert insert_indexed(frame(spark, [(1, "a", 1.0, 1), (2, "a", 1.0, 5)]), path, ["k"], ["day"]).rows == 2
    assert insert_indexed(frame(spark, [(1, "a", 1.0, 6), (2, "a", 1.0, 6)]), path, ["k"], ["day"], F.col("day") >= 4).rows == 1
    with pytest.raises(ValueError):
        insert_indexed(frame(spark, [(1, "a", 1.0, 1)]).withColumn("k", F.col("k").cast("int")), path, ["k"], ["day"])
