"""What queries move and hold as their tables grow, on small hand-written tables."""

import re
from contextlib import contextmanager
from datetime import datetime

import pytest
from conftest import plan, rows

from rillmark.session import scratch_path

TABLES = {
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [
        (1, "a", 1, 0.0, "AUTO"), (2, "b", 2, 0.0, "TOOLS"), (4, "d", None, 0.0, None), (4, "d", None, 0.0, None), (None, "n", 3, 0.0, "NONE")]),
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", [
        (1, "p", "B1", "T", 1, 10.0), (2, "q", "B2", "T", 1, 20.0), (None, "r", "B3", "T", 1, 30.0)]),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string", [
        (k, c, "O", 1.0, at, "5-LOW") for k, c, at in (
            (1, 1, datetime(1997, 1, 1)), (2, 2, datetime(1997, 1, 1)), (3, 2, datetime(1998, 1, 1)), (4, 9, datetime(1997, 1, 1)),
            (5, None, datetime(1997, 1, 1)), (6, 4, datetime(1999, 1, 1)), (6, 2, datetime(1999, 1, 1)), (7, 2, None))]),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double", [
        *[(k, p, 1, 1, 2.0, 21.0, 0.05, 0.02) for k in (1, 2, 3, 4, 5, 6, 7) for p in (1, 2, 7, None)],
        (8, 1, 1, 1, 0.0, 21.0, 0.05, 0.02), (None, 1, 1, 1, 0.0, 21.0, 0.05, 0.02)]),  # lines of no order are not priced
}


@pytest.fixture(scope="module")
def shop(spark):
    root = scratch_path(spark, "shop")
    for name, (schema, data) in TABLES.items():
        spark.createDataFrame(data, schema).write.parquet(f"{root}/{name}.parquet")
    return root


@contextmanager
def settings(spark, **conf):
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


def exchanges_above(text: str, scan: str) -> list[str]:
    """Shuffles between the root of a plan and the scan of a table."""
    path: list[tuple[int, str]] = []
    for line in text.splitlines():
        depth = re.search(r"[A-Za-z*]", line).start()
        path = [(d, node) for d, node in path if d < depth] + [(depth, line)]
        if "FileScan" in line and scan in line:
            return [node for _, node in path if "Exchange hashpartitioning" in node]
    raise AssertionError(f"no scan of {scan}")


def test_sales_lines_are_shuffled_twice(spark, entry, shop):
    with settings(spark, **LARGE):
        text = plan(entry.queries()["sales_fact"](spark, shop))
    assert len(exchanges_above(text, "l_orderkey")) <= 2
    assert len(exchanges_above(text, "o_custkey")) <= 2


def test_sales_fact_of_odd_keys(spark, entry, shop):
    """Keys that are null, unknown or repeated, large and small tables alike."""
    sold = entry.queries()["sales_fact"](spark, shop)
    found = rows(sold.select("transaction_id", "product_id", "customer_tier", "keyed"))
    with settings(spark, **LARGE):
        assert rows(entry.queries()["sales_fact"](spark, shop)) == rows(sold)
    tiers = [("1", "AUTO"), ("2", "TOOLS"), ("3", "TOOLS_PLUS"), ("4", None), ("5", None), ("6", None), ("6", "TOOLS_PLUS"), ("7", None)]
    known = {"1", "2", "3", "6"}
    expected = [(order, product, tier, order in known and product in ("prod_1", "prod_2")) for order, tier in tiers for product in ("prod_1", "prod_2", "prod_7", None)]
    assert found == sorted(expected, key=str)


def test_message_files_grow_in_number(spark):
    """Events are written into files of a bounded size, so that no task reads a fixed share of them."""
    from rillmark.catalog.streams import _message_lake

    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.shuffle.partitions": "64"}
    with settings(spark, **small):
        _, config = _message_lake(spark, "/root/testdata/sf0.001")
    written = spark.read.parquet(f"{config.directory}/clickstream")
    assert len(written.inputFiles()) > 4 and written.count() == 1020


def test_waiting_events_share_state_rows(spark, tmp_path):
    """State grows by a row per user and arrival, whatever the number of events; PACK bounds a row."""
    from datetime import timedelta

    from rillmark.sources.streams import read_files_stream
    from rillmark.streaming import sessions
    from rillmark.streaming.queries import DRAIN

    t0 = datetime(2024, 1, 1)
    data = [(f"u{k % 2}", str(k), "view", t0 + timedelta(seconds=k)) for k in range(2 * sessions.PACK + 2)]
    schema = "user_id string, event_id string, event_type string, event_ts timestamp"
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = read_files_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema)
    out = sessions.sessions_until(stream, timedelta(hours=1), "buy", watermark="2 hours")
    with sessions.rocks_state(spark):
        query = out.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/ckpt").trigger(**DRAIN).start()
    query.awaitTermination()
    state = spark.read.format("statestore").option("stateVarName", "arrived").load(f"{tmp_path}/ckpt")
    sizes = sorted(len(r["at"]) for r in state.select("list_element.at").collect())
    assert sizes == [1, 1, sessions.PACK, sessions.PACK]
