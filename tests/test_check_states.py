"""Check states that merge, and runs that read changed partitions only."""

from datetime import date, datetime, timedelta

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rillmark.catalog.tables import messages
from rillmark.operators import quality as q
from rillmark.operators.check_states import merged_suites
from rillmark.plans import jobs
from rillmark.plans.quality_states import refresh_states
from rillmark.sinks.compaction import compact_files
from rillmark.sources.streams import StreamConfig
from rillmark.sources.tables import Lake, latest_report, read_table
from rillmark.streaming.queries import DRAIN

AS_OF = datetime(2024, 1, 31)
FLAT = ("suite", "name", "passed", "tested", "failed")
KIND = "user_id string, session_id string, event_type string, device_type string, price double, timestamp timestamp_ntz, event_date date"


@pytest.fixture
def table(spark, tmp_path):
    path, root = str(tmp_path / "events"), str(tmp_path / "states")

    class Table:
        def add(self, data, mode="append"):
            df = spark.createDataFrame(data, KIND)
            df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)

        def refresh(self):
            return refresh_states(spark, path, root, "event_date")

        def whole(self, approx=False):
            return rows(q.run_suites(spark.read.parquet(path), AS_OF).select(*FLAT))

    table = Table()
    table.path, table.root = path, root
    return table


def event(user, session, day, kind="page_view", device="mobile", price=1.0):
    at = None if day is None else datetime(2024, 1, day, 12)
    return (user, session, kind, device, price, at, None if day is None else date(2024, 1, day))


def merged(states):
    return rows(merged_suites(states.rows, states.parents, AS_OF).select(*FLAT))


def test_merged_states_equal_a_whole_scan(table):
    table.add([event("u1", "s1", 1), event("u1", "s1", 1, price=-3.0), event(None, "s2", 1, device="fridge"), event("u3", None, 2)])
    first = table.refresh()
    assert (first.parts_read, first.rows_read) == (("2024-01-01", "2024-01-02"), 4) and merged(first) == table.whole()
    again = table.refresh()
    assert (again.parts_read, again.rows_read) == ((), 0) and merged(again) == table.whole()
    # a session of another day with a second user, and an event without a day
    table.add([event("u9", "s1", 3), event("u4", "s4", None)])
    third = table.refresh()
    assert (third.parts_read, third.rows_read) == (("2024-01-03", "none"), 2) and merged(third) == table.whole()
    assert ("referential_integrity", "session_id_has_one_user_id", False, 3, 1) in merged(third)
    # late rows of a day that is known already
    table.add([event("u5", "s5", 2, kind="teleport")])
    fourth = table.refresh()
    assert (fourth.parts_read, fourth.rows_read) == (("2024-01-02",), 2) and merged(fourth) == table.whole()


def test_replaced_emptied_and_dropped_days(spark, table):
    table.add([event("u1", "s1", 1), event("u1", "s2", 2, device="fridge"), event("u2", "s2", 3)])
    assert merged(table.refresh()) == table.whole()
    table.add([event("u2", "s2", 2)], "overwrite")
    assert table.refresh().parts_read == ("2024-01-02",) and merged(table.refresh()) == table.whole()
    for value, empty in (("2024-01-03", True), ("2024-01-01", False)):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{table.path}/event_date={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        if empty:
            spark.createDataFrame([], KIND).drop("event_date").coalesce(1).write.parquet(folder.toString())
        states = table.refresh()
        assert states.rows_read == 0 and merged(states) == table.whole()


def test_a_lost_run_is_done_again(spark, table):
    table.add([event("u1", "s1", 1), event("u2", "s2", 2)])
    table.refresh()
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{table.root}/marks")
    marks.getFileSystem(spark._jsc.hadoopConfiguration()).delete(marks, True)
    states = table.refresh()
    assert states.rows_read == 2 and merged(states) == table.whole()


def test_packed_files_change_no_verdict(spark, table):
    for k in range(4):
        table.add([event(f"u{k}", f"s{k}", 1 + k % 2)])
    before = merged(table.refresh())
    compact_files(spark, table.path)
    assert merged(table.refresh()) == before == table.whole()


def test_empty_table_has_no_checks(spark, table):
    spark.createDataFrame([], KIND).write.parquet(table.path)
    assert merged(table.refresh()) == table.whole() == []


def test_only_changed_partitions_are_scanned(spark, table, monkeypatch):
    table.add([event("u1", "s1", k) for k in range(1, 9)])
    table.refresh()
    table.add([event("u2", "s2", 4)])
    scanned = []
    table_of = refresh_states.__globals__["check_states"]
    monkeypatch.setitem(refresh_states.__globals__, "check_states", lambda df, by: scanned.append(df) or table_of(df, by))
    table.refresh()
    assert "PartitionFilters: [" in plan(scanned[-1]) and "2024-01-04" in plan(scanned[-1]) and scanned[-1].count() == 2


def test_refresh_of_a_lake_judges_by_states(spark, tmp_path):
    messages(spark, "/root/testdata/sf0.001").repartition(3, "offset").write.parquet(str(tmp_path / "in/clickstream"))
    lake = Lake(str(tmp_path / "lake"))
    for query in jobs.bronze_job(spark, lake, StreamConfig(kind="files", directory=str(tmp_path / "in")), topics=("clickstream",), trigger=DRAIN):
        query.awaitTermination()
    assert jobs.run_all(spark, lake, AS_OF) == "success"
    by_states = rows(q.checks_of_reports(latest_report(spark, lake.reports)).where("name not like 'uniqueness%'"))
    assert jobs.quality_job(spark, lake, AS_OF + timedelta(days=1))
    whole = rows(q.checks_of_reports(latest_report(spark, lake.reports)).where("name not like 'uniqueness%'"))
    assert [r[1:] for r in by_states] == [r[1:] for r in whole]
    # a changed device in one day blocks the next run
    day = read_table(spark, lake, "silver_clickstream").agg(F.max("event_date")).first()[0]
    folder = f"{lake.path('silver_clickstream')}/event_date={day}"
    spark.read.parquet(folder).withColumn("device_type", F.lit("fridge")).write.mode("append").parquet(folder)
    assert not jobs.quality_job(spark, lake, AS_OF, changed_only=True)
