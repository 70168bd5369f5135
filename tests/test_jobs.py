"""Jobs end to end on a small lake: streaming ingestion, gate, re-runs, listener."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rillmark.catalog.tables import messages
from rillmark.operators.mart import ALERT_RULES
from rillmark.plans import jobs
from rillmark.sinks.mart import run_row, write_run
from rillmark.sources.streams import StreamConfig
from rillmark.sources.tables import Lake, first_readable, latest_report, layer_status, read_table
from rillmark.streaming.progress import ProgressRecorder
from rillmark.streaming.queries import DRAIN, hourly_stream, silver_batch, start_gold, start_silver, stop_all

D = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 1, 31)


@pytest.fixture
def lake(spark, tmp_path):
    messages(spark, D).repartition(3, "offset").write.parquet(str(tmp_path / "in/clickstream"))
    lake = Lake(str(tmp_path / "lake"))
    config = StreamConfig(kind="files", directory=str(tmp_path / "in"))
    for query in jobs.bronze_job(spark, lake, config, topics=("clickstream",), trigger=DRAIN):
        query.awaitTermination()
    return lake


def test_whole_run_and_again(spark, lake):
    # sessions of the derived messages have no searches with text, but all suites that block pass
    assert jobs.run_all(spark, lake, AS_OF) == "success"
    silver = read_table(spark, lake, "silver_clickstream")
    first = rows(read_table(spark, lake, "gold_hourly"))
    events = silver.count()
    assert jobs.run_all(spark, lake, AS_OF) == "success"
    assert read_table(spark, lake, "silver_clickstream").count() == events
    assert rows(read_table(spark, lake, "gold_hourly")) == first
    runs = read_table(spark, lake, "pipeline_runs")
    assert [r["status"] for r in runs.collect()] == ["success", "success"]
    assert runs.first()["events_processed"] == events and runs.first()["events_failed"] > 0
    totals = read_table(spark, lake, "pipeline_metrics").where("metric_name = 'pipeline.events.total'").collect()
    assert [t["metric_value"] for t in totals] == [events]
    status = {r["table_name"]: r["row_count"] for r in layer_status(spark, lake).collect()}
    assert status["silver_clickstream"] == events and status["alerts"] == len(ALERT_RULES)
    assert set(jobs.layer_report(spark, lake)) == {"tables", "silver_validity", "gold"}
    assert all(frame.count() >= 0 for frame in jobs.analytics_job(spark, lake, AS_OF).values())


def test_blocked_gate_keeps_gold_unwritten(spark, lake):
    jobs.silver_job(spark, lake)
    with pytest.raises(jobs.PublicationBlocked):
        jobs.gold_job(spark, lake, "run_unknown")  # no report of that run
    silver = read_table(spark, lake, "silver_clickstream").withColumn("device_type", F.lit("fridge"))
    silver.write.parquet(lake.root + "/bad")
    bad = Lake(lake.root, tables={**lake.tables, "silver_clickstream": "bad"})
    refused = jobs.quality_job(spark, bad, AS_OF)
    assert not refused
    with pytest.raises(jobs.PublicationBlocked):
        jobs.gold_job(spark, bad, refused.run_id)


@pytest.mark.parametrize("first, second", [(AS_OF, datetime(2024, 1, 15)), (AS_OF, AS_OF)])
def test_gate_judges_the_report_of_its_run(spark, lake, first, second):
    """A good report of a newer time, or of the same one, does not let bad rows through, nor the other way round."""
    jobs.silver_job(spark, lake)
    good = jobs.quality_job(spark, lake, first)
    read_table(spark, lake, "silver_clickstream").withColumn("device_type", F.lit("fridge")).write.parquet(lake.root + "/bad")
    bad = Lake(lake.root, tables={**lake.tables, "silver_clickstream": "bad"})
    refused = jobs.quality_job(spark, bad, second)
    assert good and not refused
    with pytest.raises(jobs.PublicationBlocked):
        jobs.gold_job(spark, bad, refused.run_id)
    assert jobs.gold_job(spark, lake, good.run_id) > 0
    assert "fridge" not in {r["device_type"] for r in read_table(spark, lake, "gold_hourly").select("device_type").distinct().collect()}


def test_repeated_runs_replace_figures(spark, lake):
    def counts(name, *keys):
        return rows(read_table(spark, lake, name).groupBy(*keys).count())

    jobs.run_all(spark, lake, AS_OF)
    tables = (("pipeline_metrics", "metric_name", "written_by"), ("data_quality_checks", "check_name"), ("alerts", "alert_name"))
    before = [counts(*t) for t in tables]
    jobs.run_all(spark, lake, AS_OF)
    after = [counts(*t) for t in tables]
    assert before[1:] == after[1:] and [r for r in before[0] if r[1] == "figures"] == [r for r in after[0] if r[1] == "figures"]
    joined = read_table(spark, lake, "data_quality_checks").join(read_table(spark, lake, "pipeline_runs"), "run_id")
    assert joined.count() > 0


def test_only_new_raw_partitions_are_read(spark, lake):
    jobs.run_all(spark, lake, AS_OF)
    day = read_table(spark, lake, "bronze_clickstream").first()["ingestion_date"]
    assert jobs.open_ingestion_dates(spark, lake) == [str(day)]
    gone = Lake(lake.root, tables={**lake.tables, "silver_clickstream": "none", "silver_rejected": "none"})
    assert jobs.open_ingestion_dates(spark, gone) == [str(day)]


def test_alerts_and_retention(spark, lake):
    assert jobs.run_all(spark, Lake(lake.root + "/empty"), AS_OF) == "failed"
    late = jobs.now_utc() + timedelta(minutes=5)
    verdicts = {r["alert_name"]: r["status"] for r in jobs.alerts_job(spark, Lake(lake.root + "/empty"), late).collect()}
    assert verdicts["failed_run"] == "firing" and verdicts["no_events"] == "firing" and verdicts["error_rate"] == "resolved"
    jobs.run_all(spark, lake, AS_OF)
    kept = read_table(spark, lake, "data_quality_checks").count()
    assert jobs.retention_job(spark, lake, AS_OF + timedelta(days=6))["data_quality_checks"] == []
    assert read_table(spark, lake, "data_quality_checks").count() == kept > 0
    assert len(jobs.retention_job(spark, lake, AS_OF + timedelta(days=8))["data_quality_checks"]) == 1


def test_stream_and_batch_share_silver(spark, lake):
    schema = read_table(spark, lake, "bronze_clickstream").schema
    raw = spark.readStream.schema(schema).parquet(lake.path("bronze_clickstream"))
    for query in start_silver(raw, lake, "40 days", DRAIN):
        query.awaitTermination()
    streamed = read_table(spark, lake, "silver_clickstream").count()
    written = jobs.silver_job(spark, lake)
    assert written.events == streamed == read_table(spark, lake, "silver_clickstream").count()
    running = start_silver(raw, Lake(lake.root + "3"), "1 hour")
    try:
        with pytest.raises(RuntimeError):
            jobs.silver_job(spark, lake)
    finally:
        stop_all(running)


def test_a_batch_tried_again_writes_nothing_twice(spark, lake):
    raw = read_table(spark, lake, "bronze_clickstream")
    halves = [raw.where("kafka_offset % 2 = 0"), raw.where("kafka_offset % 2 = 1")]
    write = silver_batch(lake, "1 hour")
    write(halves[0], 0)
    for _ in range(2):
        write(halves[1], 1)
    names = ("silver_clickstream", "silver_late", "silver_stream_rejected", "silver_batches")
    silver, late, bad, batches = (read_table(spark, lake, n) for n in names)
    total = batches.agg(F.sum("received"), F.sum("timely"), F.sum("late"), F.sum("rejected")).first()
    assert total[0] == raw.count() == sum(total[1:]) and late.count() == total[2] and bad.count() == total[3]
    assert silver.count() == silver.select("session_id", "event_id").distinct().count() <= total[1]


def test_two_topics(spark, lake):
    root = lake.root.rsplit("/", 1)[0]
    spark.read.parquet(f"{root}/in/clickstream").withColumn("topic", F.lit("transactions")).limit(50).write.parquet(f"{root}/in/transactions")
    other = Lake(lake.root + "4")
    config = StreamConfig(kind="files", directory=f"{root}/in", max_files=1)
    queries = jobs.bronze_job(spark, other, config, trigger=DRAIN)
    for query in queries:
        query.awaitTermination()
    assert sorted(q.name for q in queries) == ["bronze_clickstream", "bronze_transactions"]
    assert read_table(spark, other, "bronze_transactions").count() == 50
    assert read_table(spark, other, "bronze_clickstream").count() == read_table(spark, lake, "bronze_clickstream").count()


def test_run_log_falls_back_to_csv(spark, tmp_path):
    lake = Lake(str(tmp_path))
    (tmp_path / "metrics").mkdir()
    (tmp_path / "metrics/pipeline_runs").write_text("a file where the table should be")
    row = run_row(spark, "p", "r1", AS_OF, AS_OF, "success", 3)
    with pytest.raises(Exception):
        write_run(row, lake)
    write_run(row, lake, csv_fallback=str(tmp_path / "log"))
    assert spark.read.csv(str(tmp_path / "log")).first()[:3] == ("p", "r1", "success")


def test_progress_is_stored_and_let_go(spark, tmp_path):
    lake, recorder = Lake(str(tmp_path)), ProgressRecorder()
    recorder.rows = [("q", k, 10, 5, AS_OF) for k in range(3)]
    assert recorder.store(spark, lake) == 3 and recorder.rows == [] and recorder.store(spark, lake) == 0
    assert read_table(spark, lake, "stream_progress").count() == 3
    assert read_table(spark, lake, "pipeline_metrics").where("metric_name = 'stream.input.rows'").count() == 3


def test_failed_run_is_recorded(spark, tmp_path):
    lake = Lake(str(tmp_path / "none"))
    assert jobs.run_all(spark, lake, AS_OF) == "failed"
    row = read_table(spark, lake, "pipeline_runs").first()
    assert row["status"] == "failed" and row["error_message"]


def test_stream_gold_equals_batch_up_to_the_open_tail(spark, lake):
    jobs.silver_job(spark, lake)
    events = read_table(spark, lake, "silver_clickstream")
    stream = spark.readStream.schema(events.schema).parquet(lake.path("silver_clickstream"))
    start_gold(stream, lake, "30 minutes", DRAIN).awaitTermination()
    closed = rows(read_table(spark, lake, "gold_hourly").select("event_date", "event_hour", "event_type", "device_type", "event_count", "total_value"))
    batch = rows(hourly_stream(events, "event_ts").select("event_date", "event_hour", "event_type", "device_type", "event_count", "total_value"))
    assert set(closed) <= set(batch)
    newest = max(b[:2] for b in batch)
    assert len(batch) - len(closed) <= sum(1 for b in batch if b[0] == newest[0] and b[1] >= newest[1] - 1)


def test_stop_all_stops_running_queries(spark, lake):
    config = StreamConfig(kind="files", directory=lake.root.rsplit("/", 1)[0] + "/in")
    queries = jobs.bronze_job(spark, Lake(lake.root + "2"), config, topics=("clickstream",))
    stop_all([None, *queries])
    assert not any(q.isActive for q in queries)


def test_missing_sources(spark, tmp_path):
    assert latest_report(spark, str(tmp_path / "no")) is None
    with pytest.raises(FileNotFoundError):
        first_readable(spark, [("parquet", str(tmp_path / "no"))])


def test_day_by_day_equals_one_run(spark, tmp_path):
    from rillmark.operators.layers import with_lineage

    raw = with_lineage(messages(spark, D)).drop("ingestion_date", "ingestion_timestamp").withColumn("key", F.lit(None).cast("binary"))
    day = F.when(F.col("kafka_offset") % 3 == 0, "2024-02-01").otherwise("2024-02-02")
    dated = raw.withColumn("ingestion_date", day).withColumn("ingestion_timestamp", F.col("ingestion_date").cast("timestamp"))
    whole, parts = Lake(str(tmp_path / "whole")), Lake(str(tmp_path / "parts"))
    for lake in (whole, parts):
        dated.write.partitionBy("ingestion_date").parquet(lake.path("bronze_clickstream"))
    jobs.silver_job(spark, whole)
    for days in (["2024-02-01"], ["2024-02-02"], ["2024-02-02"]):
        jobs.silver_job(spark, parts, days)
    tables = [read_table(spark, lake, "silver_clickstream").drop("processed_at") for lake in (whole, parts)]
    assert rows(tables[0]) == rows(tables[1].select(*tables[0].columns))
    bad = [read_table(spark, lake, "silver_rejected").count() for lake in (whole, parts)]
    assert bad[0] == bad[1] > 0
    runs = [jobs.quality_job(spark, lake, AS_OF).run_id for lake in (whole, parts)]
    jobs.gold_job(spark, whole, runs[0])
    days = jobs.event_dates(tables[1])
    jobs.gold_job(spark, parts, runs[1], days[:10])
    jobs.gold_job(spark, parts, runs[1], days[10:])
    gold = [rows(read_table(spark, lake, "gold_hourly")) for lake in (whole, parts)]
    assert gold[0] == gold[1]


def test_days_that_stay_the_same_are_not_rewritten(spark, tmp_path):
    """A run over messages that silver holds compares them and keeps the files; a new event or an earlier copy rewrites its day, and copies count once."""
    lake = Lake(str(tmp_path))

    def bring(*sent):
        text = '{{"event_id":"{0}","timestamp":"2024-01-0{1}T0{2}:00:00Z","user_id":"u","session_id":"s{1}","event_type":"page_view","device_type":"mobile","price":{3}}}'
        data = [(text.format(*s[:4]), datetime(2024, 2, 1), s[4], s[5], "2024-02-01") for s in sent]
        raw = spark.createDataFrame(data, "value string, ingestion_timestamp timestamp, kafka_partition int, kafka_offset bigint, ingestion_date string")
        raw.write.mode("append").partitionBy("ingestion_date").parquet(lake.path("bronze_clickstream"))
        return jobs.silver_job(spark, lake)

    def files():
        found = read_table(spark, lake, "silver_clickstream").select("event_date", F.col("_metadata.file_path").alias("file")).distinct().collect()
        return {str(r["event_date"])[-1]: r["file"] for r in found}

    def stored():
        return rows(read_table(spark, lake, "silver_clickstream").select("event_id", F.hour("event_ts"), "price", "kafka_partition", "kafka_offset"))

    first = bring(("a", 1, 1, 1.0, None, 5), ("a", 1, 1, 1.5, None, 7), ("b", 1, 2, 2.0, 0, 6), ("c", 2, 3, 3.0, 0, 8), ("d", 3, 4, 4.0, 1, None))
    before, held = files(), stored()
    assert first.events == len(held) == 4 and ("a", 1, 1.0, None, 5) in held
    again = bring()
    assert again == first and files() == before and stored() == held
    assert bring(("c", 2, 3, 3.5, 0, 9)) == first and files() == before and stored() == held  # a later copy
    earlier = bring(("c", 2, 3, 2.5, 0, 1))
    after = files()
    assert earlier == first and after["2"] != before["2"] and (after["1"], after["3"]) == (before["1"], before["3"])
    assert stored() == sorted([r for r in held if r[0] != "c"] + [("c", 3, 2.5, 0, 1)], key=str)
    more = bring(("e", 3, 5, 5.0, 1, 4))
    assert more.events == 5 and more.days == first.days and files()["3"] != after["3"] and len(stored()) == 5
    # a new event that is sent twice
    last = bring(("b", 1, 2, 2.0, 0, 6), ("x", 1, 1, 6.0, 0, 20), ("x", 1, 1, 6.0, 0, 21))
    assert last.events == 6 and [r[0] for r in stored()] == ["a", "b", "c", "d", "e", "x"]
    # copies that something else stored are put right, as they always were
    read_table(spark, lake, "silver_clickstream").where("event_id = 'x'").write.mode("append").partitionBy("event_date").parquet(lake.path("silver_clickstream"))
    assert len(stored()) == 7
    assert bring().events == 6 and [r[0] for r in stored()] == ["a", "b", "c", "d", "e", "x"]
