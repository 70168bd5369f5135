"""What is kept up by additions: gold cells, pending days, alerts of successive runs, daily user sets, quantile sketches."""

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rillmark.catalog.tables import messages, silver
from rillmark.operators import aggregates as agg
from rillmark.operators import audience as aud
from rillmark.operators import links
from rillmark.operators.layers import with_lineage
from rillmark.plans import jobs
from rillmark.session import cut_lineage, scratch_path
from rillmark.sources.streams import StreamConfig, read_files_stream
from rillmark.sources.tables import Lake, read_table
from rillmark.streaming.gold import add_cells, event_cells, hourly_of, start_gold_cells, summed
from rillmark.streaming.queries import DRAIN, start_silver

D = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 1, 31)
T0 = datetime(2024, 1, 1)
EVENT = "event_ts timestamp, event_type string, device_type string, user_id string, price double"


def some_events(seed, n=400, users=60):
    rng = random.Random(seed)
    return [(T0 + timedelta(minutes=rng.randrange(4000)), rng.choice(["a", "b", None]), rng.choice(["x", "y"]), rng.choice([None, f"u{rng.randrange(users)}"]), rng.choice([None, 1.1, 2.35])) for _ in range(n)]


def test_cells_in_batches_equal_one_run(spark):
    path, data = scratch_path(spark, "cells"), some_events(1)
    frames = [spark.createDataFrame(data[a : a + 80], EVENT) for a in range(0, 400, 80)]
    for k, frame in enumerate(frames):
        assert add_cells(path, event_cells(frame), k)
        assert add_cells(path, event_cells(frame), k) == []  # a batch that is tried again
    whole = spark.createDataFrame(data, EVENT)
    assert rows(hourly_of(spark.read.parquet(path))) == rows(hourly_of(event_cells(whole)))
    exact = whole.groupBy(F.to_date("event_ts").alias("event_date"), F.hour("event_ts").alias("event_hour"), "event_type", "device_type").agg(F.countDistinct("user_id").alias("u"))
    assert rows(hourly_of(spark.read.parquet(path)).select("event_date", "event_hour", "event_type", "device_type", "unique_users")) == rows(exact)
    assert add_cells(path, event_cells(spark.createDataFrame([], EVENT)), 9) == []


def test_sketches_of_many_users_are_within_their_bound(spark):
    """Three standard errors of 0.8 %, over cells that are united from many batches."""
    path = scratch_path(spark, "cells")
    for k in range(4):
        users = spark.range(k * 30_000, k * 30_000 + 60_000).selectExpr("timestamp'2024-01-01 01:00:00' event_ts", "'a' event_type", "'x' device_type", "string(id) user_id", "1.0D price")
        add_cells(path, event_cells(users), k)
    cell = hourly_of(spark.read.parquet(path)).first()
    assert cell["event_count"] == 240_000 and abs(cell["unique_users"] / 150_000 - 1) < 3 * 1.04 / 2**7
    day = summed(spark.read.parquet(path), ["event_date"]).select(F.hll_sketch_estimate("users_sketch")).first()[0]
    assert abs(day / 150_000 - 1) < 3 * 1.04 / 2**7


def test_untouched_days_stay_as_they_are(spark):
    path = scratch_path(spark, "cells")
    add_cells(path, event_cells(spark.createDataFrame(some_events(2), EVENT)), 0)
    files = lambda: {f.rsplit("/", 2)[1]: f for f in spark.read.parquet(path).inputFiles()}
    before = files()
    assert add_cells(path, event_cells(spark.createDataFrame([(T0, "a", "x", "u1", 1.0)], EVENT)), 1) == [date(2024, 1, 1)]
    after = files()
    assert {k for k in after if after[k] != before[k]} == {"event_date=2024-01-01"}


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(str(tmp_path / "lake"))


def bring(spark, lake, batch):
    with_lineage(batch).write.mode("append").partitionBy("ingestion_date").parquet(lake.path("bronze_clickstream"))
    raw = read_files_stream(spark, lake.path("bronze_clickstream"), read_table(spark, lake, "bronze_clickstream").schema)
    for query in start_silver(raw, lake, "1 hour", DRAIN):
        query.awaitTermination()


def test_late_events_and_their_copies(spark, lake):
    """Late events reach the cells once: not as copies of stored ones, nor of each other, nor over batches."""
    sent = cut_lineage(messages(spark, D))
    at = F.get_json_object(F.col("value").cast("string"), "$.timestamp").cast("timestamp")
    old, new = F.coalesce(at < "2024-01-10", F.lit(False)), F.coalesce(at >= "2024-01-10", F.lit(True))
    some_old = old & (F.col("offset") % 3 == 0)
    for batch in (sent.where(some_old), sent.where(new), sent.where(old & (F.col("offset") % 2 == 0)), sent.where(old), sent.where(old).unionByName(sent.where(old))):
        bring(spark, lake, batch)
        start_gold_cells(spark, lake, DRAIN).awaitTermination()
    cells = hourly_of(spark.read.parquet(lake.path("gold_cells")))
    good = silver(spark, D).where("cast(event_id as bigint) % 97 <> 0")
    want = good.groupBy("event_date", F.hour("timestamp").alias("event_hour"), "event_type", "device_type").agg(F.count("*").alias("event_count"), F.countDistinct("user_id").alias("unique_users"))
    assert rows(cells.select(want.columns)) == rows(want)


def test_only_pending_days_are_written_to_gold(spark, lake, tmp_path):
    sent = cut_lineage(messages(spark, D))
    at = F.coalesce(F.get_json_object(F.col("value").cast("string"), "$.timestamp").cast("timestamp"), F.lit(T0))
    read = F.lit(datetime(2024, 2, 1))

    def arrive(batch, day):
        rows_ = with_lineage(batch).withColumns({"ingestion_timestamp": read + F.make_dt_interval(days=F.lit(day)), "ingestion_date": F.lit(f"2024-02-{day + 1:02}")})
        rows_.write.mode("append").partitionBy("ingestion_date").parquet(lake.path("bronze_clickstream"))

    last = at >= "2024-01-28"
    arrive(sent.where(~last), 0)
    assert jobs.run_all(spark, lake, AS_OF) == "success" and jobs.pending_days(spark, lake) == []
    files = lambda: {f.rsplit("/", 2)[1]: f for f in read_table(spark, lake, "gold_hourly").inputFiles()}
    before = files()
    arrive(sent.where(last), 1)
    written = jobs.silver_job(spark, lake, ingestion_dates=["2024-02-02"])  # a run that ends before gold
    assert written.days and min(written.days) >= date(2024, 1, 28) and jobs.pending_days(spark, lake) == list(written.days)
    days = jobs.pending_days(spark, lake)
    jobs.gold_job(spark, lake, jobs.quality_job(spark, lake, AS_OF).run_id, days)
    after = files()
    assert {k for k in after if before.get(k) != after[k]} == {f"event_date={day}" for day in days}
    whole = agg.hourly_metrics(jobs.typed_events(spark, lake))
    assert rows(read_table(spark, lake, "gold_hourly").select(whole.columns)) == rows(whole)


def test_alerts_of_successive_runs(spark, lake):
    runs = lambda status, hour: spark.createDataFrame(
        [(f"r{hour}", "lake_refresh", T0 + timedelta(hours=hour, minutes=-20), T0 + timedelta(hours=hour, minutes=-5), status, 900, 10, 0)],
        "run_id string, pipeline_name string, started_at timestamp, completed_at timestamp, status string, duration_seconds bigint, events_processed bigint, events_failed bigint",
    )
    for hour, status in ((10, "failed"), (15, "success")):
        runs(status, hour).write.mode("append").parquet(lake.path("pipeline_runs"))
        jobs.alerts_job(spark, lake, T0 + timedelta(hours=hour))
        names = [(r["alert_name"], r["age_seconds"]) for r in jobs.current_alerts(spark, lake, T0 + timedelta(hours=hour)).collect()]
        assert ("failed_run", 0) in names if hour == 10 else "failed_run" not in dict(names)
    assert names == [("no_events", 5 * 3600)]  # one row, aged from its opening


def test_gate_over_tables_of_the_jobs(spark, lake):
    with_lineage(messages(spark, D)).write.partitionBy("ingestion_date").parquet(lake.path("bronze_clickstream"))
    assert jobs.run_all(spark, lake, AS_OF) == "success"
    met = links.attach_gate(read_table(spark, lake, "pipeline_runs"), read_table(spark, lake, "data_quality_checks")).first()
    checks = read_table(spark, lake, "data_quality_checks")
    assert met["checks"] == checks.count() > 0 and met["failed_checks"] == checks.where("status <> 'passed'").count()


# ---- sets and sketches ---------------------------------------------------------------


def test_sets_of_days(spark):
    rng = random.Random(5)
    data = [(rng.choice([None, *[f"u{i}" for i in range(300)]]), rng.choice([None, *[T0 + timedelta(days=k, hours=rng.randrange(24)) for k in range(12)]])) for _ in range(900)]
    df = spark.createDataFrame(data, "user_id string, timestamp timestamp").repartition(3)
    seen = {}
    for user, at in data:
        if user and at:
            seen.setdefault(user, set()).add(at.date())
    day = lambda k: date(2024, 1, 1) + timedelta(days=k)
    first = cut_lineage(aud.user_numbers(df.where("timestamp >= '2024-01-05'")))
    numbers = cut_lineage(aud.user_numbers(df, first))
    known = {r["user_id"]: r["number"] for r in first.collect()}
    final = {r["user_id"]: r for r in numbers.collect()}
    assert sorted(r["number"] for r in final.values()) == list(range(1, len(seen) + 1)) and all(final[u]["number"] == n for u, n in known.items())
    assert all(final[u]["first_day"] == min(days) for u, days in seen.items())
    sets = cut_lineage(aud.daily_sets(df, numbers))
    for a, b in ((0, 11), (3, 3), (2, 6), (50, 60)):
        want = sum(any(day(a) <= x <= day(b) for x in days) for days in seen.values())
        assert aud.active_between(sets, day(a), day(b)).first()["users"] == want
        assert round(aud.sketched_between(aud.daily_sketches(df), day(a), day(b)).first()["users"]) == want  # few users are exact
    for r in aud.rolling_active(sets, 3).collect():
        assert r["users"] == sum(any(r["day"] - timedelta(days=2) <= x <= r["day"] for x in days) for days in seen.values())
    found = {(r["day"], r["offset"]): (r["cohort_users"], r["users"]) for r in aud.retained(aud.cohort_sets(numbers), sets, [1, 4]).collect()}
    for start in {min(days) for days in seen.values()}:
        cohort = [days for days in seen.values() if min(days) == start]
        assert all(found[start, k] == (len(cohort), sum(start + timedelta(days=k) in days for days in cohort)) for k in (1, 4))


def test_more_users_than_a_bucket(spark):
    numbers = spark.range(1, 100_001).selectExpr("string(id) user_id", "id number", "date'2024-01-01' first_day")
    events = spark.range(1, 100_001).selectExpr("string(id) user_id", "timestamp_ntz'2024-01-02 00:00:00' timestamp").where("user_id % 3 = 0")
    sets = aud.daily_sets(events, numbers)
    assert sets.count() == 4 and aud.united(sets, ["day"]).first()["users"] == 33_333
    assert tuple(aud.retained(aud.cohort_sets(numbers), sets, [1]).first())[2:] == (100_000, 33_333)
    about = aud.sketched_between(aud.daily_sketches(events), date(2024, 1, 1), date(2024, 1, 9)).first()["users"]
    assert abs(about / 33_333 - 1) < 4 / 2**7


@pytest.mark.parametrize("groups", [1, 24])
def test_merged_quantiles(spark, groups):
    df = spark.range(60_000).selectExpr(f"id % {groups} as hour", "case when id % 5 = 0 then 7.0D when id % 11 = 0 then null else rand(3) * 100 end v").cache()
    found = agg.merged_quantiles(agg.quantile_sketches(df, ["hour"], "v"), [], [0.0, 0.01, 0.5, 0.95, 1.0]).collect()
    values = sorted(r["v"] for r in df.where("v is not null").collect())
    for r in found:
        below, upto = sum(v < r["value"] for v in values) / len(values), sum(v <= r["value"] for v in values) / len(values)
        assert below - agg.RANK_ERROR <= r["rank"] <= upto + agg.RANK_ERROR and r["n"] == len(values)
    empty = agg.quantile_sketches(df.where("v < 0"), ["hour"], "v")
    assert agg.merged_quantiles(empty, ["hour"], [0.5]).count() == 0
