"""Sessions kept by hand in a stream, funnels in order, histories in any order, episodes: against plain loops."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rillmark.functions import ordered
from rillmark.operators import behaviour as beh
from rillmark.operators import links, mart
from rillmark.operators.history import cut_intervals, merge_changes, version_at, versions
from rillmark.session import scratch_path
from rillmark.sources.streams import read_files_stream
from rillmark.streaming.queries import DRAIN, carts_with_checkouts
from rillmark.streaming.sessions import dropped_rows, rocks_state, sessions_until

T0 = datetime(2024, 1, 1)
EVENT = "user_id string, event_id string, event_type string, event_ts timestamp"


# ---- sessions that end at a purchase --------------------------------------------


def closed_sessions(events, gap, watermark):
    """Sessions whose end the watermark has passed, of events (user, id, type, time)."""
    by, out = defaultdict(list), []
    for e in events:
        if e[0] is not None and e[3] is not None:
            by[e[0]].append(e)
    for user, mine in by.items():
        mine.sort(key=lambda e: (e[3], e[1]))
        current = None
        for _, _, kind, at in [e for e in mine if e[3] <= watermark]:
            if current and at > current[1] + gap:
                out.append((user, *current, "pause"))
                current = None
            current = (current[0], at, current[2] + 1) if current else (at, at, 1)
            if kind == "buy":
                out.append((user, *current, "event"))
                current = None
        if current and watermark >= current[1] + gap:
            out.append((user, *current, "pause"))
    return sorted(out)


def started(spark, root, gap):
    stream = read_files_stream(spark, f"{root}/in/*", spark.createDataFrame([], EVENT).schema, files_per_batch=1)
    out = sessions_until(stream, gap, "buy", watermark="30 minutes")
    with rocks_state(spark):
        query = out.writeStream.format("parquet").option("checkpointLocation", f"{root}/ckpt").option("path", f"{root}/out").trigger(**DRAIN).start()
    query.awaitTermination()
    return query


def test_sessions_in_shuffled_batches_and_a_restart(spark, tmp_path):
    rng = random.Random(3)
    gap = timedelta(minutes=20)
    events = [(f"u{rng.randrange(4)}", str(i), rng.choice(["view", "view", "cart", "buy"]), T0 + timedelta(minutes=rng.randrange(600), microseconds=rng.randrange(3))) for i in range(300)]
    events += [(None, "x", "view", T0), ("u0", "y", "view", None)]
    # arrival: by time with up to 29 minutes of disorder, in batches; equal times in one user too
    events.append(("u1", "0z", "buy", events[0][3]))
    arrival = sorted(events, key=lambda e: (e[3] or T0) + timedelta(minutes=rng.randrange(29)))
    batches = [arrival[i : i + 40] for i in range(0, len(arrival), 40)]
    for k, batch in enumerate(batches):
        spark.createDataFrame(batch, EVENT).coalesce(1).write.parquet(f"{tmp_path}/in/b{k}")
        if k in (2, len(batches) - 1):
            query = started(spark, str(tmp_path), gap)  # the second start goes on from the checkpoint
            newest = max(e[3] for b in batches[: k + 1] for e in b if e[3])
            found = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()))
            assert found == closed_sessions([e for b in batches[: k + 1] for e in b], gap, newest - timedelta(minutes=30))
            assert dropped_rows(query) == 0
    late = [("u0", "late", "view", T0 - timedelta(days=1)), ("u9", "late", "view", T0)]
    spark.createDataFrame(late, EVENT).coalesce(1).write.parquet(f"{tmp_path}/in/late")
    assert dropped_rows(started(spark, str(tmp_path), gap)) == 2
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == found


def test_carts_meet_checkouts(spark, tmp_path):
    """Shuffled batches and a restart give the rows of the batch join; state holds the range, not the history."""
    rng = random.Random(8)
    kind = "session_id string, event_id string, event_type string, event_ts timestamp, product_id string, price double"
    pick = lambda: rng.choice(["add_to_cart", "add_to_cart", "checkout_completed", "page_view"])
    data = [(f"s{rng.randrange(12)}", str(i), pick(), T0 + timedelta(minutes=rng.randrange(3000)), "p", 1.5) for i in range(600)]
    data += [(None, "n", "add_to_cart", T0, "p", 1.0), ("s1", "m", "add_to_cart", None, "p", 1.0)]
    arrival = sorted(data, key=lambda e: (e[3] or T0) + timedelta(minutes=rng.randrange(50)))
    batches = [arrival[a : a + 70] for a in range(0, len(arrival), 70)]
    stream = lambda: read_files_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], kind).schema, files_per_batch=1)
    for k, batch in enumerate(batches):
        spark.createDataFrame(batch, kind).coalesce(1).write.parquet(f"{tmp_path}/in/b{k}")
        if k in (3, len(batches) - 1):
            out = carts_with_checkouts(stream(), stream(), "90 minutes").select("add_id", "checkout_id")
            query = out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/ckpt").option("path", f"{tmp_path}/out").trigger(**DRAIN).start()
            query.awaitTermination()
    adds = [e for e in data if e[0] and e[3] and e[2] == "add_to_cart"]
    done = [e for e in data if e[0] and e[3] and e[2] == "checkout_completed"]
    line = min(max(e[3] for e in adds), max(e[3] for e in done)) - timedelta(hours=1)
    reach = timedelta(minutes=90)
    want = [(a[1], c[1]) for a in adds for c in done if c[0] == a[0] and a[3] <= c[3] <= a[3] + reach]
    met = {a for a, _ in want}
    want += [(a[1], None) for a in adds if a[1] not in met and a[3] + reach < line]
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == sorted(want, key=str)
    kept = sum(int(o["numRowsTotal"]) for o in query.lastProgress["stateOperators"])
    assert kept <= sum(e[3] >= line - 2 * reach for e in adds + done) < 200


# ---- funnel in order --------------------------------------------------------------

STAGES = {"viewed": "view", "carted": "cart", "bought": "buy"}


def reached(events, within):
    at, out = [set() for _ in STAGES], [0] * len(STAGES)
    for t, _, kind in sorted(events):
        for k, stage in enumerate(STAGES.values()):
            if kind == stage and (k == 0 or any(within is None or t - b <= within for b in at[k - 1])):
                at[k].add(t)
                out[k] = 1
                break
    return tuple(out)


@pytest.mark.parametrize("within", [None, timedelta(minutes=7)])
@pytest.mark.parametrize("large", [500_000, 6])
def test_funnel_in_order(spark, monkeypatch, within, large):
    monkeypatch.setattr(ordered, "LARGE_SERIES", large)
    rng = random.Random(large)
    data, by = [], defaultdict(list)
    for i in range(500):
        s, t, kind = f"s{rng.choice([0, 0, 0, rng.randrange(60)])}", T0 + timedelta(minutes=rng.randrange(400)), rng.choice(["view", "cart", "buy", "other", "other"])
        data.append((s, t, f"{i:04}", kind))
        by[s].append((t, f"{i:04}", kind))
    data += [(None, T0, "a", "view"), ("empty", T0, "b", "other"), ("empty", None, "c", "view")]
    by["empty"] = []
    df = spark.createDataFrame(data, "session_id string, timestamp timestamp, event_id string, event_type string").repartition(3)
    found = {r[0]: tuple(r[1:]) for r in beh.funnel_in_order(df, STAGES, within).collect()}
    assert found == {s: reached(events, within) for s, events in by.items()}


def test_cart_view_cart(spark):
    at = [T0 + timedelta(minutes=i) for i in range(5)]
    data = [("a", at[0], "1", "cart"), ("a", at[1], "2", "view"), ("a", at[2], "3", "cart"), ("b", at[0], "4", "cart"), ("b", at[1], "5", "view"), ("c", at[0], "7", "view"), ("c", at[0], "6", "cart")]
    df = spark.createDataFrame(data, "session_id string, timestamp timestamp, event_id string, event_type string")
    assert rows(beh.funnel_in_order(df, STAGES)) == [("a", 1, 1, 0), ("b", 1, 0, 0), ("c", 1, 0, 0)]


# ---- histories ----------------------------------------------------------------------

CHANGE = "customer string, effective_at timestamp, sequence bigint, tier string, city string"


def intervals(changes):
    last = {}
    for c in sorted((c for c in changes if c[0] and c[1]), key=lambda c: (c[0], c[1], c[2], c[3] or "", c[4] or "")):
        last[c[0], c[1]] = c
    out = []
    for c in last.values():
        later = [t for k, t in last if k == c[0] and t > c[1]]
        out.append((*c, min(later, default=None), not later))
    return sorted(out, key=str)


@pytest.mark.parametrize("large", [500_000, 5])
def test_any_arrival_order_gives_one_history(spark, monkeypatch, large):
    monkeypatch.setattr(ordered, "LARGE_SERIES", large)
    rng = random.Random(1)
    changes = [(rng.choice(["hot", "hot", f"c{rng.randrange(9)}"]), T0 + timedelta(hours=6 * rng.randrange(40)), i, rng.choice("ABC"), rng.choice("xy")) for i in range(120)]
    changes += [("c1", T0, 7, "A", "x"), ("c1", T0, 7, "A", "y"), (None, T0, 1, "A", "x"), ("c2", None, 1, "A", "x")]
    want = intervals(changes)
    for seed, sizes in ((0, 124), (1, 31), (2, 50)):
        order = random.Random(seed).sample(changes, len(changes))
        path = scratch_path(spark, "history")
        for a in range(0, len(order), sizes):
            merge_changes(path, spark.createDataFrame(order[a : a + sizes], CHANGE).repartition(3), "customer", ["tier", "city"], buckets=4)
        merge_changes(path, spark.createDataFrame(order[:20], CHANGE), "customer", ["tier", "city"], buckets=4)  # once more
        stored = spark.read.parquet(path).drop("bucket")
        assert rows(stored) == want
    spells = versions(stored, "customer", ["tier"]).collect()
    for key in {c[0] for c in changes if c[0]}:
        mine = sorted((r for r in spells if r["customer"] == key), key=lambda r: r["effective_at"])
        assert all(a["expires_at"] == b["effective_at"] and a["tier"] != b["tier"] for a, b in zip(mine, mine[1:])) and mine[-1]["is_current"]
        states = [w for w in want if w[0] == key]
        assert all(next(r["tier"] for r in reversed(mine) if r["effective_at"] <= w[1]) == w[3] for w in states)
    fact = spark.createDataFrame([(i, rng.choice(["hot", "c1", "none", None]), T0 + timedelta(hours=rng.randrange(-5, 250))) for i in range(60)], "id int, customer string, at timestamp")
    for r in version_at(fact, stored, "customer", "at", ["tier", "city"]).collect():
        held = [w for w in want if w[0] == r["customer"] and w[1] <= r["at"] and (w[5] is None or r["at"] < w[5])]
        assert (r["tier"], r["city"]) == ((held[0][3], held[0][4]) if held else (None, None))


def test_only_touched_buckets_are_rewritten(spark):
    path = scratch_path(spark, "history")
    merge_changes(path, spark.createDataFrame([(f"c{i}", T0, 1, "A", "x") for i in range(40)], CHANGE), "customer", ["tier", "city"], buckets=8)
    files = lambda: {f for f in spark.read.parquet(path).inputFiles()}
    before = files()
    merge_changes(path, spark.createDataFrame([("c3", T0 - timedelta(days=9), 2, "B", "x")], CHANGE), "customer", ["tier", "city"], buckets=8)
    gone = before - files()
    assert gone and len({f.rsplit("/", 2)[1] for f in gone}) == 1
    mine = spark.read.parquet(path).where("customer = 'c3'").orderBy("effective_at").collect()
    assert [(r["tier"], r["expires_at"], r["is_current"]) for r in mine] == [("B", T0, False), ("A", None, True)]
    merge_changes(path, spark.createDataFrame([], CHANGE), "customer", ["tier", "city"], buckets=8)
    assert cut_intervals(spark.createDataFrame([], CHANGE), "customer", ["tier", "city"]).count() == 0


# ---- alerts ----------------------------------------------------------------------------


def test_episodes(spark):
    at = [T0 + timedelta(hours=i) for i in range(12)]
    said = [("a", "firing", 0), ("a", "firing", 1), ("a", "firing", 2), ("a", "resolved", 3), ("a", "resolved", 4), ("a", "firing", 6), ("b", "resolved", 0), ("b", "firing", 5), ("b", "firing", 5), ("c", "resolved", 1)]
    df = spark.createDataFrame([(n, "warning", s, f"m{h}", float(h), 1.0, at[h]) for n, s, h in said], "alert_name string, severity string, status string, message string, actual_value double, threshold_value double, triggered_at timestamp")
    found = rows(mart.alert_episodes(df).select("alert_name", "status", "triggered_at", "last_fired_at", "resolved_at", "evaluations", "message"))
    assert found == [("a", "firing", at[6], at[6], None, 1, "m6"), ("a", "resolved", at[0], at[2], at[3], 3, "m2"), ("b", "firing", at[5], at[5], None, 1, "m5")]
    active = mart.active_alerts(mart.alert_episodes(df), at[8]).collect()
    assert [(r["alert_name"], r["age_seconds"]) for r in active] == [("a", 7200), ("b", 10800)]


def test_gate_of_stored_checks(spark):
    runs = spark.createDataFrame([("r1", "success"), ("r2", "failed"), ("r3", "success")], "run_id string, status string")
    checks = spark.createDataFrame([("r1", "x", "passed"), ("r1", "y", "failed"), ("r2", "x", "passed")], "run_id string, check_name string, status string")
    assert rows(links.attach_gate(runs, checks)) == [("r1", "success", 2, 1, False), ("r2", "failed", 1, 0, True), ("r3", "success", None, None, None)]
    flags = checks.select("run_id", (F.col("status") == "passed").alias("passed"))
    assert rows(links.attach_gate(runs, flags)) == rows(links.attach_gate(runs, checks))
