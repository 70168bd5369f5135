import math

import pytest

from rillmark.llm import mixing
from rillmark.llm.mixing import mix_sources


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Shares by weight, capped, the excess shared again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed = {}
    while True:
        rest = share * sum(sizes.values()) - sum(fixed.values())
        free = sum(weight[s] for s in names if s not in fixed)
        over = [s for s in names if s not in fixed and rest * weight[s] / free >= most * sizes[s]]
        if not over:
            return fixed | {s: rest * weight[s] / free for s in names if s not in fixed}
        fixed |= {s: most * sizes[s] for s in over}


def corpus():
    rows, k = [], 0
    for source, n in (("b", 900), ("a", 60), (None, 40), ("é", 200), ("c", 5)):
        for _ in range(n):
            rows.append((k, " ".join(["w"] * (k * 7 % 23)) or None, source))
            k += 1
    return rows


@pytest.mark.parametrize("bucket", [50_000, 40])
def test_targets_and_whole_copies(documents, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rows = corpus()
    found = mix_sources(documents(rows)).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    expected = targets(sizes)
    assert sorted(r["doc_id"] for r in found) == [r[0] for r in rows]
    for source, target in expected.items():
        own = [r for r in found if r["source"] == source]
        assert all(math.isclose(r["target"], target) and r["source_size"] == sizes[source] for r in own)
        assert abs(sum(r["taken"] for r in own) - target) <= 23
    assert all(r["taken"] == r["copies"] * r["size"] and r["taken"] <= 2 * r["size"] for r in found)
    again = mix_sources(documents(rows, partitions=7)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, again), key=str)


def test_expected_copies_are_the_fraction(documents):
    rows = [(k, "a b", "s") for k in range(400)]
    counts = [sum(r["copies"] for r in mix_sources(documents(rows), share=0.5, seed=s).collect()) for s in (1, 2)]
    assert counts == [200, 200]


def test_edges(documents):
    assert mix_sources(documents([])).count() == 0
    rows = [(1, None, None), (1, "a b", None), (1, "a b", None), (None, "c", "s"), (2, "", "s"), (3, " x" * 50_000, "s")]
    found = mix_sources(documents(rows)).collect()
    assert len(found) == 6 and all(r["taken"] == 0 for r in found if r["size"] == 0)
    assert max(r["size"] for r in found) == 50_000
    assert all(r["taken"] == 0 for r in mix_sources(documents([(1, None, "a")])).collect())


def test_rounds_are_dealt_by_source_too(spark, documents, monkeypatch):
    from pyspark.sql import functions as F

    tasks, stored = [], mixing.stored

    def watched(frame, name):
        if name == "mix-round":
            at = frame.select(F.spark_partition_id().alias("p"), "bucket", "source").collect()
            tasks.append(len({r["p"] for r in at}))
            assert len({(r["p"], r["bucket"], r["source"]) for r in at}) == len({(r["bucket"], r["source"]) for r in at})
        return stored(frame, name)

    monkeypatch.setattr(mixing, "stored", watched)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mix_sources(documents([(k, "w " * (k % 7 + 1), f"site{k % 100}") for k in range(300)]), share=0.5).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) == 2 and min(tasks) > 1
