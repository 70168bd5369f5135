"""Compaction: same rows, files as planned, nothing to do the second time, and safe when it ends half-way."""

import pytest
from pyspark.sql import functions as F

from rillmark.session import scratch_path
from rillmark.sinks import compaction
from rillmark.sinks.compaction import compact_files, finish_compaction, plan_compaction, stage_compaction


@pytest.fixture
def table(spark):
    path = scratch_path(spark, "small")
    rows = spark.range(4000).selectExpr("id", "id % 3 as day", "repeat(string(id), 20) as text", "if(id % 7 = 0, null, id / 3) as v")
    for k in range(5):
        rows.where(F.col("id") % 5 == k).repartition(2).write.mode("append").partitionBy("day").parquet(path)
    spark.range(100_000).selectExpr("id", "sha2(string(id), 512) as text", "id / 3 as v", "1 as day").coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    return path


def state(spark, path):
    rows = spark.read.parquet(path)
    return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("id", "day", "text", "v").cast("decimal(38,0)"))).first()), set(rows.inputFiles())


def test_packed_as_planned(spark, table):
    before, files = state(spark, table)
    sizes = sorted(n for part in compaction.data_files(spark, table).values() for _, n in part)
    target = 4 * sizes[0] + 2000
    packs = plan_compaction(spark, table, target)
    assert all(2 <= len(p.files) <= 4 for p in packs) and {p.folder.rsplit("/", 1)[1] for p in packs} == {"day=0", "day=1", "day=2"}
    assert compact_files(spark, table, target) == packs
    after, left = state(spark, table)
    assert after == before and len(left) == len(files) - sum(len(p.files) - 1 for p in packs)
    large = max((n, f) for part in compaction.data_files(spark, table).values() for f, n in part)[1]
    assert large in {f.replace("file:///", "file:/") for f in files}  # the good one is not rewritten
    assert compact_files(spark, table, 1 << 30) and len(state(spark, table)[1]) == 3
    assert compact_files(spark, table, 1 << 30) == [] and state(spark, table)[0] == before


@pytest.mark.parametrize("done", [0, 1])
def test_ended_half_way(spark, table, done):
    """Staged and not moved, or one file moved and one source gone: the next run ends it; an unstaged run is dropped."""
    before, _ = state(spark, table)
    work = stage_compaction(spark, table, plan_compaction(spark, table, 1 << 30))
    assert state(spark, table)[0] == before  # readers do not see it
    fs, to_path = compaction._fs(spark, table)
    if done:
        first = spark.read.parquet(f"{work}/manifest").where("pack = 1").first()
        made = next(s.getPath() for s in fs.listStatus(to_path(f"{work}/rows/_pack=1")) if s.getPath().getName().startswith("part-"))
        assert fs.rename(made, to_path(f"{first['folder']}/{first['name']}")) and fs.delete(to_path(first["source"]), False)
    assert finish_compaction(spark, table) == 1 and finish_compaction(spark, table) == 0
    assert state(spark, table)[0] == before and len(state(spark, table)[1]) == 3
    spark.range(3).write.parquet(f"{table}/_compaction/lost/rows")
    assert finish_compaction(spark, table) == 0 and not fs.exists(to_path(f"{table}/_compaction/lost"))
    assert state(spark, table)[0] == before
