"""Compaction that picks its work: small files of a partition are packed into larger ones, the others stay.

A run writes the packed files and then a manifest below ``_compaction`` in the table, where
readers do not look; the manifest is its commit. Only then are packed files moved in and
their sources deleted, and whatever a lost run left is brought to its end by the next one:
with a manifest it is finished, without one it is dropped. Rows are neither lost nor kept
twice. While files are swapped a reader of that partition may see both, so runs belong
between readers, like any rewrite of a plain table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_BYTES = 256 << 20
#: Files of at least this share of the target are left alone.
GOOD_SHARE = 0.5
WORK = "_compaction"


@dataclass(frozen=True)
class Pack:
    """Files of one folder that become one file."""

    folder: str
    files: tuple[str, ...]


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def data_files(spark: SparkSession, path: str) -> dict[str, list[tuple[str, int]]]:
    """Folder -> (file, bytes) of a table; hidden names are left out. As long as the list that any reader makes."""
    fs, to_path = _fs(spark, path)
    found: dict[str, list[tuple[str, int]]] = {}
    waiting = [to_path(path)]
    while waiting:
        for status in fs.listStatus(waiting.pop()):
            at = status.getPath()
            if at.getName()[0] in "_.":
                continue
            if status.isDirectory():
                waiting.append(at)
            else:
                found.setdefault(at.getParent().toString(), []).append((at.toString(), status.getLen()))
    return found


def plan_compaction(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, good_share: float = GOOD_SHARE) -> list[Pack]:
    """Packs of at least two small files, in order of name, with ``target_bytes`` at most."""
    packs = []
    for folder, files in sorted(data_files(spark, path).items()):
        pack, size = [], 0
        for name, length in [*sorted(f for f in files if f[1] < good_share * target_bytes), (None, target_bytes)]:
            if pack and size + length > target_bytes:
                packs += [Pack(folder, tuple(pack))] if len(pack) > 1 else []
                pack, size = [], 0
            if name:
                pack.append(name)
                size += length
    return packs


def _staged(spark: SparkSession, packs: list[Pack]) -> DataFrame:
    """Rows of all packs with their pack, a task for each; a pack is bounded by the target size."""
    of = spark.createDataFrame([(name, k) for k, p in enumerate(packs) for name in p.files], "_file string, _pack int")
    rows = spark.read.parquet(*[name for p in packs for name in p.files]).withColumn("_file", F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/"))
    return rows.join(F.broadcast(of), "_file").drop("_file").repartition(len(packs), "_pack")  # a row per small file


def compact_files(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, good_share: float = GOOD_SHARE) -> list[Pack]:
    """Pack the small files of the table at ``path``; returns what was packed, nothing if all files are good."""
    finish_compaction(spark, path)
    packs = plan_compaction(spark, path, target_bytes, good_share)
    if packs:
        stage_compaction(spark, path, packs)
        finish_compaction(spark, path)
    return packs


def stage_compaction(spark: SparkSession, path: str, packs: list[Pack]) -> str:
    """Write the packed files and the manifest; the table itself is not touched yet."""
    run = uuid.uuid4().hex[:12]
    work = f"{path}/{WORK}/{run}"
    _staged(spark, packs).write.partitionBy("_pack").parquet(f"{work}/rows")
    listed = [(k, p.folder, f"part-packed-{run}-{k:05}.parquet", name) for k, p in enumerate(packs) for name in p.files]
    spark.createDataFrame(listed, "pack int, folder string, name string, source string").coalesce(1).write.parquet(f"{work}/manifest")
    return work


def finish_compaction(spark: SparkSession, path: str) -> int:
    """Bring runs that were staged to their end and drop those that were not; returns how many were finished."""
    fs, to_path = _fs(spark, path)
    if not fs.exists(to_path(f"{path}/{WORK}")):
        return 0
    finished = 0
    for status in fs.listStatus(to_path(f"{path}/{WORK}")):
        work = status.getPath().toString()
        if fs.exists(to_path(f"{work}/manifest/_SUCCESS")):
            sources: dict[tuple[int, str, str], list[str]] = {}
            for r in spark.read.parquet(f"{work}/manifest").collect():  # a row per small file
                sources.setdefault((r["pack"], r["folder"], r["name"]), []).append(r["source"])
            for (pack, folder, name), files in sources.items():
                goal = to_path(f"{folder}/{name}")
                if not fs.exists(goal):
                    made = [s.getPath() for s in fs.listStatus(to_path(f"{work}/rows/_pack={pack}")) if s.getPath().getName().startswith("part-")]
                    if len(made) != 1 or not fs.rename(made[0], goal):
                        raise RuntimeError(f"cannot move the packed file of {folder} in; its sources stay")
                for source in files:
                    fs.delete(to_path(source), False)
            finished += 1
        fs.delete(to_path(work), True)
    return finished
