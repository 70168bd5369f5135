"""Queries of this subpackage and their SQL, by name."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
PACKAGE = Path(__file__).resolve().parent.parent


#: Bytes of a batch that a Python worker gets. Workers keep several copies and run beside the heap of their executor.
BATCH_BYTES = 8 << 20


def with_package(spark: SparkSession) -> SparkSession:
    """Hands this package to Python workers, which need not start in its folder or have it installed, and small batches."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if not any(path.endswith(f"{PACKAGE.name}.zip") for path in context.listFiles):
        archive = os.path.join(tempfile.mkdtemp(prefix="run-"), f"{PACKAGE.name}.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for path in sorted(PACKAGE.rglob("*.py")):
                out.write(path, path.relative_to(PACKAGE.parent))
        context.addPyFile(archive)
    return spark


def query(sql: str | None = None):
    def add(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(with_package(spark), sf_dir)

        run.__name__ = function.__name__
        QUERIES[function.__name__] = run
        if sql:
            SQL[function.__name__] = sql.strip()
        return function

    return add
