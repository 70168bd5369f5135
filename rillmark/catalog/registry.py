"""Name -> query, and name -> equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

AS_OF = datetime(2024, 1, 31)
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def query(sql: str | None = None, ctes: tuple[str, ...] = ()):
    """Register a function under its name, with its SQL where there is one."""

    def add(function):
        name = function.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = (("WITH " + ",\n".join(ctes) + "\n") if ctes else "") + sql.strip()
        return function

    return add
