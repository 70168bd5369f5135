"""Progress of streaming queries as rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from rillmark.schemas import PROGRESS
from rillmark.sinks.mart import write_metrics
from rillmark.sinks.tables import append_rows
from rillmark.sources.tables import Lake


class ProgressRecorder(StreamingQueryListener):
    """Holds one small row per non-empty micro-batch until it is stored, and the names of ended queries."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.ended: list[str] = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        if p.numInputRows > 0:
            at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).replace(tzinfo=None)
            self.rows.append((p.name, p.batchId, p.numInputRows, p.durationMs.get("triggerExecution"), at))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.append(str(event.runId))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), PROGRESS)

    def store(self, spark: SparkSession, lake: Lake) -> int:
        """Append the rows held to the progress table and as metrics, then let go of them; call it now and then."""
        taken = list(self.rows)
        if taken:
            rows = spark.createDataFrame(taken, PROGRESS)
            append_rows(rows, lake.path("stream_progress"))
            write_metrics(progress_metrics(rows), lake, source="streams")
            del self.rows[: len(taken)]
        return len(taken)


def backlog(progress: DataFrame, trigger_ms: int) -> DataFrame:
    """Batches that took as long as the trigger interval or longer: the query falls behind."""
    return progress.where(F.col("trigger_ms") >= trigger_ms).withColumn("over_ms", F.col("trigger_ms") - trigger_ms)


def progress_metrics(progress: DataFrame) -> DataFrame:
    """Progress as metric rows for the mart."""
    pairs = F.array(
        F.struct(F.lit("stream.input.rows").alias("metric_name"), F.col("input_rows").cast("double").alias("metric_value"), F.lit("rows").alias("metric_unit")),
        F.struct(F.lit("stream.batch.duration").alias("metric_name"), F.col("trigger_ms").cast("double").alias("metric_value"), F.lit("ms").alias("metric_unit")),
    )
    tags = F.create_map(F.lit("query"), F.col("query_name"))
    return progress.select(F.inline(pairs), tags.alias("tags"), "recorded_at")
