"""What running streams took in, refused, emitted and raised, micro-batch by micro-batch.

The counts are observed on the stream's own plan, so they cost no further pass. Spark
hands them to a listener after each micro-batch, which puts them down as one small
file; a replayed micro-batch has its file already. The table is summed up like any other.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener, StreamingQueryProgress

from tallyline.session import path_exists, write_whole
from tallyline.sources.events import REJECT

INTAKE, EMITS = "intake", "emits"
COUNTS = ("rows_processed", "rows_rejected", "windows_emitted", "anomalies_detected", "rows_late")
SHAPE = "query_id string, batch_id long, at string, " + ", ".join(f"{c} long" for c in COUNTS)


def observed_intake(parsed: DataFrame) -> DataFrame:
    """The parsed messages; good and refused ones are counted as they pass."""
    refused = F.count_if(F.col(REJECT).isNotNull())
    return parsed.observe(INTAKE, F.count(F.lit(1)).alias("rows_processed"), refused.alias("rows_rejected"))


def observed_emits(emits: DataFrame, minima: dict[str, int]) -> DataFrame:
    """The emitted windows; all, and those that raise an alert, are counted as they pass."""
    raised = F.count_if(F.col("event_count") >= min(minima.values()))
    return emits.observe(EMITS, F.count(F.lit(1)).alias("windows_emitted"), raised.alias("anomalies_detected"))


class StreamSummary(StreamingQueryListener):
    """Keeps the counts of every query of the session that is observed, below one folder.

    ``spark.streams.addListener(summary)`` starts it. The listener hears of a micro-batch
    a little after its end; :meth:`settle` adds what it has not heard of yet once a query
    has ended.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.note(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def note(self, progress: StreamingQueryProgress) -> None:
        """Put down one micro-batch, once."""
        seen = progress.observedMetrics
        if not seen:
            return
        counts = dict.fromkeys(COUNTS, 0)
        for row in seen.values():
            counts |= {name: int(value or 0) for name, value in row.asDict().items() if name in counts}
        counts["rows_late"] = sum(int(step.numRowsDroppedByWatermark) for step in progress.stateOperators)
        line = {"query_id": str(progress.id), "batch_id": progress.batchId, "at": progress.timestamp, **counts}
        try:
            write_whole(self.spark, f"{self.path}/{progress.id}-{progress.batchId:012d}.json", json.dumps(line))
        except FileExistsError:
            pass

    def settle(self, query: StreamingQuery) -> None:
        """Put down the micro-batches of a query that are not there yet, as far as Spark still holds them."""
        for progress in query.recentProgress:
            self.note(progress)

    def batches(self) -> DataFrame:
        """A row per query and micro-batch."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SHAPE)
        return self.spark.read.schema(SHAPE).json(self.path)

    def totals(self) -> DataFrame:
        """One row over all that was put down."""
        return self.batches().agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in COUNTS))
