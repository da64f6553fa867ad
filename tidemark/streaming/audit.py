"""A plain audit of micro-batches: one row each, written by a listener from the queries' progress."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.streaming.tables import found_or_none, write_line

_ROWS = (
    "query_id string, query_name string, batch_id long, started_at timestamp, ended_at timestamp, source string, sink string, "
    "input_rows long, metrics map<string, map<string, string>>"
)


class WriteAudit(StreamingQueryListener):
    """Rows about the micro-batches of all queries of a session that read something, below ``path``.

    A row is known by query and batch, so a replayed batch replaces its row. Progress is reported after a batch
    has been committed, and on another thread: what a query wrote last may be missing here for a moment (see
    :meth:`wait_for`), or for good if the driver dies in between. Nothing depends on it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def __enter__(self) -> "WriteAudit":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if not progress.numInputRows:
            return
        # Spark gives the start; the end is that and how long the trigger took.
        started = progress.timestamp
        row = {
            "query_id": str(progress.id),
            "query_name": progress.name,
            "batch_id": progress.batchId,
            "started_at": started,
            "millis": dict(progress.durationMs).get("triggerExecution", 0),
            "source": "; ".join(s.description for s in progress.sources),
            "sink": progress.sink.description,
            "input_rows": progress.numInputRows,
            "metrics": {name: {k: str(v) for k, v in row.asDict().items()} for name, row in progress.observedMetrics.items()},
        }
        write_line(self.spark, f"{self.path}/{progress.id}/{progress.batchId}", row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def rows(self) -> DataFrame | None:
        """One row per audited micro-batch; None before the first."""
        fields = _ROWS.replace("ended_at timestamp", "millis long")
        found = found_or_none(lambda: self.spark.read.schema(fields).json(f"{self.path}/*/*"))
        if found is None:
            return None
        ended = F.timestamp_micros(F.unix_micros("started_at") + F.col("millis") * 1000)
        return found.withColumn("ended_at", ended).drop("millis")

    def wait_for(self, query: StreamingQuery, seconds: float = 60.0) -> DataFrame:
        """The rows of ``query``, once its last batch is among them."""
        numbers = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
        end = time.monotonic() + seconds
        while True:
            found = self.rows()
            mine = found.where(F.col("query_id") == str(query.id)) if found is not None else None
            if not numbers or (mine is not None and mine.where(F.col("batch_id") == max(numbers)).take(1)):
                return mine
            if time.monotonic() > end:
                raise TimeoutError(f"no audit row of batch {max(numbers)} of query {query.id}")
            time.sleep(0.2)
