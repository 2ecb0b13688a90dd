"""Progress of streaming queries as a table.

Spark reports after every micro-batch how many rows came in, how many each stateful
operator dropped as late or as duplicates, and how much state it holds. The listener
keeps these few numbers per batch and operator, and writes them when the watched queries have ended.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = ("query string, batch_id long, operator int, operator_name string, rows_in long, late long, duplicates long, "
          "state_rows long, watermark string")


class ProgressListener(StreamingQueryListener):
    """Rows of SCHEMA, one per batch and stateful operator (operator -1: a
    batch without any)."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.open: set[str] = set()
        self.idle = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self.idle:
            self.open.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        mark = p.eventTime.get("watermark") if p.eventTime else None
        head = (p.name or str(p.id), int(p.batchId))
        got = [(*head, i, s.operatorName, int(p.numInputRows), int(s.numRowsDroppedByWatermark),
                int(s.customMetrics.get("numDroppedDuplicateRows", 0)), int(s.numRowsTotal), mark)
               for i, s in enumerate(p.stateOperators)]
        with self.idle:
            self.rows += got or [(*head, -1, "", int(p.numInputRows), 0, 0, 0, mark)]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.idle:
            self.open.discard(str(event.runId))
            self.idle.notify_all()

    def wait(self, timeout: float = 60.0) -> None:
        """Until every query that was started has been reported as ended."""
        with self.idle:
            if not self.idle.wait_for(lambda: not self.open, timeout):
                raise TimeoutError(f"no end reported for {sorted(self.open)}")


@contextmanager
def progress_table(spark: SparkSession, path: str) -> Iterator[ProgressListener]:
    """Watch the queries run inside the block and write their progress to
    ``path`` (a few rows per micro-batch) at its end."""
    listener = ProgressListener()
    spark.streams.addListener(listener)
    try:
        yield listener
        listener.wait()
    finally:
        spark.streams.removeListener(listener)
    spark.createDataFrame(listener.rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def totals(spark: SparkSession, path: str) -> DataFrame:
    """rows_in, late and duplicates over all batches, per query."""
    from pyspark.sql import functions as F
    t = spark.read.schema(SCHEMA).parquet(path)
    per_batch = t.groupBy("query", "batch_id").agg(F.max("rows_in").alias("rows_in"), F.sum("late").alias("late"),
                                                   F.sum("duplicates").alias("duplicates"))
    return per_batch.groupBy("query").agg(*[F.sum(c).alias(c) for c in ("rows_in", "late", "duplicates")])
