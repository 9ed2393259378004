"""Outcome counters of streaming queries, written as rows of a metrics table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

METRICS = "query string, batch_id bigint, name string, value bigint"


def observe_outcomes(rows: DataFrame, name: str, outcome: str, values: tuple[str, ...]) -> DataFrame:
    """Count rows per value of ``outcome`` as they pass; needs no extra job."""
    counts = [F.count_if(F.col(outcome) == v).alias(v) for v in values]
    return rows.observe(name, F.count("*").alias("total"), *counts)


def observe_exits(rows: DataFrame, name: str) -> DataFrame:
    """Count the rows that pass, and those with a ``reason`` among them."""
    return rows.observe(name, F.count("*").alias("total"), F.count("reason").alias("errors"))


def counters(query: StreamingQuery) -> dict[str, dict[str, int]]:
    """Sums of what a query has observed, by observation, over the progress Spark still holds of it."""
    sums: dict[str, dict[str, int]] = {}
    for progress in query.recentProgress:
        for name, row in progress.observedMetrics.items():
            own = sums.setdefault(name, {})
            for key, value in row.asDict().items():
                own[key] = own.get(key, 0) + int(value)
    return sums


# Counters a listener holds before it writes them.
HELD = 500
_LISTENERS: dict[tuple[int, str], "MetricsListener"] = {}


def attach(spark: SparkSession, path: str) -> "MetricsListener":
    """A listener that appends the counters of all queries of this session to the table in ``path``; one for each folder."""
    key = (id(spark._jsparkSession), path)
    if key not in _LISTENERS:
        _LISTENERS[key] = MetricsListener(spark, path)
        spark.streams.addListener(_LISTENERS[key])
    return _LISTENERS[key]


class MetricsListener(StreamingQueryListener):
    """Collects observed counters of the queries that run under ``path``'s folder.

    With a ``path`` it writes them itself, when it holds ``HELD`` of them and when a query ends; else call ``write`` now and then.
    """

    def __init__(self, spark: SparkSession | None = None, path: str | None = None) -> None:
        self.rows: list[tuple[str, int, str, int]] = []
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for source, row in progress.observedMetrics.items():
            for name, value in row.asDict().items():
                self.rows.append((progress.name or str(progress.id), progress.batchId, f"{source}.{name}" if self.path else name, int(value)))
        if self.path and len(self.rows) >= HELD:
            self.write(self.spark, self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.path:
            self.write(self.spark, self.path)

    def write(self, spark: SparkSession, path: str) -> int:
        rows, self.rows = self.rows, []
        if rows:
            spark.createDataFrame(rows, METRICS).coalesce(1).write.mode("append").json(path)
        return len(rows)
