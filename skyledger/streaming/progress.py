"""Progress of streams as a table: counters, dropped rows and step durations of every micro-batch."""

from __future__ import annotations

import json
import threading
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from skyledger.session import write_small

_SCHEMA = "step string, kind string, metric string, value double"


class ProgressWriter(StreamingQueryListener):
    """Writes the progress of the queries it follows, a small file to a batch, so a repeated batch overwrites its own.

    Spark calls listeners when a batch is done, in a thread of their own. One listener serves a session, as each of them
    gets the events of all queries.
    """

    _of: WeakKeyDictionary[SparkSession, ProgressWriter] = WeakKeyDictionary()

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}  # by the name of the query, which is its own while it runs
        self.runs: dict[str, tuple[str, str]] = {}
        self.ended: dict[str, threading.Event] = {}

    @classmethod
    def of(cls, spark: SparkSession) -> ProgressWriter:
        if spark not in cls._of:
            cls._of[spark] = cls(spark)
            spark.streams.addListener(cls._of[spark])
        return cls._of[spark]

    def follow(self, name: str, path: str) -> None:
        """The next query of this name has its progress under ``path``."""
        self.paths[name] = path

    def wait(self, run: str, seconds: float = 60) -> None:
        """Until the last progress of a run that has ended is written."""
        self.ended[run].wait(seconds)
        self.runs.pop(run, None)
        self.ended.pop(run, None)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - named by Spark
        if event.name in self.paths:
            self.ended[str(event.runId)] = threading.Event()
            self.runs[str(event.runId)] = event.name, self.paths[event.name]

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        if str(progress.runId) not in self.runs:
            return
        name, path = self.runs[str(progress.runId)]
        found = [("duration", f"operator_{k}_ms", v) for k, v in progress.durationMs.items()]
        counted = progress.observedMetrics.get(f"rows_{name}")
        found += [("counter", k, v) for k, v in (counted.asDict() if counted else {}).items()]
        found.append(("dropped", "rows", sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)))
        lines = [json.dumps({"step": name, "kind": k, "metric": m, "value": float(v)}) for k, m, v in found]
        write_small(self.spark, f"{path}/progress/batch-{progress.batchId}.json", "\n".join(lines))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if str(event.runId) in self.ended:
            self.ended[str(event.runId)].set()


def _progress(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).json(f"{path}/progress").where(F.col("kind") == kind)


def step_durations(spark: SparkSession, path: str) -> DataFrame:
    """``step, metric, latency_ms`` of every micro-batch of a stream, ready for ``latency_stats``."""
    return _progress(spark, path, "duration").select("step", "metric", F.col("value").alias("latency_ms"))


def counters(spark: SparkSession, path: str) -> DataFrame:
    """(counter, rows) over all batches of a stream: rows read, and rows rejected by each rule that rejected any."""
    sums = _progress(spark, path, "counter").groupBy(F.col("metric").alias("counter")).agg(
        F.sum("value").cast("long").alias("rows"))
    return sums.where("rows > 0")


def dropped_rows(spark: SparkSession, path: str) -> int:
    """How many rows Spark's state operators have dropped as late. They count what a task has already summed up."""
    return int(_progress(spark, path, "dropped").agg(F.sum("value")).first()[0] or 0)
