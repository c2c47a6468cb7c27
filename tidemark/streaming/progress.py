"""Progress of stream ingestion: counters on the driver, and a table that outlives it."""

from __future__ import annotations

import json
import uuid
from base64 import b64encode
from collections.abc import Mapping
from datetime import UTC, datetime
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark import files
from tidemark.commits import CommitLog
from tidemark.functions.times import as_utc

_PROGRESS = "batch_id long, duration_ms long, input_rows long, input_rate double, processed_rate double"
_COUNTS = "batch_id long, n_read long, n_stored long, n_deadletter long, latest_message timestamp"


class IngestMetrics:
    """Counters of the micro-batches of one query, on the driver: exact totals over all of
    them, and the rows of the last `keep`."""

    def __init__(self, keep: int = 1_000) -> None:
        self._keep = keep
        self._rows: dict[int, dict] = {}
        # What has left the rows: its counters added up, and the last batch among it.
        self._gone: dict[str, int] = {}
        self._gone_to = -1

    def add(self, batch_id: int, values: dict) -> None:
        """A batch that is replayed counts once."""
        if batch_id <= self._gone_to:
            return
        self._rows[batch_id] = values
        while len(self._rows) > self._keep:
            self._gone_to = min(self._rows)
            for counter, value in self._rows.pop(self._gone_to).items():
                if isinstance(value, int):
                    self._gone[counter] = self._gone.get(counter, 0) + value

    def total(self, counter: str) -> int:
        return self._gone.get(counter, 0) + sum(v[counter] for v in self._rows.values())

    def frame(self, spark: SparkSession) -> DataFrame:
        names = ["n_read", "n_stored", "n_deadletter", "latest_message"]
        rows = [(i, *[v.get(n) for n in names]) for i, v in sorted(self._rows.items())]
        return spark.createDataFrame(rows, _COUNTS)


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Recent micro-batches of a query: duration, rows, input and processing rate."""
    rows = [
        (
            int(p["batchId"]),
            int(p["durationMs"].get("triggerExecution", 0)),
            int(p["numInputRows"]),
            float(p["inputRowsPerSecond"] or 0.0),
            float(p["processedRowsPerSecond"] or 0.0),
        )
        for p in query.recentProgress
    ]
    return spark.createDataFrame(rows, _PROGRESS)


# A batch's counters, its lag and what Spark says of it.
_STORED = (
    "run string, batch_id long, n_read long, n_stored long, n_deadletter long, latest_message timestamp_ntz, "
    "lag_n long, lag_min long, lag_max long, lag_sketch string, recorded timestamp_ntz"
)
_REPORTED = "run string, batch_id long, duration_ms long, input_rows long, input_rate double, processed_rate double, sources string"


class ProgressTable:
    """One row per micro-batch of every query that records here, in a folder.

    A batch is a small file named by query and batch number, so a batch that is replayed, on this
    or on another driver, replaces its row. `fold` moves finished batches to Parquet, in one commit.
    The run is Spark's id of the query, which its checkpoint keeps over restarts.
    """

    def __init__(self, spark: SparkSession, path: str, *, fold_after: int = 1_000) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.fold_after = fold_after
        self._log = CommitLog(spark, f"{self.path}/_commits", self.path)

    # ---------------------------------------------------------------- writing

    def record(self, run: str, batch_id: int, values: Mapping) -> None:
        """The counters of a batch."""
        row = {**values, "run": run, "batch_id": batch_id, "recorded": datetime.now(UTC)}
        self._put("counted", run, batch_id, row)
        if batch_id and batch_id % self.fold_after == 0:
            self.fold()

    def report(self, run: str, batch_id: int, values: Mapping) -> None:
        """What Spark reports of a batch. Later reports of it, with no input, do not replace it."""
        name = self._name("reported", run, batch_id)
        if values.get("input_rows") or not files.exists(self.spark, name):
            self._put("reported", run, batch_id, {**values, "run": run, "batch_id": batch_id})

    def _name(self, kind: str, run: str, batch_id: int) -> str:
        return f"{self.path}/{kind}/{quote(run, safe='')}/{batch_id:015d}.json"

    def _put(self, kind: str, run: str, batch_id: int, row: Mapping) -> None:
        files.write_text(self.spark, self._name(kind, run, batch_id), json.dumps({k: _plain(v) for k, v in row.items()}))

    def fold(self) -> None:
        """Put all recorded batches but the last of each run into one Parquet folder. A batch below
        the last one is finished: it is not replayed."""
        state = self._state()
        upto = {}
        for run, batches in self._open(state).items():
            if len(batches) > 1:
                upto[run] = batches[-2]
        if not upto:
            return
        folder = f"folded/{uuid.uuid4().hex}"
        done = self._within(self._rows(state), upto)
        done.repartition(1).write.parquet(f"{self.path}/{folder}")

        def swap(now: dict | None) -> dict | None:
            if (now or {"folder": None})["folder"] != state["folder"]:
                return None
            return {"folder": folder, "before": state["folder"], "upto": {**state["upto"], **upto}}

        if not self._log.commit(swap):
            files.remove(self.spark, f"{self.path}/{folder}")
            return
        # What the fold before this one covers: a reader of the state until now needs it no more.
        if state.get("before"):
            files.remove(self.spark, f"{self.path}/{state['before']}")
        for run, last in state["upto"].items():
            for name in files.names_in(self.spark, f"{self.path}/counted/{quote(run, safe='')}"):
                if int(name.removesuffix(".json")) <= last:
                    files.remove(self.spark, self._name("counted", run, int(name.removesuffix(".json"))))

    # ---------------------------------------------------------------- reading

    def _state(self) -> dict:
        return self._log.read()[2] or {"folder": None, "upto": {}}

    def _open(self, state: dict) -> dict[str, list[int]]:
        """Runs and their batches that are not folded yet, ascending."""
        found = {}
        for name in files.names_in(self.spark, f"{self.path}/counted"):
            run = unquote(name)
            batches = [int(n.removesuffix(".json")) for n in files.names_in(self.spark, f"{self.path}/counted/{name}")]
            found[run] = sorted(b for b in batches if b > state["upto"].get(run, -1))
        return found

    @staticmethod
    def _within(rows: DataFrame, upto: Mapping[str, int]) -> DataFrame:
        last = F.create_map(*[F.lit(x) for pair in upto.items() for x in pair])[F.col("run")]
        return rows.filter(F.col("batch_id") <= last)

    def _rows(self, state: dict) -> DataFrame:
        rows = None
        if any(self._open(state).values()):
            rows = self.spark.read.schema(_STORED).json(f"{self.path}/counted", recursiveFileLookup=True)
            if state["upto"]:
                last = F.create_map(*[F.lit(x) for pair in state["upto"].items() for x in pair])[F.col("run")]
                rows = rows.filter(F.coalesce(F.col("batch_id") > last, F.lit(True)))
        if state["folder"]:
            folded = self.spark.read.parquet(f"{self.path}/{state['folder']}")
            rows = folded if rows is None else rows.unionByName(folded)
        return self.spark.createDataFrame([], _STORED) if rows is None else rows

    def batches(self) -> DataFrame:
        """All batches of all runs: counters, the latest message and the lag sketch."""
        return self._rows(self._state()).withColumn("lag_sketch", F.unbase64("lag_sketch"))

    def reports(self) -> DataFrame:
        """Duration, rows, rates and source offsets of all batches, as Spark reported them."""
        if not files.names_in(self.spark, f"{self.path}/reported"):
            return self.spark.createDataFrame([], _REPORTED)
        return self.spark.read.schema(_REPORTED).json(f"{self.path}/reported", recursiveFileLookup=True)

    def totals(self) -> DataFrame:
        """One row per run: its number of batches and its counters added up."""
        sums = [F.sum(c).alias(c) for c in ("n_read", "n_stored", "n_deadletter")]
        latest = F.max("latest_message").alias("latest_message")
        return self.batches().groupBy("run").agg(F.count("*").alias("n_batches"), *sums, latest)


def _plain(value):
    if isinstance(value, datetime):
        return as_utc(value).isoformat(sep="T")
    if isinstance(value, (bytes, bytearray)):
        return b64encode(value).decode()
    return value


class ProgressListener(StreamingQueryListener):
    """Writes what Spark reports of the queries it hears of into a `ProgressTable`. Add it with
    `spark.streams.addListener`; `runs` limits it to some queries."""

    def __init__(self, table: ProgressTable, runs: set[str] | None = None) -> None:
        self.table = table
        self.runs = runs

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        run = str(progress.id)
        if self.runs is not None and run not in self.runs:
            return
        values = {
            "duration_ms": int(progress.durationMs.get("triggerExecution", 0)),
            "input_rows": int(progress.numInputRows),
            "input_rate": _finite(progress.inputRowsPerSecond),
            "processed_rate": _finite(progress.processedRowsPerSecond),
            "sources": json.dumps([json.loads(s.json) for s in progress.sources]),
        }
        self.table.report(run, int(progress.batchId), values)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _finite(rate: float | None) -> float:
    return rate if rate is not None and rate == rate and abs(rate) != float("inf") else 0.0
