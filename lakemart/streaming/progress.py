"""Full progress report of streaming queries.

``ProgressLog`` is a ``StreamingQueryListener``: every start, progress, idle and
termination becomes a row of a table — durations, rates, rows, the offsets of
each source with its lag, and for a failed query the error class and its text.
Rows are appended in groups, so a long-running query leaves few files.
"""

from __future__ import annotations

import datetime as _dt
import json
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_SCHEMA = (
    "query_id string, run_id string, name string, event string, at timestamp, batch_id bigint, rows bigint, "
    "input_rate double, processed_rate double, trigger_ms bigint, add_batch_ms bigint, planning_ms bigint, "
    "wal_ms bigint, commit_ms bigint, "
    "sources array<struct<description: string, start_offset: string, end_offset: string, latest_offset: string, lag: bigint>>, "
    "lag bigint, error_class string, exception string")

#: gives the latest offset of a source that doesn't report it: description -> offset (parsed JSON), or None
Latest = Callable[[str], object]


def _numbers(offset: object, path: tuple = ()) -> dict[tuple, int]:
    """All whole numbers of an offset by their place: {("topic", "0"): 17}."""
    if isinstance(offset, str):
        try:
            offset = json.loads(offset)
        except ValueError:
            return {}
    if isinstance(offset, dict):
        return {k: n for key, value in offset.items() for k, n in _numbers(value, (*path, key)).items()}
    if isinstance(offset, list):
        return {k: n for key, value in enumerate(offset) for k, n in _numbers(value, (*path, key)).items()}
    return {path: offset} if isinstance(offset, int) and not isinstance(offset, bool) else {}


def source_lag(latest: object, end: object) -> int | None:
    """Offsets between ``end`` and ``latest``, added up over topics and partitions.

    A partition that ``end`` doesn't name hasn't been read: it counts from -1 (or
    0 where offsets name the next record, as Kafka's do: both lie within one).
    None if the latest offset is unknown.
    """
    newest, read = _numbers(latest), _numbers(end)
    if not newest:
        return None
    return sum(max(0, n - read.get(place, -1 if not read else 0)) for place, n in newest.items())


def _offset(value: object) -> str | None:
    return None if value is None else value if isinstance(value, str) else json.dumps(value)


class ProgressLog(StreamingQueryListener):
    """Writes the events of all queries of a session to the table at ``path``."""

    def __init__(self, spark: SparkSession, path: str, latest: Latest | None = None, flush_every: int = 100):
        self.spark, self.path, self.latest, self.flush_every = spark, path, latest, flush_every
        self.rows: list[tuple] = []
        self.ended: set[str] = set()
        self.known: dict[str, list[dict]] = {}      # query id -> sources of its last progress
        self.names: dict[str, str | None] = {}
        self.lock = threading.Lock()

    # ---- events ---------------------------------------------------------------
    def _add(self, query_id, run_id, event: str, sources=None, **values) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        found = []
        for s in sources or []:
            latest = s.get("latestOffset")
            if latest is None and self.latest is not None:
                latest = self.latest(s.get("description", ""))
            found.append((s.get("description"), _offset(s.get("startOffset")), _offset(s.get("endOffset")), _offset(latest),
                          source_lag(latest, s.get("endOffset"))))
        lags = [f[-1] for f in found if f[-1] is not None]
        get = values.get
        row = (str(query_id), str(run_id), self.names.get(str(query_id)), event, now, get("batch_id"), get("rows"),
               get("input_rate"), get("processed_rate"), *(get("durations", {}).get(k) for k in (
                   "triggerExecution", "addBatch", "queryPlanning", "walCommit", "commitOffsets")),
               found, sum(lags) if lags else None, get("error_class"), get("exception"))
        with self.lock:
            self.rows.append(row)
            full = len(self.rows) >= self.flush_every
        if full:
            self.flush()

    def onQueryStarted(self, event) -> None:
        self.names[str(event.id)] = event.name
        self._add(event.id, event.runId, "start")

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        self.known[p["id"]] = p.get("sources", [])
        self._add(p["id"], p["runId"], "progress", p.get("sources"), batch_id=p.get("batchId"), rows=p.get("numInputRows"),
                  input_rate=float(p.get("inputRowsPerSecond") or 0), processed_rate=float(p.get("processedRowsPerSecond") or 0),
                  durations=p.get("durationMs") or {})

    def onQueryIdle(self, event) -> None:
        self._add(event.id, event.runId, "idle", self.known.get(str(event.id)))

    def onQueryTerminated(self, event) -> None:
        self._add(event.id, event.runId, "failed" if event.exception else "terminated", self.known.get(str(event.id)),
                  error_class=event.errorClassOnException, exception=event.exception)
        self.ended.add(str(event.runId))

    # ---- table ----------------------------------------------------------------
    def flush(self) -> None:
        """Append the events so far to the table."""
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def wait(self, run_id: str, seconds: float = 30) -> None:
        """Until the termination of a run has been seen (events come later than the query's end)."""
        limit = time.monotonic() + seconds
        while str(run_id) not in self.ended:
            if time.monotonic() > limit:
                raise TimeoutError(f"no termination event of run {run_id}")
            time.sleep(0.05)

    def table(self) -> DataFrame:
        """All events, written ones and those still held."""
        self.flush()
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.streams.removeListener(self)
        self.flush()


def run_report(events: DataFrame) -> DataFrame:
    """One row per run: batches, rows, longest trigger, last lag, how it ended and why."""
    from pyspark.sql import functions as F
    last = F.max_by("lag", F.when(F.col("lag").isNotNull(), F.col("at")))
    ended = F.col("event").isin("failed", "terminated")
    return events.groupBy("query_id", "run_id").agg(
        F.max("name").alias("name"), F.min("at").alias("started_at"),
        F.count_if(F.col("event") == "progress").alias("batches"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.max("trigger_ms").alias("longest_trigger_ms"), last.alias("lag"),
        F.coalesce(F.max(F.when(ended, F.col("event"))), F.lit("running")).alias("state"),
        F.max("error_class").alias("error_class"), F.max("exception").alias("exception"))
