"""Kafka-style enrichment shared by batch and Structured Streaming (§2 L).

``decode`` and ``enrich`` are plain DataFrame -> DataFrame functions, so the
same code runs on a batch replay of a topic (L10) and on a ``readStream``
(L1-L6).  The sink is replay-safe: every micro-batch is written under its
``batch_id`` and a re-delivered batch replaces, never duplicates, its rows;
errors propagate so offsets are not committed for a failed batch.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.enrich import bounded

# ---- fixed values: JSON message contract of the user-event topic ----------
EVENT_SCHEMA = ("id INT, date STRING, event_date STRING, event_id INT, "
                "username STRING, group_id INT, value DOUBLE")
LEGACY_KEYS = {"event": "event_id", "group": "group_id"}


def kafka_source_options(servers: str, topic: str, starting: str = "latest",
                         max_offsets_per_trigger: int | None = None,
                         fail_on_data_loss: bool = False) -> dict[str, str]:
    """Options for the Kafka source (the connector jar is external)."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def to_kafka_rows(df: DataFrame, key_col: str, topic: str = "events") -> DataFrame:
    """Shape rows like a Kafka record: binary key/value + topic/partition/offset."""
    payload = F.to_json(F.struct(*[c for c in df.columns]))
    return df.select(F.col(key_col).cast("string").cast("binary").alias("key"),
                     payload.cast("binary").alias("value"),
                     F.lit(topic).alias("topic"), F.lit(0).alias("partition"),
                     F.col(key_col).cast("bigint").alias("offset"))


def decode(kafka: DataFrame, schema: str = EVENT_SCHEMA, mode: str = "PERMISSIVE", keep: tuple[str, ...] = ()) -> DataFrame:
    """CAST(value AS STRING) -> from_json -> typed columns.

    Malformed JSON gives an all-NULL struct (PERMISSIVE) or ends the query
    (``mode="FAILFAST"``); legacy key names (``event``/``group``) are accepted as
    fallbacks for ``event_id``/``group_id``.  ``keep``: further record columns
    to pass on (topic, partition).
    """
    legacy = schema + ", event INT, `group` INT"
    raw = kafka.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS json",
                           "topic", "partition", "offset")
    data = raw.withColumn("data", F.from_json("json", legacy, {"mode": mode}))
    return data.select(
        "key", "offset", *keep,
        F.col("data.id").alias("id"),
        F.col("data.date").try_cast("date").alias("date"),
        F.col("data.event_date").try_cast("timestamp_ntz").alias("event_date"),
        F.coalesce("data.event_id", "data.event").alias("event_id"),
        F.col("data.username").alias("username"),
        F.coalesce("data.group_id", "data.group").alias("group_id"),
        F.col("data.value").alias("value"),
    )


def enrich(events: DataFrame, event_dim: DataFrame, group_dim: DataFrame) -> DataFrame:
    """L4/F11j: two left stream-static joins, each id and its name side by side.

    The dimensions are the caller's tables, broadcast behind a check of their size.
    """
    named = ["key", "offset", "id", "date", "event_date", "event_id", "event_name", "username", "group_id", "group_name", "value"]
    return (events.join(bounded(event_dim), "event_id", "left").join(bounded(group_dim), "group_id", "left")
            .select(*named, *[c for c in events.columns if c not in named]))


def idempotent_sink(target_root: str):
    """A ``foreachBatch`` writer keyed by ``batch_id``.

    Each batch lands in ``{target}/batch_id=<n>`` with overwrite, so a replay
    after a failure rewrites the same folder (exactly-once effect).  Errors
    are not swallowed: the query fails and the batch is retried from its
    committed offsets.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(target_root, f"batch_id={batch_id}"))
    return write


def jdbc_batch_sink(url: str, table: str, properties: dict[str, str]):
    """L5 (JDBC flavour): append a batch with its id.  A replayed batch is appended
    again: its readers keep one copy of each batch id, or use ``idempotent_sink``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append")
         .jdbc(url, table, properties=properties))
    return write


def start_enrich_stream(spark: SparkSession, source: DataFrame, event_dim: DataFrame,
                        group_dim: DataFrame, target_root: str, checkpoint: str,
                        trigger: dict | None = None):
    """Append-mode enrichment stream with a checkpoint and a trigger."""
    out = enrich(decode(source), event_dim, group_dim)
    w = (out.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(idempotent_sink(target_root)))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def quick_status(query) -> dict:
    """Batch id, input rows, total rows so far, processed rate of the last batch."""
    progress = query.recentProgress
    total = sum(p.get("numInputRows", 0) for p in (x if isinstance(x, dict) else x.jsonValue()
                                                   for x in progress)) if progress else 0
    last = query.lastProgress
    last = last if isinstance(last, dict) or last is None else last.jsonValue()
    if not last:
        return {"batch_id": None, "rows": 0, "total_rows": total, "rate": 0.0}
    return {"batch_id": last.get("batchId"), "rows": last.get("numInputRows"),
            "total_rows": total, "rate": last.get("processedRowsPerSecond")}


def progress_table(spark: SparkSession, query) -> DataFrame:
    """Every recent progress report as rows (durations, lag, sink)."""
    rows = []
    for p in query.recentProgress:
        p = p if isinstance(p, dict) else p.jsonValue()
        d = p.get("durationMs", {})
        rows.append((p.get("batchId"), p.get("numInputRows"), float(p.get("inputRowsPerSecond") or 0.0),
                     float(p.get("processedRowsPerSecond") or 0.0), d.get("triggerExecution"),
                     d.get("addBatch"), str(p.get("sources", [{}])[0].get("endOffset"))))
    return spark.createDataFrame(rows, "batch_id bigint, rows bigint, input_rate double, "
                                       "processed_rate double, trigger_ms bigint, add_batch_ms bigint, "
                                       "end_offset string")
