"""Kafka-shaped decode / enrich, batch replay and Structured Streaming (§2 L).

The topic stand-in is built by Spark from ``events``: every event becomes a
JSON message with the user-event contract; a few messages are malformed and a
few use the legacy key names, as real topics do.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lakemart.plans import standins as st
from lakemart.plans.registry import query
from lakemart.session import scratch_path, table
from lakemart.streaming import commits, progress
from lakemart.streaming import stream as ss

MALFORMED_EVERY = 97
LEGACY_EVERY = 89


def topic_rows(spark, sf):
    """Kafka-shaped rows (key, value, topic, partition, offset) from events."""
    e = table(spark, sf, "events")
    eid = None
    for k, v in st.EVENT_TYPE_EVENT_ID.items():
        eid = F.when(F.col("event_type") == k, v) if eid is None else eid.when(F.col("event_type") == k, v)
    fields = [F.col("event_id").cast("int").alias("id"),
              F.date_format("ts", "yyyy-MM-dd").alias("date"),
              F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_date")]
    tail = [F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("username")]
    group = (F.col("user_id") % 5 + 1).cast("int")
    modern = F.to_json(F.struct(*fields, eid.alias("event_id"), *tail, group.alias("group_id"),
                                F.col("value")))
    legacy = F.to_json(F.struct(*fields, eid.alias("event"), *tail, group.alias("group"), F.col("value")))
    payload = (F.when(F.col("event_id") % MALFORMED_EVERY == 0, F.lit("{not json"))
               .when(F.col("event_id") % LEGACY_EVERY == 0, legacy).otherwise(modern))
    return e.select(F.col("event_id").cast("string").cast("binary").alias("key"),
                    payload.cast("binary").alias("value"), F.lit("user_events").alias("topic"),
                    (F.col("event_id") % 3).cast("int").alias("partition"),
                    F.col("event_id").alias("offset"))


DECODED_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS key, event_id AS offset,
  CASE WHEN event_id % {MALFORMED_EVERY} <> 0 THEN CAST(event_id AS INTEGER) END AS id,
  CASE WHEN event_id % {MALFORMED_EVERY} <> 0 THEN CAST(ts AS DATE) END AS date,
  CASE WHEN event_id % {MALFORMED_EVERY} <> 0 THEN ts END AS event_date,
  CASE WHEN event_id % {MALFORMED_EVERY} <> 0 THEN
    CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3
                    WHEN 'signup' THEN 4 WHEN 'error' THEN 9 END END AS event_id,
  CASE WHEN event_id % {MALFORMED_EVERY} <> 0 THEN 'user_' || user_id END AS username,
  CASE WHEN event_id % {MALFORMED_EVERY} <> 0 THEN CAST(user_id % 5 + 1 AS INTEGER) END AS group_id,
  CASE WHEN event_id % {MALFORMED_EVERY} <> 0 THEN value END AS value
FROM events"""


def _decoded(spark, sf):
    return ss.decode(topic_rows(spark, sf))


@query("kafka_batch_decode", sql=DECODED_SQL)
def kafka_batch_decode(spark, sf):
    """Kafka rows -> CAST AS STRING -> from_json -> typed columns."""
    return _decoded(spark, sf)


ENRICHED_SQL = f"""
WITH d AS ({DECODED_SQL}),
ev AS ({st.values_sql(st.EVENT_NAMES, 'event_id', 'event_name')}),
gr AS ({st.values_sql(st.GROUP_NAMES, 'group_id', 'group_name')})
SELECT d.key, d.offset, d.id, d.date, d.event_date, d.event_id, ev.event_name, d.username, d.group_id,
  gr.group_name, d.value
FROM d LEFT JOIN ev ON d.event_id = ev.event_id LEFT JOIN gr ON d.group_id = gr.group_id"""


def _dims(spark):
    return (st.code_list(spark, st.EVENT_NAMES, "event_id", "event_name"),
            st.code_list(spark, st.GROUP_NAMES, "group_id", "group_name"))


@query("kafka_batch_enrich", sql=ENRICHED_SQL)
def kafka_batch_enrich(spark, sf):
    """Batch replay of the topic through the same decode + enrich code."""
    ev, gr = _dims(spark)
    return ss.enrich(_decoded(spark, sf), ev, gr)


@query("stream_enrich", sql=ENRICHED_SQL)
def stream_enrich(spark, sf):
    """L1-L7/F11j: Structured Streaming over the topic files, stream-static left
    joins, replay-safe foreachBatch sink, availableNow trigger, checkpoint."""
    src = scratch_path(spark, "topic")
    out = scratch_path(spark, "enriched")
    ckpt = scratch_path(spark, "stream-ckpt")
    rows = topic_rows(spark, sf)
    rows.write.parquet(src)
    stream = (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(src))
    ev, gr = _dims(spark)
    q = ss.start_enrich_stream(spark, stream, ev, gr, out, ckpt)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out).drop("batch_id")


@query("stream_restart", sql=f"""
SELECT e.*, 'user_events' AS topic, CAST(e.offset % 3 AS INTEGER) AS partition FROM ({ENRICHED_SQL}) e""")
def stream_restart(spark, sf):
    """A stream that is stopped, goes on from its checkpoint, and then starts
    over with a fresh one, reading everything again: each message is stored once."""
    src, out = scratch_path(spark, "restart-topic"), scratch_path(spark, "restart-out")
    rows = topic_rows(spark, sf)
    ev, gr = _dims(spark)

    def run(checkpoint):
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(src)
        sink = commits.ledgered_sink(out, lambda b: ss.enrich(ss.decode(b, keep=("topic", "partition")), ev, gr))
        q = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start()
        q.awaitTermination()

    first, fresh = scratch_path(spark, "restart-ckpt"), scratch_path(spark, "restart-ckpt")
    rows.filter("offset % 5 < 2").write.parquet(src)
    run(first)
    rows.filter("offset % 5 = 2").write.mode("append").parquet(src)
    run(first)
    rows.filter("offset % 5 > 2").write.mode("append").parquet(src)
    run(fresh)
    return commits.read_committed(spark, out)


@query("stream_progress", sql=f"""
SELECT 1 AS run, count(*) AS rows, 'terminated' AS state, false AS behind, false AS has_exception FROM events
WHERE event_id % {MALFORMED_EVERY} <> 0
UNION ALL SELECT 2, 0, 'failed', true, true
UNION ALL SELECT 3, count(*), 'terminated', false, false FROM events WHERE event_id % {MALFORMED_EVERY} = 0""")
def stream_progress(spark, sf):
    """A listener's report of three runs of one stream: good messages; malformed
    ones, on which a strict parser ends the query; the same again, parsed leniently."""
    src, out, ckpt = (scratch_path(spark, f"progress-{n}") for n in ("topic", "out", "ckpt"))
    rows = topic_rows(spark, sf)
    bad = F.col("offset") % MALFORMED_EVERY == 0

    def newest(description):
        # one file a trigger: the source's offset is the number of the last file read
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(src).select("path").count()
        return {"logOffset": listed - 1}

    runs = []
    log = progress.ProgressLog(spark, scratch_path(spark, "progress-log"), latest=newest)
    with log:
        for part, mode in ((rows.filter(~bad), "FAILFAST"), (rows.filter(bad), "FAILFAST"), (None, "PERMISSIVE")):
            if part is not None:
                part.hint("rebalance").write.mode("append").parquet(src)
            stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src)
            q = (ss.decode(stream, mode=mode).writeStream.option("checkpointLocation", ckpt)
                 .foreachBatch(ss.idempotent_sink(out)).trigger(availableNow=True).start())
            try:
                q.awaitTermination()
            except StreamingQueryException:
                pass                            # the report says what happened
            log.wait(q.runId)
            runs.append(q.runId)
    report = progress.run_report(log.table())
    number = F.array_position(F.lit(runs), F.col("run_id")).cast("int")
    return report.select(number.alias("run"), "rows", "state", (F.col("lag") > 0).alias("behind"),
                         F.col("exception").isNotNull().alias("has_exception"))
