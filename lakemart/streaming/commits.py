"""A replay-safe sink for ``foreachBatch``.

A batch is stored under its query and batch id and counts once its ledger row
is written.  What can go wrong, and what then happens:

* the batch is delivered again (failure before its offsets are committed): its
  folder and its ledger row are overwritten with the same rows;
* the query starts over with a fresh checkpoint: Spark gives it a new id, so the
  old batches are left alone, and rows that they hold already — same topic,
  partition and offset — are not stored again;
* a batch fails between its data and its ledger row: readers don't see it.

The ledger keeps the range of offsets of each batch and partition, so a batch is
compared with those earlier batches only whose ranges it overlaps: none as long
as a stream runs on from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

IDENTITY = ("topic", "partition", "offset")
LEDGER = "query_id string, batch_id bigint, topic string, `partition` int, low bigint, high bigint, rows bigint"


def query_id(batch: DataFrame, default: str = "stream") -> str:
    """The id of the streaming query that delivers ``batch`` (kept in its checkpoint)."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or default


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """Committed batches with their offset ranges; empty before the first."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{root}/ledger/*/*")
    except PySparkException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def _folders(root: str, batches: list[tuple[str, int]]) -> list[str]:
    return [f"{root}/data/query={q}/batch={b}" for q, b in batches]


def ledgered_sink(root: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                  identity: tuple[str, str, str] = IDENTITY) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer to ``root``; ``transform`` runs on the new rows of
    each batch and must keep the ``identity`` columns (topic, partition, offset)."""
    topic, partition, offset = identity

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, query = batch.sparkSession, query_id(batch)
        batch = batch.persist()
        try:
            ranges = batch.groupBy(F.col(topic).alias("topic"), F.col(partition).cast("int").alias("partition")).agg(
                F.min(offset).alias("low"), F.max(offset).alias("high"), F.count(F.lit(1)).alias("rows"))
            ranges = ranges.select(F.lit(query).alias("query_id"), F.lit(batch_id).cast("long").alias("batch_id"), "topic",
                                   "partition", F.col("low").cast("long").alias("low"), F.col("high").cast("long").alias("high"), "rows")
            a, b = ranges.alias("a"), read_ledger(spark, root).alias("b")
            met = a.join(b, F.expr("a.topic <=> b.topic AND a.`partition` <=> b.`partition` AND a.low <= b.high AND b.low <= a.high"
                                   " AND NOT (a.query_id = b.query_id AND a.batch_id = b.batch_id)"))
            earlier = [(r.query_id, r.batch_id) for r in met.select("b.query_id", "b.batch_id").distinct().collect()]
            new = batch
            if earlier:
                stored = spark.read.parquet(*_folders(root, earlier)).select(*identity).alias("s")
                same = [F.col(f"n.{c}").eqNullSafe(F.col(f"s.{c}")) for c in identity]
                new = batch.alias("n").join(stored, same, "left_anti")
            out = transform(new) if transform else new
            out.write.mode("overwrite").parquet(f"{root}/data/query={query}/batch={batch_id}")
            ranges.coalesce(1).write.mode("overwrite").parquet(f"{root}/ledger/query={query}/batch={batch_id}")
        finally:
            batch.unpersist()

    return write


def read_committed(spark: SparkSession, root: str) -> DataFrame:
    """All rows of committed batches, each message once."""
    done = [(r.query_id, r.batch_id) for r in read_ledger(spark, root).select("query_id", "batch_id").distinct().collect()]
    if not done:
        raise ValueError(f"no batch is committed below {root}")
    return spark.read.parquet(*_folders(root, sorted(done)))
