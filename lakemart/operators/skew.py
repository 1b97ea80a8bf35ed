"""Joins on a key that may hold a third of all rows.

A shuffle join sends a hot key's rows to one task; AQE splits such a partition
only where the join's own shuffle made it.  ``skew_left_join`` looks for the
heavy keys first, with one mergeable top-k sketch (map-side combined, bounded
whatever the number of keys), and joins their rows to their few dimension rows
by broadcast, without any shuffle; the other rows take the ordinary join.  Rows
without a key go the same way as the heavy ones: all their nulls would meet in
one task too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRACKED = 10_000        # keys the sketch keeps: it finds every key above 1/TRACKED of the rows or so
HEAVY_KEYS = 1_000      # candidates read from it: no more than this many keys can be above 1/HEAVY_KEYS


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_bytes(df: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1: off)."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def heavy_keys(df: DataFrame, key: str, share: float) -> list:
    """Keys that hold more than ``share`` of the rows (nulls aside), by a top-k sketch.

    The sketch never underestimates away a key above ``share`` as long as
    ``share`` is above 1/TRACKED; keys below it may come along, which only
    moves their rows to the broadcast side.
    """
    if not 1 / HEAVY_KEYS <= share <= 1:
        raise ValueError(f"share must be between 1/{HEAVY_KEYS} and 1")
    top = df.agg(F.expr(f"approx_top_k(`{key}`, {HEAVY_KEYS}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n"))
    found = top.select("n", F.explode("top").alias("t")).select("t.item", "t.count", "n").collect()
    return sorted(r["item"] for r in found if r["item"] is not None and r["count"] > share * r["n"])


def skew_left_join(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None,
                   share: float | None = None, always: bool = False) -> DataFrame:
    """``fact`` left join ``dim`` (whose key is unique), robust against hot keys.

    ``share``: a key is heavy above this part of the rows; by default half of
    what one shuffle partition would get.  Where Spark's estimate already lets
    it broadcast ``dim``, no key is hot, and the plain join is returned at once
    (unless ``always``).
    """
    dim_key = dim_key or key
    side = dim.withColumnRenamed(dim_key, "__key")

    def joined(rows: DataFrame, values: DataFrame) -> DataFrame:
        return rows.join(values, rows[key] == values["__key"], "left").drop("__key")

    if not always and estimated_bytes(dim) <= broadcast_bytes(dim):
        return joined(fact, side)
    if share is None:
        partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        share = min(1.0, max(1 / HEAVY_KEYS, 0.5 / partitions))
    hot = heavy_keys(fact, key, share)
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    apart = F.col(key).isNull() | is_hot
    # at most HEAVY_KEYS rows, as the key is unique
    few = F.broadcast(side.filter(F.col("__key").isin(hot)) if hot else side.limit(0))
    return joined(fact.filter(apart), few).unionByName(joined(fact.filter(~apart), side))
