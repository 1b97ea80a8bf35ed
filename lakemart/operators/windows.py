"""Windows, latest-per-key, rolling means, top-k, set ops, hierarchy (§2 I).

Skew rule: a window ``partitionBy(key)`` puts a whole key in one task.  Where
a key is unbounded (a department, a user), we aggregate first and join the
small result back, or use an algebraic aggregate (``max`` of a struct), so
Spark combines map-side and a hot key never lands whole in one task.
Windows are used only over already-aggregated, bounded series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.functions import features as fx


def with_group_average(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``AVG(value) OVER (PARTITION BY key)`` on every row, skew-safe.

    Partial aggregation per key, then a null-safe join back (rows without a key
    are a group, as in the window).  The aggregate has one row per key; Spark
    broadcasts it under its own size threshold, beyond it the join is a
    sort-merge join whose hot partitions AQE splits.
    """
    avg = df.groupBy(F.col(key).alias("_group")).agg(F.avg(value).alias(out))
    return df.join(avg, df[key].eqNullSafe(avg["_group"]), "left").drop("_group")


def lag_growth(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Previous value, change, percent and status per series.

    Runs over one row per (key, period) — already aggregated — so each
    window partition is bounded by the number of periods.
    """
    w = Window.partitionBy(key).orderBy(order)
    prev = F.lag(value, 1).over(w)
    return (df.withColumn("revenue_lag1", prev)
            .withColumn("revenue_change_lag1", F.col(value) - F.col("revenue_lag1"))
            .withColumn("percent", F.try_divide(F.col("revenue_change_lag1"), F.col("revenue_lag1")) * 100)
            .withColumn("grow_status", fx.growth_status("revenue_change_lag1", "revenue_lag1")))


def latest_per_key(users: DataFrame, orders: DataFrame, key: str, order_key: str,
                   carry: list[str]) -> DataFrame:
    """I3/I4/F7j: each user's highest ``order_key`` row, users without orders kept.

    ``max(struct(order_key, ...))`` is an algebraic aggregate: partial maxima
    are computed map-side, so a user with a third of all orders costs one row
    per task in the shuffle.  Ties on ``order_key`` resolve on the carried
    columns, deterministically.
    """
    best = (orders.groupBy(key)
            .agg(F.max(F.struct(order_key, *carry)).alias("_last"))
            .select(key, *[F.col(f"_last.{c}").alias(c) for c in [order_key, *carry]]))
    return users.join(best, key, "left")


def rolling_mean(daily: DataFrame, order: str, value: str, rows: int = 7,
                 partition: list[str] | None = None) -> DataFrame:
    """``rolling(rows, min_periods=1).mean()`` over ROWS, not days.

    Input must be one row per period (aggregate first); a window without
    partition keys runs in one task, which is fine for a daily series.
    """
    w = Window.orderBy(order) if not partition else Window.partitionBy(*partition).orderBy(order)
    return daily.withColumn(f"rolling_{rows}", F.avg(value).over(w.rowsBetween(-(rows - 1), 0)))


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """ORDER BY ... LIMIT k (a TakeOrderedAndProject: k rows per task)."""
    return df.orderBy(*order).limit(k)


def hierarchy(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """I12/I13/F14j: walk ``(id, parent_id, name)`` from the roots.

    One join per level, each level written to the checkpoint folder; the walk
    ends at the first empty level, without a limit on rows or depth.  An id
    array stops cycles exactly.  Orphans (parent not found) are unreachable
    from a root and therefore dropped, as in the original.
    """
    from lakemart.session import checkpoint_root
    checkpoint_root(spark)
    nodes = nodes.select("id", "parent_id", "name")
    level = nodes.filter(F.col("parent_id").isNull()).select(
        "*", F.lit(1).alias("level"), F.col("name").cast("string").alias("path"), F.array("id").alias("seen"))
    found = None
    while True:
        level = level.checkpoint(eager=True)
        if found is not None and level.isEmpty():
            return found
        here = level.select("id", "parent_id", "name", "level", "path")
        found = here if found is None else found.union(here)
        up = level.select(F.col("id").alias("_up"), F.col("level").alias("_level"), F.col("path").alias("_path"), "seen")
        level = (nodes.join(up, F.col("parent_id") == F.col("_up"))
                 .filter(~F.array_contains("seen", F.col("id")))
                 .select("id", "parent_id", "name", (F.col("_level") + 1).alias("level"),
                         F.concat("_path", F.lit(" -> "), "name").alias("path"),
                         F.concat("seen", F.array("id")).alias("seen")))


def set_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """INTERSECT (distinct)."""
    return a.intersect(b)


def leaderboard(scores: DataFrame, member: str, score: str, k: int, threshold: float) -> DataFrame:
    """I8: top-k members by score plus the count with score >= threshold.

    The count is one global ``count_if`` (a single scalar brought back to the
    driver), the top-k a bounded TakeOrdered; no join between the two.  The
    scores (one row per member) are written once to shared storage and read
    by both, so the fact is scanned and shuffled once.
    """
    from lakemart.session import checkpoint_root
    checkpoint_root(scores.sparkSession)
    scores = scores.checkpoint(eager=True)
    n_over = scores.agg(F.count_if(F.col(score) >= threshold)).first()[0]
    top = (scores.orderBy(F.desc(score), F.asc(member)).limit(k)
           .withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), F.asc(member)))))
    return top.withColumn("n_at_or_above", F.lit(n_over).cast("bigint"))
