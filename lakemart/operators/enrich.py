"""Dimension joins, role-playing joins, eager aggregation, set joins (§2 F).

Broadcast policy — a side is broadcast only behind a size check:

* code lists (payment types, rate codes, event names) and the zone lookup get a
  ``broadcast()`` hint if Spark's estimate of their size is below a limit;
* every other side (tables, aggregates) goes through Spark's own check:
  the planner broadcasts it only when its estimated size is under
  ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-decides from the real
  shuffle statistics at runtime; beyond the threshold the join stays a
  sort-merge join whose skewed partitions AQE splits.  This costs no extra
  job and never computes an aggregate twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Largest side that is broadcast by a hint, by Spark's own estimate of its size.
HINT_BYTES = 32 << 20


def bounded(dim: DataFrame, limit: int = HINT_BYTES) -> DataFrame:
    """A dimension that should be small (a code list, a geography), hinted for
    broadcast if Spark estimates it below ``limit`` bytes; otherwise, or with no
    estimate, returned as it is, and the planner and AQE choose the join."""
    from lakemart.operators.skew import estimated_bytes
    return F.broadcast(dim) if estimated_bytes(dim) <= limit else dim


def left_enrich(fact: DataFrame, dim: DataFrame, on: str | list[str],
                bounded_by_construction: bool = False) -> DataFrame:
    """F1j: left equi-join by column name.  A side known to be small is hinted for
    broadcast behind a check of its size; any other is left to the planner/AQE."""
    side = bounded(dim) if bounded_by_construction else dim
    return fact.join(side, on=on, how="left")


def role_playing(fact: DataFrame, dim: DataFrame, key: str,
                 roles: dict[str, str], columns: dict[str, str]) -> DataFrame:
    """F2j/F3j: join one dimension several times under role aliases.

    ``roles`` maps role alias -> fact column (e.g. {"pul": "pulocationid"});
    ``columns`` maps dim column -> output suffix (e.g. {"borough": "borough"}).
    Output columns are ``{role}_{suffix}``; the fact keeps all its columns.
    """
    out = fact
    small = dim
    for role, fact_col in roles.items():
        renamed = small.select(
            F.col(key).alias(f"__{role}_key"),
            *[F.col(c).alias(f"{role}_{suffix}") for c, suffix in columns.items()])
        out = (out.join(renamed, out[fact_col] == renamed[f"__{role}_key"], "left")
               .drop(f"__{role}_key"))
    return out


def eager_aggregate_join(fact: DataFrame, dim: DataFrame, key: str,
                         measures: list[Column]) -> DataFrame:
    """F10j: aggregate the fact by the join key first, then join the dimension.

    Valid when ``key`` is unique on the dimension side: each group then meets
    at most one dimension row, so the result equals join-then-aggregate (a
    semi join keeps the groups whose key exists).  The join now sees one row
    per key instead of one per fact row.
    """
    agg = fact.groupBy(key).agg(*measures)
    return agg.join(dim.select(key), key, "left_semi")


def above_group_average(df: DataFrame, fine_keys: list[str], coarse_keys: list[str],
                        value: str) -> DataFrame:
    """F8j: fine-grained average joined to the coarser average, then a theta filter.

    The coarse average is rolled up from the fine groups' sums and counts (no
    second scan of the fact); NULL values count in ``n`` alone.  The join is
    left to Spark's own size check.
    """
    fine = df.groupBy(*fine_keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("_s"), F.count(value).alias("_c"), F.avg(value).alias("avg_value"),
        F.max(value).alias("max_value"))
    coarse = fine.groupBy(*coarse_keys).agg(F.try_divide(F.sum("_s"), F.sum("_c")).alias("group_avg"))
    return (fine.join(coarse, coarse_keys, "inner")
            .filter(F.col("avg_value") > F.col("group_avg"))
            .drop("_s", "_c"))


def anti(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """F13j: rows of ``left`` with no match in ``right`` (NOT EXISTS)."""
    return left.join(right, on, "left_anti")


def semi(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """F6j: rows of ``left`` with a match in ``right`` (IN / EXISTS)."""
    return left.join(right, on, "left_semi")
