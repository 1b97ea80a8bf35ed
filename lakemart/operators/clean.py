"""Declarative row filters.

Bounds are data, not code: a mapping ``column -> (low, high, low_incl,
high_incl)`` becomes one conjunctive ``filter`` that Catalyst can push into
the Parquet scan where the column is a plain source column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bound = (low, high, low_inclusive, high_inclusive); None = unbounded side.
Bound = tuple

# ---- fixed values: the outlier bounds of the original taxi job ------------
TAXI_BOUNDS: dict[str, Bound] = {
    "passenger_count": (0, 6, True, True),
    "trip_duration_minutes": (1, 90, False, False),
    "fare_amount": (0, 110, False, False),
    "extra": (0, None, True, False),
    "mta_tax": (0, None, True, False),
    "improvement_surcharge": (0, None, True, False),
    "tip_amount": (0, 30, True, False),
    "tolls_amount": (0, 30, True, False),
    "total_amount": (0, 110, False, False),
    "trip_distance": (0, 100, False, False),
    "pickup_year": (2022, 2026, True, False),
}


def bound_predicate(c: Column, bound: Bound) -> Column:
    low, high, low_incl, high_incl = bound
    parts = []
    if low is not None:
        parts.append(c >= low if low_incl else c > low)
    if high is not None:
        parts.append(c <= high if high_incl else c < high)
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def bounds_condition(bounds: dict[str, Bound], columns: dict[str, Column] | None = None) -> Column:
    """One conjunction over all bounds; ``columns`` maps virtual names to expressions."""
    columns = columns or {}
    preds = [bound_predicate(columns.get(name, F.col(name)), b) for name, b in bounds.items()]
    return reduce(lambda a, b: a & b, preds)


def filter_bounds(df: DataFrame, bounds: dict[str, Bound], pickup_col: str = "tpep_pickup_datetime") -> DataFrame:
    """Keep rows inside every bound.  ``pickup_year`` is the year of the pickup."""
    virtual = {"pickup_year": F.year(pickup_col)}
    return df.filter(bounds_condition(bounds, virtual))


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows with a NULL in any key column."""
    return df.dropna(how="any", subset=keys)


def any_exceeds(df: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Disjunctive anomaly filter ``a > x OR b > y OR ...``."""
    cond = reduce(lambda a, b: a | b, [F.col(c) > v for c, v in limits.items()])
    return df.filter(cond)


def existing_in_order(df: DataFrame, expected: list[str]) -> DataFrame:
    """Project the expected columns that exist, in the expected order."""
    present = set(df.columns)
    return df.select([c for c in expected if c in present])


def count_lines_with(lines: DataFrame, pattern: str, column: str = "value") -> DataFrame:
    """Number of lines containing a literal substring (one global agg)."""
    return lines.agg(F.count_if(F.col(column).contains(pattern)).alias("n_lines"))
