"""Profiling / data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.operators import lake
from lakemart.operators import profile as pf
from lakemart.plans import trips as tp
from lakemart.plans.registry import query
from lakemart.session import scratch_path, table

L = "lineitem"


def _null_sql(source_sql: str, cols: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"count(*) AS n FROM src" for c in cols)
    return source_sql.replace("__BODY__", f"""
SELECT column_name, null_count, null_count * 100.0 / n AS null_pct FROM ({parts})""")


@query("null_profile", rnd=("null_pct",), sql=_null_sql(
    tp.with_eda(L, "SELECT * FROM (WITH src AS (SELECT * FROM eda) __BODY__)"), list(lake.EDA_COLUMNS)))
def null_profile(spark, sf):
    """H1: null count and percent per column, one pass, descending."""
    return pf.null_profile(tp.eda(spark, sf, L))


NULL_WIDE_COLS = ["vendor_name", "ratecode_name", "payment_name", "pickup_zone", "avg_speed_kmh", "tip_ratio"]


@query("null_profile_wide", sql=tp.with_eda(L, "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in NULL_WIDE_COLS) + " FROM eda"))
def null_profile_wide(spark, sf):
    """H2: one row of null counts, one pass."""
    return pf.null_counts_wide(tp.eda(spark, sf, L), NULL_WIDE_COLS)


NAN_COLS = ["trip_distance", "fare_amount", "tip_amount", "passenger_count", "payment_type"]


@query("null_nan_profile", sql=f"WITH {tp.clean_cte('events')}\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL"
    + (f" OR isnan({c})" if c in ("trip_distance", "fare_amount", "tip_amount") else "")
    + ") AS null_or_nan FROM trips" for c in NAN_COLS))
def null_nan_profile(spark, sf):
    """NULL-or-NaN per numeric column (isnan only on floating types)."""
    return pf.null_nan_profile(tp.raw_trips(spark, sf, "events"), NAN_COLS)


@query("numeric_stats", rnd=("mean", ("stddev", 4), "min", "max"), sql="""
SELECT 'l_extendedprice' AS column_name, avg(l_extendedprice) AS mean, stddev_samp(l_extendedprice) AS stddev,
  min(l_extendedprice) AS min, max(l_extendedprice) AS max FROM lineitem""")
def numeric_stats(spark, sf):
    """H5: mean / sample stddev / min / max."""
    return pf.numeric_stats(table(spark, sf, "lineitem"), ["l_extendedprice"])


STAT_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("numeric_stats_multi", rnd=("mean", ("stddev", 4), "min", "max"), sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, avg({c}) AS mean, stddev_samp({c}) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM lineitem" for c in STAT_COLS))
def numeric_stats_multi(spark, sf):
    """H6: the same stats for a list of columns in ONE aggregate."""
    return pf.numeric_stats(table(spark, sf, "lineitem"), STAT_COLS)


CAT_COLS = ["p_brand", "p_type"]


@query("categorical_describe", sql=" UNION ALL ".join(f"""
SELECT * FROM (SELECT '{c}' AS column_name, sum(freq) AS count, count(*) AS unique,
  min(value) FILTER (WHERE freq = mx) AS top, max(freq) AS freq
  FROM (SELECT {c} AS value, count(*) AS freq, max(count(*)) OVER () AS mx FROM part
        WHERE {c} IS NOT NULL GROUP BY {c}))""" for c in CAT_COLS).replace(
    "sum(freq) AS count", "CAST(sum(freq) AS BIGINT) AS count"))
def categorical_describe(spark, sf):
    """H8: count / unique / top / freq of string columns."""
    return pf.categorical_describe(table(spark, sf, "part"), CAT_COLS)


Q_COLS = ["l_extendedprice", "l_quantity"]
PROBS = [0.25, 0.5, 0.75]


@query("quantiles_exact", rnd=("value",), sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {p} AS p, CAST(quantile_cont({c}, {p}) AS DOUBLE) AS value FROM lineitem"
    for c in Q_COLS for p in PROBS).replace(" AS p,", "::DOUBLE AS p,"))
def quantiles_exact(spark, sf):
    """H9: exact quartiles, computed without a single-task percentile merge."""
    return pf.quantile_table(spark, table(spark, sf, "lineitem"), Q_COLS, PROBS)


IQR_COLS = ["l_extendedprice", "l_quantity", "l_tax"]
IQR_CLAMP = ("l_extendedprice",)


def _iqr_sql(c):
    q1 = f"quantile_cont({c}, 0.25)"
    q3 = f"quantile_cont({c}, 0.75)"
    low = f"{q1} - 1.5 * ({q3} - {q1})"
    if c in IQR_CLAMP:
        low = f"greatest({low}, 0.0)"
    return (f"SELECT '{c}' AS column_name, {q1} AS q1, {q3} AS q3, {q3} - {q1} AS iqr, "
            f"{low} AS lower_bound, {q3} + 1.5 * ({q3} - {q1}) AS upper_bound FROM lineitem")


IQR_SQL = " UNION ALL ".join(_iqr_sql(c) for c in IQR_COLS)


@query("iqr_bounds", rnd=("q1", "q3", "iqr", "lower_bound", "upper_bound"), sql=IQR_SQL)
def iqr_bounds(spark, sf):
    """IQR fences, lower fence clamped at 0 for amounts."""
    return pf.iqr_bounds(spark, table(spark, sf, "lineitem"), IQR_COLS, IQR_CLAMP)


@query("iqr_outliers", sql=f"WITH b AS ({IQR_SQL})\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_outliers FROM lineitem, b "
    f"WHERE b.column_name = '{c}' AND ({c} < b.lower_bound OR {c} > b.upper_bound)" for c in IQR_COLS))
def iqr_outliers(spark, sf):
    """Rows outside the fences, per column, one pass."""
    li = table(spark, sf, "lineitem")
    return pf.iqr_outliers(li, pf.iqr_bounds(spark, li, IQR_COLS, IQR_CLAMP))


@query("value_histogram", sql="""
SELECT l_linenumber, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY 1""")
def value_histogram(spark, sf):
    """H11."""
    return pf.value_histogram(table(spark, sf, "lineitem"), "l_linenumber")


THRESHOLDS = {"l_quantity": 45, "l_discount": 0.08, "l_extendedprice": 90000}


@query("threshold_counts", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} > {k}) AS n_above FROM lineitem"
    for c, k in THRESHOLDS.items()))
def threshold_counts(spark, sf):
    """Exceedance counts for several columns in one pass."""
    return pf.threshold_counts(table(spark, sf, "lineitem"), THRESHOLDS)


@query("schema_table")
def schema_table(spark, sf):
    """H13 (rows-only): declared schema with observed NULL counts."""
    return pf.schema_table(table(spark, sf, "orders"))


@query("schema_drift")
def schema_drift(spark, sf):
    """H14 (rows-only): per-slice schema against the union of all slices.

    Slices are written by Spark from ``events``; the later slice gains a
    column and changes a type, as monthly files do.
    """
    root = scratch_path(spark, "drift")
    e = table(spark, sf, "events")
    early = e.filter(F.col("ts") < "2024-01-15").drop("props")
    late = e.filter(F.col("ts") >= "2024-01-15").withColumn("value", F.col("value").cast("float"))
    early.write.parquet(f"{root}/2024-01a")
    late.write.parquet(f"{root}/2024-01b")
    return pf.schema_drift(spark, {"2024-01a": f"{root}/2024-01a", "2024-01b": f"{root}/2024-01b"})
