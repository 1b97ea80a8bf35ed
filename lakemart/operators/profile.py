"""Single-pass profiling and data quality.

Every per-column statistic is computed in ONE aggregate over all columns and
then unpivoted — never one Spark job per column.  Exact quantiles avoid
Spark's ``percentile`` (whose final merge holds every distinct value in one
task): a value histogram is cut by approximate splits, bucket counts give
rank offsets, the range holding each wanted rank is refined until it is
small, and only that bounded range is ranked exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.session import checkpoint_root

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns by type (long and decimal included)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def floating_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]


def _long(wide: DataFrame, cols: list[str], value_name: str) -> DataFrame:
    return wide.unpivot([], cols, "column_name", value_name)


def null_counts_wide(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """H2: one row, one null count per column, one pass."""
    cols = cols or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """H1: (column_name, null_count, null_pct) ordered by null_count desc."""
    cols = cols or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["__rows"], cols, "column_name", "null_count")
    return (long.select("column_name", "null_count",
                        (F.col("null_count") * 100.0 / F.col("__rows")).alias("null_pct"))
            .orderBy(F.desc("null_count"), "column_name"))


def null_nan_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NULL-or-NaN counts; ``isnan`` only on floating columns."""
    cols = cols or numeric_columns(df)
    floating = set(floating_columns(df))
    def bad(c):
        return F.col(c).isNull() | F.isnan(c) if c in floating else F.col(c).isNull()
    wide = df.agg(*[F.count_if(bad(c)).alias(c) for c in cols])
    return _long(wide, cols, "null_or_nan")


def numeric_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """H5/H6: mean, sample stddev, min, max for several columns in ONE pass."""
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        aggs += [F.avg(v).alias(f"{c}__mean"), F.stddev_samp(v).alias(f"{c}__stddev"),
                 F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__mean").alias("mean"),
                        F.col(f"{c}__stddev").alias("stddev"), F.col(f"{c}__min").alias("min"),
                        F.col(f"{c}__max").alias("max")) for c in cols]
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def describe(df: DataFrame, cols: list[str] | None = None,
             stats: tuple = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")) -> DataFrame:
    """H7: Spark's ``summary`` (one job; percentiles are approximate)."""
    sel = df.select(*(cols or numeric_columns(df)))
    return sel.summary(*stats)


def categorical_describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """H8: count, unique, top, freq per string column (pandas ``describe``).

    (column, value) pairs are counted by aggregation; the top value is the
    most frequent, ties to the smallest value.  Only aggregations and one
    broadcast semi join on (column, count) — no window over a column's
    distinct values, no shuffle on the count.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("p")).select("p.*")
    counts = pairs.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("freq"))
    per_col = counts.groupBy("column_name").agg(
        F.sum("freq").alias("count"), F.count(F.lit(1)).alias("unique"), F.max("freq").alias("freq"))
    # per_col has exactly one row per requested column (bounded by
    # construction): broadcast it.  A shuffle on (column, freq) would send
    # every freq=1 value of a high-cardinality column to one task.
    top = (counts.join(F.broadcast(per_col.select("column_name", "freq")), ["column_name", "freq"], "left_semi")
           .groupBy("column_name").agg(F.min("value").alias("top")))
    return (F.broadcast(per_col).join(top, "column_name")
            .select("column_name", "count", "unique", "top", "freq"))


MAX_EXACT_VALUES = 1_000_000   # distinct values one task may rank exactly


def exact_quantiles_multi(df: DataFrame, cols: list[str], probs: list[float],
                          buckets: int = 512, max_exact: int = MAX_EXACT_VALUES
                          ) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles (``quantile_cont`` semantics) of
    several columns, with no step that ranks an unbounded set in one task.

    1. histogram of (column, value) -> count: a map-side-combined aggregation
       (a hot value costs one row per task), checkpointed to shared storage,
       so the source is scanned once for all columns;
    2. refinement rounds: every open value range is cut at approximate split
       points (a bounded sketch, ``buckets`` values per range to the driver)
       with a Bucketizer, bucket row counts give rank offsets (O(buckets)
       rows to the driver), and each wanted rank narrows to one bucket — about
       1/``buckets`` of the range's distinct values.  Rounds repeat until a
       range holds at most ``max_exact`` distinct values (one round suffices
       up to ``buckets * max_exact`` distinct values);
    3. one window job ranks each final, bounded range and returns only the
       rows at the wanted ranks.
    All columns and probabilities share the same jobs.
    """
    from pyspark.ml.feature import Bucketizer
    from pyspark.sql import Window

    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v")) for c in cols])).alias("p"))
    hist = (pairs.select("p.col", "p.v").filter(F.col("v").isNotNull() & ~F.isnan("v"))
            .groupBy("col", "v").agg(F.count(F.lit(1)).alias("c")))
    checkpoint_root(df.sparkSession)
    hist = hist.checkpoint(eager=True)      # every later job reads it
    totals = {r["col"]: (r["n"], r["d"]) for r in hist.groupBy("col").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("d")).collect()}
    inf = float("inf")
    # target (col, rank) -> [lo, hi, offset, distinct]: rank lies in values [lo, hi),
    # offset = rows of the column below lo.
    targets = {}
    for c in cols:
        n, d = totals.get(c, (0, 0))
        for p in probs:
            if n:
                pos = p * (n - 1)
                for k in (math.floor(pos), math.ceil(pos)):
                    targets[(c, k)] = [-inf, inf, 0, d]

    def in_range(c, lo, hi):
        cond = F.col("col") == c
        if lo != -inf:
            cond = cond & (F.col("v") >= lo)
        if hi != inf:
            cond = cond & (F.col("v") < hi)
        return cond

    while True:
        open_ranges = sorted({(c, lo, hi) for (c, _k), (lo, hi, _o, d) in targets.items() if d > max_exact})
        if not open_ranges:
            break
        rid = {r: i for i, r in enumerate(open_ranges)}
        tagged = None
        for r, i in rid.items():
            part = hist.filter(in_range(*r)).withColumn("rid", F.lit(i))
            tagged = part if tagged is None else tagged.unionByName(part)
        fractions = [i / buckets for i in range(1, buckets)]
        split_rows = tagged.groupBy("rid").agg(
            F.percentile_approx("v", fractions, 10 * buckets).alias("s")).collect()
        edges = {}
        for r in split_rows:
            c, lo, hi = open_ranges[r["rid"]]
            inner = sorted({float(x) for x in (r["s"] or []) if lo < x < hi})
            edges[r["rid"]] = [lo] + inner + [hi] if lo != -inf else [-inf] + inner + [hi]
        bucketed = None
        for i, e in edges.items():
            one = Bucketizer(splits=e, inputCol="v", outputCol="bd").transform(tagged.filter(F.col("rid") == i))
            bucketed = one if bucketed is None else bucketed.unionByName(one)
        counts = {}
        for r in bucketed.groupBy("rid", "bd").agg(F.sum("c").alias("rows"),
                                                   F.count(F.lit(1)).alias("d")).collect():
            counts.setdefault(r["rid"], []).append((int(r["bd"]), r["rows"], r["d"]))
        for (c, k), st in targets.items():
            lo, hi, off, d = st
            if d <= max_exact:
                continue
            i = rid[(c, lo, hi)]
            e = edges[i]
            acc = off
            for b, rows, dd in sorted(counts.get(i, [])):
                if acc <= k < acc + rows:
                    if dd >= d:
                        raise RuntimeError(f"the range of {c} from {lo} to {hi} could not be split")
                    targets[(c, k)] = [e[b], e[b + 1], acc, dd]
                    break
                acc += rows

    result = {c: [None] * len(probs) for c in cols}
    if not targets:
        return result
    final = sorted({(c, lo, hi, off) for (c, _k), (lo, hi, off, _d) in targets.items()})
    fid = {r: i for i, r in enumerate(final)}
    ranked = None
    for (c, lo, hi, off), i in fid.items():
        part = hist.filter(in_range(c, lo, hi)).withColumn("fid", F.lit(i)).withColumn("off", F.lit(off))
        ranked = part if ranked is None else ranked.unionByName(part)
    w = Window.partitionBy("fid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranked.withColumn("cum", F.sum("c").over(w) + F.col("off"))
    hit = None
    for (c, k), (lo, hi, off, _d) in targets.items():
        cond = ((F.col("fid") == fid[(c, lo, hi, off)]) & (F.col("cum") - F.col("c") <= k)
                & (F.col("cum") - 1 >= k))
        hit = cond if hit is None else hit | cond
    value_at = {}
    for r in ranked.filter(hit).select("col", "v", "c", "cum").collect():
        for (c, k) in targets:
            if c == r["col"] and r["cum"] - r["c"] <= k <= r["cum"] - 1:
                value_at[(c, k)] = r["v"]
    for c in cols:
        n = totals.get(c, (0, 0))[0]
        if not n:
            continue
        for i, p in enumerate(probs):
            pos = p * (n - 1)
            lo, hi = math.floor(pos), math.ceil(pos)
            a, b = value_at[(c, lo)], value_at[(c, hi)]
            result[c][i] = a if lo == hi else a + (b - a) * (pos - lo)
    return result


def exact_quantiles(df: DataFrame, col: str, probs: list[float], buckets: int = 512) -> list[float | None]:
    """Exact quantiles of one column (see ``exact_quantiles_multi``)."""
    return exact_quantiles_multi(df, [col], probs, buckets)[col]


def quantile_table(spark: SparkSession, df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """H9: (column_name, p, value) for every column and probability."""
    q = exact_quantiles_multi(df, cols, probs)
    rows = [(c, float(p), v) for c in cols for p, v in zip(probs, q[c])]
    return spark.createDataFrame(rows, "column_name string, p double, value double")


def iqr_bounds(spark: SparkSession, df: DataFrame, cols: list[str], clamp_zero: tuple = ()) -> DataFrame:
    """q1, q3, iqr, q1 - 1.5 iqr (clamped at 0 for amounts), q3 + 1.5 iqr."""
    rows = []
    q = exact_quantiles_multi(df, cols, [0.25, 0.75])
    for c in cols:
        q1, q3 = q[c]
        if q1 is None or q3 is None:        # no value at all
            rows.append((c, None, None, None, None, None))
            continue
        iqr = q3 - q1
        low = q1 - 1.5 * iqr
        if c in clamp_zero:
            low = max(low, 0.0)
        rows.append((c, q1, q3, iqr, low, q3 + 1.5 * iqr))
    return spark.createDataFrame(
        rows, "column_name string, q1 double, q3 double, iqr double, lower_bound double, upper_bound double")


def iqr_outliers(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows outside the bounds, per column, in ONE pass over ``df``.

    ``bounds`` has one row per column (O(columns)), so its values are brought
    to the driver and inlined as literals — no join with the fact.
    """
    b = {r.column_name: (F.lit(r.lower_bound), F.lit(r.upper_bound)) for r in bounds.collect()}
    cols = list(b)
    wide = df.agg(*[F.count_if((F.col(c) < b[c][0]) | (F.col(c) > b[c][1])).alias(c) for c in cols])
    return _long(wide, cols, "n_outliers")


def threshold_counts(df: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Rows above a threshold, per column, in one pass."""
    wide = df.agg(*[F.count_if(F.col(c) > k).alias(c) for c, k in thresholds.items()])
    return _long(wide, list(thresholds), "n_above")


def value_histogram(df: DataFrame, col: str) -> DataFrame:
    """Value -> count, ordered by value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(col)


def schema_table(df: DataFrame) -> DataFrame:
    """(column_name, type, nullable, null_count) — the declared schema
    joined with the observed NULL counts of one pass over the data."""
    fields = {f.name: f for f in df.schema.fields}
    nulls = null_counts_wide(df).unpivot([], df.columns, "column_name", "null_count")
    meta = df.sparkSession.createDataFrame(
        [(n, f.dataType.simpleString(), f.nullable) for n, f in fields.items()],
        "column_name string, type string, nullable boolean")
    return meta.join(nulls, "column_name")


def schema_drift(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Which columns (and types) each slice has, against the union.

    ``paths`` maps slice -> location; reading a Parquet schema touches file
    footers only.  Output: (column_name, slice, type) with NULL type where the
    slice lacks the column.
    """
    rows = []
    schemas = {s: spark.read.parquet(p).schema for s, p in paths.items()}
    all_cols = sorted({f.name for sch in schemas.values() for f in sch.fields})
    for s, sch in schemas.items():
        types = {f.name: f.dataType.simpleString() for f in sch.fields}
        for c in all_cols:
            rows.append((c, s, types.get(c)))
    return spark.createDataFrame(rows, "column_name string, slice string, type string")
