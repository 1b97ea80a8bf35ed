"""Incremental medallion jobs.

A *slice* is a month (``YYYY-MM``).  Progress lives in a manifest table
(slice, status, rows, written_at, files) that is appended only after a slice's
data write has committed, so a half-written slice is never taken as done.
Candidates come from Spark's own file listing (``_metadata.file_path``), not
from a driver-side object-store loop; new = candidates anti-joined with the
manifest on file path, length and time, so a file that arrives late or is
replaced makes its slice new again; all new slices are read in ONE multi-path scan and written with a
partitioned, dynamic-overwrite write, so a re-run of a slice replaces it.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions import features as fx
from lakemart.operators import layers
from lakemart.operators.clean import Bound, filter_bounds, bounds_condition

SLICE_PATTERN = r"(\d{4}-\d{2})"

# ---- fixed values: column contract of the normalised trip layer ----------
TRIP_TYPES: dict[str, str] = {
    "vendorid": "int", "pulocationid": "int", "dolocationid": "int",
    "payment_type": "int", "ratecodeid": "int", "passenger_count": "int",
    "fare_amount": "double", "extra": "double", "mta_tax": "double",
    "tip_amount": "double", "tolls_amount": "double",
    "improvement_surcharge": "double", "total_amount": "double",
    "congestion_surcharge": "double", "airport_fee": "double",
    "cbd_congestion_fee": "double", "trip_distance": "double",
}
TRIP_COLUMNS = [
    "vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime",
    "passenger_count", "trip_distance", "ratecodeid", "store_and_fwd_flag",
    "pulocationid", "dolocationid", "payment_type", "fare_amount", "extra",
    "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
]
EDA_COLUMNS = [
    "vendorid", "vendor_name", "tpep_pickup_datetime", "tpep_dropoff_datetime",
    "passenger_count", "trip_distance", "ratecodeid", "ratecode_name",
    "pulocationid", "pickup_borough", "pickup_zone", "dolocationid",
    "dropoff_borough", "dropoff_zone", "payment_type", "payment_name",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge",
    "airport_fee", "trip_duration_minutes", "date_month", "year", "month",
    "day", "day_of_week", "hour", "is_weekend", "time_of_day", "is_rush_hour",
    "avg_speed_kmh", "tip_ratio", "has_tip", "revenue_per_minute",
]

FILE_COLUMNS = ["path", "length", "modified"]
MANIFEST_SCHEMA = ("slice string, status string, rows bigint, written_at timestamp, run_id string, "
                   "files array<struct<path: string, length: bigint, modified: bigint>>")


# ---- C1 / E26 -------------------------------------------------------------

def slice_key(path: str | Column) -> Column:
    """The ``YYYY-MM`` slice a file belongs to, or NULL.

    Looked up, in order, in a ``slice=YYYY-MM`` partition folder, in a file
    name that is not a Spark part file (``yellow_2025-01.parquet``), and in
    the parent folder name (``yellow_2025-01/part-...``).  Part-file names
    carry UUIDs whose digits can look like a month, so they are never used.
    """
    p = F.col(path) if isinstance(path, str) else path
    parts = F.split(p, "/")
    name = F.element_at(parts, -1)
    parent = F.element_at(parts, -2)

    def hit(text: Column, pattern: str) -> Column:
        found = F.regexp_extract(text, pattern, 1)
        return F.when(found != "", found)

    return F.coalesce(
        hit(p, r"/slice=(\d{4}-\d{2})/"),
        F.when(~name.startswith("part-"), hit(name, SLICE_PATTERN)),
        hit(parent, SLICE_PATTERN),
    )


def file_name(path: str | Column) -> Column:
    """Last path element without a ``.parquet`` suffix."""
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(F.element_at(F.split(F.regexp_replace(p, "/+$", ""), "/"), -1),
                            r"\.parquet$", "")


# ---- C2 / C3 / C4 / C5 ----------------------------------------------------

def list_candidates(spark: SparkSession, root: str) -> DataFrame:
    """One row per data file under ``root``: slice, path, length, modified (microseconds).

    Uses the binaryFile source only for its listing columns (``content`` is
    pruned, so files are not read) — the listing runs as a Spark job, not as
    a driver-side loop over an object-store client.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(root)
             .select("path", "length", F.unix_micros("modificationTime").alias("modified")))
    return (files.select(*FILE_COLUMNS, slice_key("path").alias("slice"))
            .filter(F.col("slice").isNotNull()))


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """Finished slices (done or removed); a missing manifest means nothing is done yet."""
    try:
        rows = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_path)
    except Exception as exc:  # AnalysisException: path does not exist
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], MANIFEST_SCHEMA)
        raise
    return rows.filter(F.col("status").isin("done", "removed"))


def pending_slices(candidates: DataFrame, done: DataFrame) -> DataFrame:
    """C4: slices whose files differ from those last read for them: a new, late
    or replaced file, or one that is no longer there (left anti joins both ways)."""
    keys = ["slice", *FILE_COLUMNS]
    last = done.groupBy("slice").agg(F.max_by("files", "written_at").alias("files"))
    read = last.select("slice", F.inline("files"))
    there = candidates.select(*keys)
    return (there.join(read, keys, "left_anti").unionByName(read.join(there, keys, "left_anti"))
            .select("slice").distinct())


def missing(remote: DataFrame, local: DataFrame) -> DataFrame:
    """Set difference remote - local (EXCEPT DISTINCT)."""
    return remote.subtract(local)


# ---- C6 -------------------------------------------------------------------

def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def standardize(df: DataFrame, types: dict[str, str] | None = None,
                expected: list[str] | None = None, add_missing: bool = False) -> DataFrame:
    """Lower-case names, typed coalesce (bad/NULL -> 0), ordered projection.

    One ``select`` — not a loop of ``withColumn`` — so the plan stays flat.
    ``add_missing=True`` adds absent expected columns as typed NULLs so every
    slice has the same schema (the original only keeps columns that exist).
    """
    types = TRIP_TYPES if types is None else types
    expected = TRIP_COLUMNS if expected is None else expected
    df = lower_names(df)
    present = set(df.columns)
    cols = []
    for name in expected:
        if name in present:
            if name in types:
                default = 0 if types[name] in ("int", "bigint") else 0.0
                cols.append(fx.typed_coalesce(name, types[name], default).alias(name))
            else:
                cols.append(F.col(name))
        elif add_missing:
            cols.append(F.lit(None).cast(types.get(name, "string")).alias(name))
    return df.select(cols)


# ---- C9 -------------------------------------------------------------------

def clean_trips(trips: DataFrame, bounds: dict[str, Bound]) -> DataFrame:
    """C9 part 1: duration, outlier filter and derived features."""
    d = trips.withColumn("trip_duration_minutes",
                         fx.duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime"))
    d = filter_bounds(d, bounds)
    d = fx.add_time_features(d, "tpep_pickup_datetime")
    d = d.withColumns({
        "avg_speed_kmh": fx.speed_kmh("trip_distance", "trip_duration_minutes"),
        "tip_ratio": fx.ratio("tip_amount", "fare_amount"),
        "has_tip": fx.flag(F.col("tip_amount") > 0),
        "revenue_per_minute": fx.per_minute("total_amount", "trip_duration_minutes"),
    })
    return d.drop("store_and_fwd_flag")


#: which dimension brings which columns to the trips
DIMENSION_COLUMNS = {
    "vendors": ("vendor_name",), "ratecodes": ("ratecode_name",), "payments": ("payment_name",),
    "pickup": ("pickup_borough", "pickup_zone"), "dropoff": ("dropoff_borough", "dropoff_zone"),
}


def enrich_trips(clean: DataFrame, vendors: DataFrame, ratecodes: DataFrame, payments: DataFrame, zones: DataFrame,
                 columns: tuple[str, ...] | None = None) -> DataFrame:
    """C9 part 2: left joins to four dimensions, zones twice (role-playing).

    ``columns`` leaves out the joins that none of these columns needs (every
    dimension's key is unique, so a left join that is not read changes nothing).

    Code lists (rate codes, payments) and the zone lookup (a fixed geography:
    25 nations here, about 265 taxi zones in the original data) are broadcast
    behind a check of their size (``enrich.bounded``) — a shuffle join on a 25-value key would send
    the whole fact through at most 25 tasks.  Vendors grow with the data: Spark's
    size check decides, and beyond it heavy vendors are joined apart.
    """
    from lakemart.operators.enrich import bounded, role_playing
    from lakemart.operators.skew import skew_left_join

    def read(dimension: str) -> bool:
        return columns is None or any(c in columns for c in DIMENSION_COLUMNS[dimension])

    facts = skew_left_join(clean, vendors, "vendorid") if read("vendors") else clean
    if read("ratecodes"):
        facts = facts.join(bounded(ratecodes), "ratecodeid", "left")
    if read("payments"):
        facts = facts.join(bounded(payments), "payment_type", "left")
    roles = {"pickup": "pulocationid", "dropoff": "dolocationid"}
    return role_playing(facts, bounded(zones), "locationid", {r: c for r, c in roles.items() if read(r)},
                        {"borough": "borough", "zone": "zone"})


def eda(trips: DataFrame, bounds: dict[str, Bound], vendors: DataFrame, ratecodes: DataFrame,
        payments: DataFrame, zones: DataFrame) -> DataFrame:
    """Clean + enrich + the fixed 39-column projection."""
    enriched = enrich_trips(clean_trips(trips, bounds), vendors, ratecodes, payments, zones)
    return enriched.select(*[c for c in EDA_COLUMNS if c in enriched.columns])


# ---- C12 / C13 / C14 ------------------------------------------------------

def slice_census(df: DataFrame) -> DataFrame:
    """Rows per (date_month, year, month), ordered."""
    return (df.groupBy("date_month", "year", "month").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("year", "month"))


def clean_report(trips: DataFrame, bounds: dict[str, Bound]) -> DataFrame:
    """Before / after / removed in ONE pass (count_if of the filter)."""
    d = trips.withColumn("trip_duration_minutes",
                         fx.duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime"))
    keep = bounds_condition(bounds, {"pickup_year": F.year("tpep_pickup_datetime")})
    agg = d.agg(F.count(F.lit(1)).alias("rows_before"),
                F.count_if(F.coalesce(keep, F.lit(False))).alias("rows_after"))
    return agg.select(
        "rows_before", "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        F.round(F.try_divide(F.col("rows_before") - F.col("rows_after"), F.col("rows_before")) * 100, 4)
        .alias("pct_removed"))


def load_check(df: DataFrame) -> DataFrame:
    """C14: the loaded table is not empty."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("ok", F.col("n_rows") > 0)


# ---- C7 / C8 / C10 --------------------------------------------------------

#: Files of a slice up to which a scan of them is written without a shuffle.
FEW_FILES = 4


def write_slices(df: DataFrame, root: str, slice_col: str = "slice", mode: str = "overwrite",
                 clustered: bool = False) -> None:
    """Write a DataFrame as one folder per slice; dynamic overwrite replaces only
    the slices present in ``df`` and never the others.

    ``rebalance`` clusters rows by slice so files are few and large, and AQE
    splits a skewed slice (say a month with a third of all rows) across many
    tasks instead of writing it from one; no coalesce(1).

    ``clustered``: the rows come from a scan of few files a slice, with no shuffle
    since; a task then holds few slices, and the rows needn't travel again.
    """
    rows = df if clustered else df.hint("rebalance", slice_col)
    (rows.write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(slice_col).parquet(root))


def append_manifest(spark: SparkSession, manifest_path: str, counts: DataFrame, files: DataFrame,
                    run_id: str | None = None) -> str:
    """Record slices and the ``files`` read for them as done (call after their data write committed)."""
    run_id = run_id or uuid.uuid4().hex
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    read = files.groupBy("slice").agg(F.collect_list(F.struct(*FILE_COLUMNS)).alias("files"))
    (counts.withColumn("slice", F.col("slice").cast("string")).join(read, "slice", "left")
     .select(F.col("slice"), F.lit("done").alias("status"),
                   F.col("rows").cast("bigint").alias("rows"),
                   F.lit(now).cast("timestamp").alias("written_at"),
                   F.lit(run_id).alias("run_id"), F.col("files"))
     .write.mode("append").parquet(manifest_path))
    return run_id


def schema_groups(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], T.StructType]]:
    """Files in as few groups as their schemas allow: within a group no column
    changes its type.  Footers are read by Spark's own schema merge, in tasks;
    where it fails the files are halved, so a drift between months costs a few
    merges, and runs of files with agreeing types are put together again."""
    def merged(some: list[str]) -> list[tuple[list[str], T.StructType]]:
        try:
            return [(some, spark.read.option("mergeSchema", "true").parquet(*some).schema)]
        except Exception as exc:
            if layers.data_error(exc) is None or len(some) == 1:
                raise
        half = len(some) // 2
        return merged(some[:half]) + merged(some[half:])

    groups: list[tuple[list[str], dict[str, T.StructField]]] = []
    for files, schema in merged(sorted(paths)):
        fields = {f.name.lower(): f for f in schema.fields}
        for members, known in groups:
            if all(known[n].dataType == f.dataType and known[n].name == f.name for n, f in fields.items() if n in known):
                members += files
                known.update({n: f for n, f in fields.items() if n not in known})
                break
        else:
            groups.append((list(files), fields))
    return [(members, T.StructType(list(known.values()))) for members, known in groups]


def _normalize(spark: SparkSession, files: dict[str, list[str]], silver_root: str) -> None:
    """All files ({slice: paths}) in one write: one scan for each group of agreeing schemas."""
    paths = [p for some in files.values() for p in some]
    out = None
    for some, schema in schema_groups(spark, paths):
        raw = spark.read.schema(schema).parquet(*some).withColumn("__slice", slice_key(F.col("_metadata.file_path")))
        part = standardize(raw, expected=TRIP_COLUMNS + ["__slice"], add_missing=True).withColumnRenamed("__slice", "slice")
        # columns without a declared type (timestamps) may be absent here and typed there
        out = part if out is None else out.unionByName(part)
    write_slices(out, silver_root, clustered=len(paths) <= FEW_FILES * len(files))


def incremental_normalize(spark: SparkSession, bronze_root: str, silver_root: str,
                          manifest_path: str, full: bool = False,
                          on_error: str = "raise") -> DataFrame:
    """Standardise every pending slice in one job, whatever types its
    columns have in which month.  Slices whose files are all gone are dropped.

    Returns a status DataFrame (slice, rows, status).  ``full=True`` reprocesses
    every candidate (C8).  ``on_error="skip"`` gives a slice that can't be read an
    ``error`` status and goes on with the others; ``"raise"`` fails fast (C7).
    Failures that don't come from the data of a slice are always raised.
    """
    candidates = list_candidates(spark, bronze_root)
    done = spark.createDataFrame([], MANIFEST_SCHEMA) if full else read_manifest(spark, manifest_path)
    # The names of pending files are O(files): Spark wants a scan's paths from the driver.
    names = [r.slice for r in pending_slices(candidates, done).collect()]
    pending = candidates.filter(F.col("slice").isin(names)) if names else candidates.limit(0)
    listed = pending.collect()
    files: dict[str, list[str]] = {}
    for r in listed:
        files.setdefault(r.slice, []).append(r.path)
    gone = sorted(set(names) - set(files))
    status = "slice string, rows bigint, status string"

    def work(slices: list[str]) -> None:
        _normalize(spark, {s: files[s] for s in slices}, silver_root)

    failed = layers.bisect(sorted(files), work, on_error)
    layers.delete_slices(spark, silver_root, gone)
    errors = spark.createDataFrame([(s, None, f"error: {e}") for s, e in sorted(failed.items())], status)
    good = [s for s in files if s not in failed]
    if not good and not gone:
        return errors
    run_id = uuid.uuid4().hex
    if good:
        counts = (spark.read.parquet(silver_root).filter(F.col("slice").cast("string").isin(good))
                  .groupBy("slice").agg(F.count(F.lit(1)).alias("rows")))
        append_manifest(spark, manifest_path, counts, spark.createDataFrame(listed, pending.schema), run_id)
    if gone:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        (spark.createDataFrame([(s, "removed", 0, now, run_id, []) for s in gone], MANIFEST_SCHEMA)
         .write.mode("append").parquet(manifest_path))
    # The manifest is append-only, so this read stays the same later on.
    return (spark.read.parquet(manifest_path).filter(F.col("run_id") == run_id)
            .select("slice", "rows", "status").unionByName(errors))


def split_by_schema(spark: SparkSession, root: str, slices: list[str], declared: T.StructType) -> list[list[str]]:
    """The slices whose files have the declared types, and those that have others:
    known from the files' footers, so that a write of the former isn't lost to the latter."""
    files = {r.path: r.slice for r in list_candidates(spark, root).filter(F.col("slice").isin(slices)).collect()}
    types = {f.name.lower(): f.dataType for f in declared.fields}
    odd: set[str] = set()
    try:
        for paths, schema in schema_groups(spark, list(files)) if files else []:
            if any(types.get(f.name.lower(), f.dataType) != f.dataType for f in schema.fields):
                odd |= {files[p] for p in paths}
    except Exception as exc:
        if layers.data_error(exc) is None:
            raise                       # a footer that can't be read: the slices are halved as they are
        return [slices]
    return [some for some in ([s for s in slices if s not in odd], [s for s in slices if s in odd]) if some]


def manifest_versions(manifest: DataFrame) -> DataFrame:
    """The normalised layer as the input of the next: (slice, status, version)."""
    return layers.latest(manifest.drop("files")).select("slice", "status", F.col("run_id").alias("version"))
