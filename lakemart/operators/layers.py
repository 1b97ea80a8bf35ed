"""Layers kept up to date slice by slice.

Every layer has a *ledger*: one row per attempt at a slice (slice, status, rows,
the run that wrote it, the version of its input, the error if it failed).  The
input version of a layer is the run id in the ledger of the layer below, so a
slice that was redone there is pending here without any listing of files:

    silver_norm  --run id-->  silver_eda  --run id-->  gold states  -->  gold

Pending slices are written by one job.  If that job fails because of the data
of some slice, the slices are halved until the bad ones stand alone; any other
failure (a lost executor, no disk) is raised, not read as a bad slice.

Gold is maintained, not recomputed: a slice contributes mergeable partial states
(sum, count, min, max) per group; redoing a slice replaces its states only, and
gold is the merge of all states, whose number follows groups and slices.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LEDGER_SCHEMA = ("slice string, status string, rows bigint, written_at timestamp, run_id string, "
                 "input_version string, error string")

#: Error classes that name the data of a file or column as the cause.
DATA_ERRORS = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE", "FAILED_READ_FILE",
               "CANNOT_READ_FILE_FOOTER", "PARQUET_COLUMN_DATA_TYPE_MISMATCH", "PARQUET_TYPE_ILLEGAL",
               "CAST_INVALID_INPUT", "CAST_OVERFLOW", "CANNOT_PARSE_TIMESTAMP", "DIVIDE_BY_ZERO", "ARITHMETIC_OVERFLOW",
               "UNABLE_TO_INFER_SCHEMA", "UNRESOLVED_COLUMN", "DATATYPE_MISMATCH", "MALFORMED_RECORD", "COLUMN_ALREADY_EXISTS")


def data_error(exc: BaseException) -> str | None:
    """The error class, if the failure comes from the data; None for any other failure."""
    text = f"{exc.getCondition() or ''} {exc}" if isinstance(exc, PySparkException) else str(exc)
    return next((name for name in DATA_ERRORS if name in text), None)


def bisect(slices: list[str], work: Callable[[list[str]], None], on_error: str = "raise") -> dict[str, str]:
    """Run ``work`` on all slices at once; halve on a data error until the bad
    ones are found.  Returns {bad slice: error class}; ``"raise"`` fails fast.

    One bad slice among n costs about 2 log2(n) jobs, not n.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error must be raise or skip")
    if not slices:
        return {}
    try:
        work(slices)
        return {}
    except Exception as exc:
        cause = data_error(exc)
        if cause is None or on_error == "raise":
            raise
        if len(slices) == 1:
            return {slices[0]: cause}
    half = len(slices) // 2
    return bisect(slices[:half], work, on_error) | bisect(slices[half:], work, on_error)


# ---- ledger -------------------------------------------------------------------

def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a ledger; a missing one is empty."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except PySparkException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def latest(ledger: DataFrame) -> DataFrame:
    """The last successful row of each slice (``done`` or ``removed``)."""
    columns = [c for c in ledger.columns if c != "slice"]
    good = ledger.filter(F.col("status").isin("done", "removed"))
    last = F.max(F.struct("written_at", *[c for c in columns if c != "written_at"])).alias("r")
    return good.groupBy("slice").agg(last).select("slice", *[F.col(f"r.{c}").alias(c) for c in columns])


def append_ledger(spark: SparkSession, path: str, rows: list[tuple], run_id: str) -> None:
    """Append (slice, status, rows, input_version, error) rows of one run, after its data is committed."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    full = [(s, status, n, now, run_id, version, error) for s, status, n, version, error in rows]
    spark.createDataFrame(full, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def pending(inputs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Slices of ``inputs`` (slice, status, version) whose version this ledger hasn't taken in."""
    taken = latest(ledger).select("slice", F.col("input_version").alias("version"))
    return inputs.join(taken, ["slice", "version"], "left_anti")


def versions(ledger: DataFrame) -> DataFrame:
    """A ledger as the input of the layer above: (slice, status, version)."""
    return latest(ledger).select("slice", "status", F.col("run_id").alias("version"))


def delete_slices(spark: SparkSession, root: str, slices: list[str], slice_col: str = "slice") -> None:
    """Remove whole slice folders (their source is gone)."""
    jvm = spark.sparkContext._jvm
    for name in slices:
        at = jvm.org.apache.hadoop.fs.Path(f"{root}/{slice_col}={name}")
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


# ---- layers -------------------------------------------------------------------

def advance(spark: SparkSession, inputs: DataFrame, target: str, ledger_path: str,
            build: Callable[[list[str]], DataFrame], on_error: str = "skip",
            apart: Callable[[list[str]], list[list[str]]] | None = None) -> DataFrame:
    """Bring a layer up to date: rebuild its pending slices, drop removed ones.

    ``build`` gives the rows (with a ``slice`` column) of the named slices; they
    replace those slices of ``target``.  ``apart`` parts the pending slices into
    groups that are written one after the other (those likely to fail by themselves).
    Returns the run's ledger rows (slice,
    rows, status, error).  Only slice names and versions reach the driver.
    """
    from lakemart.operators.lake import write_slices
    todo = pending(inputs, read_ledger(spark, ledger_path)).collect()
    version = {r.slice: r.version for r in todo}
    gone = sorted(r.slice for r in todo if r.status == "removed")
    live = sorted(r.slice for r in todo if r.status != "removed")
    run_id = uuid.uuid4().hex
    bad = {}
    for group in apart(live) if apart and live else [live]:
        bad |= bisect(group, lambda names: write_slices(build(names), target), on_error)
    good = [s for s in live if s not in bad]
    delete_slices(spark, target, gone)
    counts = {}
    if good:
        try:
            written = spark.read.parquet(target).filter(F.col("slice").cast("string").isin(good))
            counts = {r.slice: r.n for r in written.groupBy(F.col("slice").cast("string").alias("slice"))
                      .agg(F.count(F.lit(1)).alias("n")).collect()}
        except PySparkException as exc:     # no slice has a row: nothing was ever written
            if exc.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
                raise
        # a slice that came out empty must not keep its former rows
        delete_slices(spark, target, [s for s in good if s not in counts])
    rows = ([(s, "done", counts.get(s, 0), version[s], None) for s in good]
            + [(s, "removed", 0, version[s], None) for s in gone]
            + [(s, "error", None, version[s], bad[s]) for s in sorted(bad)])
    if rows:
        append_ledger(spark, ledger_path, rows, run_id)
    return spark.createDataFrame([(s, n, status, e) for s, status, n, _, e in rows],
                                 "slice string, rows bigint, status string, error string")


# ---- mergeable states ---------------------------------------------------------

@dataclass(frozen=True)
class Measure:
    """One measure of a mart as partial states: count, sum, avg, min or max of ``value``."""

    kind: str
    value: Callable[[], Column] | None = None

    def parts(self, alias: str) -> dict[str, Column]:
        """State columns, aggregated over the rows of one slice and group."""
        if self.kind == "count":
            return {f"{alias}__n": F.count(F.lit(1) if self.value is None else self.value())}
        if self.kind == "avg":
            return {f"{alias}__s": F.sum(self.value()), f"{alias}__n": F.count(self.value())}
        return {f"{alias}__{self.kind}": getattr(F, self.kind)(self.value())}

    def merged(self, alias: str) -> Column:
        """The measure, from the states of all slices."""
        if self.kind == "count":
            return F.sum(f"{alias}__n")
        if self.kind == "avg":
            return F.try_divide(F.sum(f"{alias}__s"), F.sum(f"{alias}__n"))
        return (F.sum if self.kind == "sum" else getattr(F, self.kind))(f"{alias}__{self.kind}")


def column_measure(kind: str, name: str) -> Measure:
    return Measure(kind, lambda: F.col(name))


#: The gold trip cube (G1) as states.
CUBE_MEASURES = {
    "trip_count": Measure("count"),
    "total_revenue": column_measure("sum", "total_amount"),
    "avg_revenue": column_measure("avg", "total_amount"),
    "avg_duration": column_measure("avg", "trip_duration_minutes"),
    "avg_distance": column_measure("avg", "trip_distance"),
    "avg_speed": column_measure("avg", "avg_speed_kmh"),
    "avg_tip_ratio": column_measure("avg", "tip_ratio"),
    "tip_probability": Measure("avg", lambda: F.col("has_tip").cast("double")),
    "avg_passengers": column_measure("avg", "passenger_count"),
    "avg_efficiency": column_measure("avg", "revenue_per_minute"),
}


def partial_states(df: DataFrame, keys: list[str], measures: dict[str, Measure], slice_col: str = "slice") -> DataFrame:
    """One row per slice and group: partial states that ``merge_states`` adds up."""
    parts = {name: agg for alias, m in measures.items() for name, agg in m.parts(alias).items()}
    return df.groupBy(slice_col, *keys).agg(*[agg.alias(name) for name, agg in parts.items()])


def merge_states(states: DataFrame, keys: list[str], measures: dict[str, Measure]) -> DataFrame:
    """The mart: states of all slices merged by group."""
    return states.groupBy(*keys).agg(*[m.merged(alias).alias(alias) for alias, m in measures.items()])


# ---- the trip layers ----------------------------------------------------------

def incremental_eda(spark: SparkSession, norm_root: str, norm_ledger: DataFrame, eda_root: str, eda_ledger: str,
                    schema: StructType, bounds: dict, dims: dict[str, DataFrame], on_error: str = "skip") -> DataFrame:
    """Clean and enrich the slices of silver_norm that silver_eda hasn't taken
    in at their present version; a bad slice gets an ``error`` row and the others go on.

    ``norm_ledger``: (slice, status, version) of silver_norm.  The layer is read by
    its declared ``schema``, so a slice written with other types fails by itself.
    """
    from lakemart.operators import lake

    def build(names: list[str]) -> DataFrame:
        norm = spark.read.schema(schema).parquet(norm_root).filter(F.col("slice").isin(names))
        clean = lake.clean_trips(norm, bounds)
        enriched = lake.enrich_trips(clean, **dims)
        return enriched.select(*[c for c in lake.EDA_COLUMNS if c in enriched.columns], "slice")

    return advance(spark, norm_ledger, eda_root, eda_ledger, build, on_error,
                   apart=lambda names: lake.split_by_schema(spark, norm_root, names, schema))


def incremental_gold(spark: SparkSession, eda_root: str, eda_ledger: str, states_root: str, gold_ledger: str,
                     keys: list[str], measures: dict[str, Measure], on_error: str = "raise") -> DataFrame:
    """C11: states of the slices of silver_eda that gold hasn't taken in replace their former states."""
    def build(names: list[str]) -> DataFrame:
        eda = spark.read.parquet(eda_root).withColumn("slice", F.col("slice").cast("string"))
        return partial_states(eda.filter(F.col("slice").isin(names)), keys, measures)

    return advance(spark, versions(read_ledger(spark, eda_ledger)), states_root, gold_ledger, build, on_error)


def read_gold(spark: SparkSession, states_root: str, keys: list[str], measures: dict[str, Measure]) -> DataFrame:
    """The mart as of the last ``incremental_gold``."""
    return merge_states(spark.read.parquet(states_root), keys, measures)
