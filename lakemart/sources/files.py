"""File sources and sinks.

Thin, typed wrappers over ``spark.read`` / ``df.write``: they only assemble
options, so every read stays a lazy scan that Catalyst can prune and filter.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAVE_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


# ---- sources ----------------------------------------------------------------

def read_csv(spark: SparkSession, path, header: bool = True, infer: bool = False,
             schema: T.StructType | str | None = None, delimiter: str = ",",
             encoding: str = "UTF-8", null_value: str | None = None,
             mode: str = "PERMISSIVE", **options) -> DataFrame:
    """CSV with header, inferred or explicit schema, dialect options.

    ``path`` may be a file, a directory, a glob or a list of them.  Prefer an
    explicit schema at scale: inference is an extra pass over the data.
    """
    r = spark.read.option("header", header).option("delimiter", delimiter)\
        .option("encoding", encoding).option("mode", mode)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", infer)
    return r.options(**options).csv(path)


def schema_from_json(text: str) -> T.StructType:
    """A4: a schema saved as JSON (``df.schema.json()``) back to a StructType."""
    return T.StructType.fromJson(json.loads(text))


def read_csv_with_sidecar(spark: SparkSession, data_path: str, sidecar_path: str, **options) -> DataFrame:
    """A4: headerless CSV whose schema lives in a JSON sidecar text file.

    The sidecar is one small text row (O(columns)), read with Spark's text source.
    """
    text = "".join(r.value for r in spark.read.text(sidecar_path, wholetext=True).collect())
    return read_csv(spark, data_path, header=False, schema=schema_from_json(text), **options)


def read_parquet(spark: SparkSession, paths, merge_schema: bool = False, recursive: bool = False,
                 base_path: str | None = None) -> DataFrame:
    """Parquet by dir / file / glob / list, schema merge, recursive
    lookup, and ``basePath`` to keep partition columns of named partitions."""
    r = spark.read.format("parquet")
    if merge_schema:
        r = r.option("mergeSchema", "true")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if base_path:
        r = r.option("basePath", base_path)
    return r.load(paths if isinstance(paths, (list, tuple)) else [paths])


def read_select_filter(spark: SparkSession, path, columns: list[str] | None = None,
                       filters: str | None = None) -> DataFrame:
    """Read + optional projection + optional SQL filter (pushed to the scan)."""
    df = spark.read.parquet(path) if isinstance(path, str) else spark.read.parquet(*path)
    if columns:
        df = df.select(*columns)
    if filters:
        df = df.filter(filters)
    return df


def read_orc(spark: SparkSession, path) -> DataFrame:
    """A14."""
    return spark.read.orc(path)


def read_json_lines(spark: SparkSession, path, schema=None, **options) -> DataFrame:
    """JSON lines (compressed files and globs are fine)."""
    r = spark.read.option("multiLine", "false")
    if schema is not None:
        r = r.schema(schema)
    return r.options(**options).json(path)


PACK_BYTES = 32 << 20       # what one task parses of an unsplittable file


def pack_by_bytes(df: DataFrame, size: Column, keys: list[str], target: int = PACK_BYTES) -> DataFrame:
    """``df`` with ``pack``: rows dealt by hash of ``keys`` to as many packs as their
    bytes ask for, about ``target`` each.  Files that a task must read whole
    (multi-line JSON) then follow the data's bytes, not its number of records.

    ``size``: estimated bytes of a row; summed by one cheap aggregate of the input.
    """
    total = df.agg(F.sum(size)).first()[0] or 0
    return df.withColumn("pack", F.pmod(F.xxhash64(*keys), F.lit(max(1, math.ceil(total / target)))))


def write_json_arrays(docs: DataFrame, path: str, value: str = "value", pack: str = "pack") -> None:
    """One file per ``pack``: a top-level JSON array of its documents, which a
    multi-line scan reads back as one row per document."""
    arrays = docs.groupBy(pack).agg(F.array_join(F.collect_list(value), ",\n").alias("body"))
    (arrays.select(F.concat(F.lit("["), "body", F.lit("]")).alias("value"))
     .write.option("maxRecordsPerFile", 1).text(path))


def spread(df: DataFrame, partitions: int | None = None, *keys: str) -> DataFrame:
    """Repartition by number, by keys, or by both."""
    if partitions is None and not keys:
        raise ValueError("give a number of partitions, keys, or both")
    return df.repartition(*([partitions] if partitions else []), *keys)


def read_json_documents(spark: SparkSession, path, schema=None, encoding: str = "UTF-8") -> DataFrame:
    """Multi-line JSON, one document per file or a top-level array of them.
    A file is not splittable and is parsed by one task, so writers should
    bound files in bytes (``pack_by_bytes``, ``write_json_arrays``)."""
    r = spark.read.option("multiLine", "true").option("encoding", encoding)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_whole_text(spark: SparkSession, path) -> DataFrame:
    """One row per file (``value`` = whole file text)."""
    return spark.read.text(path, wholetext=True)


def read_lines(spark: SparkSession, path) -> DataFrame:
    """One row per line."""
    return spark.read.text(path)


def source_files(df: DataFrame) -> DataFrame:
    """Which files a file-based DataFrame reads, with row counts."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("rows"))


# ---- sinks ------------------------------------------------------------------

def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "snappy",
                  partition_by: list[str] | None = None, dynamic: bool = True,
                  block_size: int | None = None, page_size: int | None = None,
                  dictionary: bool | None = None, bloom_columns: list[str] | None = None,
                  max_records_per_file: int | None = None) -> None:
    """Parquet with codec, row-group/page size, dictionary, bloom
    filters per column, partitioning with dynamic partition overwrite.

    No ``coalesce(1)``: file sizes follow the partitioning (AQE sizes the
    shuffle partitions); ``max_records_per_file`` caps very large files.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}")
    if partition_by:
        # Cluster rows by partition value (few, large files per folder); AQE
        # splits a skewed partition value over several tasks.
        df = df.hint("rebalance", *partition_by)
    w = _parquet_options(df.write.mode(mode).option("compression", compression),
                         block_size, page_size, dictionary, bloom_columns, max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
        if dynamic:
            w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def _parquet_options(w, block_size, page_size, dictionary, bloom_columns, max_records_per_file):
    if block_size:
        w = w.option("parquet.block.size", str(block_size))
    if page_size:
        w = w.option("parquet.page.size", str(page_size))
    if dictionary is not None:
        w = w.option("parquet.enable.dictionary", str(dictionary).lower())
    for c in bloom_columns or []:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    return w


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              delimiter: str = ",", quote: str = '"', escape: str = "\\", null_value: str = "",
              date_format: str = "yyyy-MM-dd", timestamp_format: str = "yyyy-MM-dd HH:mm:ss",
              compression: str | None = None) -> None:
    """CSV with the full dialect."""
    w = (df.write.mode(mode).option("header", header).option("delimiter", delimiter)
         .option("quote", quote).option("escape", escape).option("nullValue", null_value)
         .option("dateFormat", date_format).option("timestampFormat", timestamp_format))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def write_schema_sidecar(spark: SparkSession, df: DataFrame, path: str) -> None:
    """The schema as JSON text next to the data (one small text file)."""
    spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_orc(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """B6."""
    df.write.mode(mode).format("orc").save(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """JSON lines."""
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A single string column as text lines."""
    df.write.mode(mode).text(path)
