"""Scans and sinks over the testdata (§2 A, B).  Writes go to the shared
scratch area (``spark.checkpoint.dir``) and are read back by the scan under
test; every query covers the whole table it starts from."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.plans.registry import query
from lakemart.session import scratch_path, table
from lakemart.sources import files as fs


def _path(sf, name):
    return f"{sf}/{name}.parquet"


@query("scan_parquet", sql="""
SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL""")
def scan_parquet(spark, sf):
    """Parquet scan of a file; only two columns reach the reader."""
    li = fs.read_parquet(spark, _path(sf, "lineitem"))
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


@query("read_select_filter", sql="""
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 45""")
def read_select_filter(spark, sf):
    """Projection + filter helper; both are pushed into the scan."""
    return fs.read_select_filter(spark, _path(sf, "lineitem"), ["l_orderkey", "l_partkey", "l_quantity"],
                                 "l_quantity > 45")


def _orders_by_status(spark, sf):
    root = scratch_path(spark, "orders-by-status")
    fs.write_parquet(table(spark, sf, "orders"), root, partition_by=["o_orderstatus"])
    return root


@query("scan_multi_path", sql="""
SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY ALL""")
def scan_multi_path(spark, sf):
    """One scan over a list of globs."""
    root = _orders_by_status(spark, sf)
    df = fs.read_parquet(spark, [f"{root}/o_orderstatus=F/*.parquet", f"{root}/o_orderstatus=O/*.parquet"])
    return df.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("scan_merge_schema", sql="""
SELECT event_id, user_id, value, props, NULL::VARCHAR AS source FROM events WHERE ts < TIMESTAMP '2024-01-15'
UNION ALL
SELECT event_id, user_id, value, NULL, 'v2' FROM events WHERE ts >= TIMESTAMP '2024-01-15'""")
def scan_merge_schema(spark, sf):
    """Slices with drifting columns, read with mergeSchema (recursive lookup)."""
    root = scratch_path(spark, "drifting")
    e = table(spark, sf, "events").select("event_id", "user_id", "value", "props", "ts")
    e.filter(F.col("ts") < "2024-01-15").drop("ts").write.parquet(f"{root}/a")
    (e.filter(F.col("ts") >= "2024-01-15").drop("ts", "props").withColumn("source", F.lit("v2"))
     .write.parquet(f"{root}/b"))
    return fs.read_parquet(spark, root, merge_schema=True, recursive=True)


@query("scan_partition_pruned", sql="""
SELECT year(o_orderdate) AS year, count(*) AS n FROM orders
WHERE year(o_orderdate) >= 1998 AND month(o_orderdate) = 6 GROUP BY ALL""")
def scan_partition_pruned(spark, sf):
    """Hive-partitioned write; the filter prunes folders at planning."""
    root = scratch_path(spark, "orders-ym")
    o = table(spark, sf, "orders").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    fs.write_parquet(o, root, partition_by=["year", "month"])
    df = spark.read.parquet(root).filter("year >= 1998 AND month = 6")
    return df.groupBy(F.col("year").cast("bigint").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query("scan_new_partitions", sql="""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n FROM events
WHERE CAST(ts AS DATE) IN (DATE '2024-01-15', DATE '2024-01-16') GROUP BY ALL""")
def scan_new_partitions(spark, sf):
    """Read only named partition folders; basePath keeps the partition column."""
    root = scratch_path(spark, "events-by-day")
    e = table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    fs.write_parquet(e, root, partition_by=["day"])
    # An explicit schema types the partition column (no session-wide switch).
    schema = e.schema
    df = (spark.read.schema(schema).option("basePath", root)
          .parquet(f"{root}/day=2024-01-15", f"{root}/day=2024-01-16"))
    return df.groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query("orc_roundtrip", sql="SELECT * FROM customer")
def orc_roundtrip(spark, sf):
    """ORC write and read."""
    path = scratch_path(spark, "customer-orc")
    fs.write_orc(table(spark, sf, "customer"), path)
    return fs.read_orc(spark, path)


@query("csv_sidecar_roundtrip", sql="SELECT * FROM part")
def csv_sidecar_roundtrip(spark, sf):
    """Headerless CSV plus a JSON schema sidecar, read back typed."""
    data = scratch_path(spark, "part-csv")
    side = scratch_path(spark, "part-schema")
    p = table(spark, sf, "part")
    fs.write_csv(p, data, header=False)
    fs.write_schema_sidecar(spark, p, side)
    return fs.read_csv_with_sidecar(spark, data, side)


@query("parquet_roundtrip", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS price_cents FROM lineitem GROUP BY ALL""")
def parquet_roundtrip(spark, sf):
    """B1/B2: tuned Parquet write (codec, row group, page, dictionary, bloom) and read."""
    path = scratch_path(spark, "lineitem-tuned")
    fs.write_parquet(table(spark, sf, "lineitem"), path, block_size=64 * 1024 * 1024,
                     page_size=1024 * 1024, dictionary=True, bloom_columns=["l_orderkey"])
    li = spark.read.parquet(path)
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("price_cents"))


@query("partitioned_write_prune", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem
WHERE l_returnflag <> 'R' OR l_quantity > 25 GROUP BY ALL""")
def partitioned_write_prune(spark, sf):
    """Partitioned write, then a dynamic overwrite that replaces one
    partition only; the other partitions are untouched."""
    path = scratch_path(spark, "lineitem-parts")
    li = table(spark, sf, "lineitem")
    fs.write_parquet(li, path, partition_by=["l_returnflag", "l_linestatus"])
    fs.write_parquet(li.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25)), path,
                     partition_by=["l_returnflag", "l_linestatus"], dynamic=True)
    df = spark.read.parquet(path)
    return df.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("list_source_files")
def list_source_files(spark, sf):
    """A19 (rows-only): the files behind a scan, with their row counts."""
    path = scratch_path(spark, "orders-files")
    fs.write_parquet(table(spark, sf, "orders"), path, max_records_per_file=2000)
    return fs.source_files(spark.read.parquet(path))


@query("range_group_count", sql="""
SELECT l_orderkey % 1000 AS key, count(*) AS n, CAST(sum(l_orderkey * 2) AS BIGINT) AS value_sum FROM lineitem GROUP BY 1""")
def range_group_count(spark, sf):
    """id/value rows (selectExpr), group-count by key; the aggregate
    combines map-side before its own shuffle, so a hot key sends one row a task."""
    ids = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"))
    rows = ids.selectExpr("id", "id * 2 AS value", "id % 1000 AS key")
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value_sum"))


@query("csv_scan", sql="""
SELECT o_orderstatus, count(*) AS n, count(o_comment) AS n_comment,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS o_comment FROM orders)
GROUP BY ALL""")
def csv_scan(spark, sf):
    """CSV written with a full dialect (';', quotes, NULL marker,
    date formats, gzip), then read back three ways: header + inferred schema,
    explicit schema, and a glob over the part files."""
    path = scratch_path(spark, "orders-csv")
    o = (table(spark, sf, "orders")
         .withColumn("o_comment", F.when(F.col("o_orderkey") % 10 == 0, F.lit(None))
                     .otherwise(F.col("o_orderpriority"))))
    fs.write_csv(o, path, delimiter=";", null_value="NA", compression="gzip")
    inferred = fs.read_csv(spark, path, header=True, infer=True, delimiter=";", null_value="NA")
    explicit = fs.read_csv(spark, f"{path}/*.csv.gz", header=True, schema=o.schema, delimiter=";",
                           null_value="NA")
    # Both reads must agree; the explicit-schema one feeds the aggregate.
    assert inferred.columns == explicit.columns
    return explicit.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.count("o_comment").alias("n_comment"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))


@query("direct_file_sql", sql="""
SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL""")
def direct_file_sql(spark, sf):
    """K9: SQL straight over a file path (no table registration)."""
    return spark.sql(f"""SELECT o_orderpriority, count(*) AS n FROM parquet.`{_path(sf, 'orders')}`
                         WHERE o_orderstatus = 'O' GROUP BY o_orderpriority""")
