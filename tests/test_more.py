"""Stream status, catalog DDL/statistics, lake re-runs and error handling."""

import os
import uuid

from pyspark.sql import functions as F

from lakemart.operators import lake
from lakemart.operators import profile as pf
from lakemart.plans import catalog as cat
from lakemart.session import scratch_path
from lakemart.streaming import stream as ss


def test_stream_progress_tables(spark):
    src = scratch_path(spark, "s-src")
    spark.range(30).withColumn("v", F.col("id") * 2).repartition(3).write.parquet(src)
    q = (spark.readStream.schema("id bigint, v bigint").option("maxFilesPerTrigger", 1).parquet(src)
         .writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "s-ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    status = ss.quick_status(q)
    assert status["total_rows"] == 30 and status["batch_id"] is not None
    prog = ss.progress_table(spark, q)
    assert prog.agg(F.sum("rows")).first()[0] == 30


def test_catalog_describe_and_analyze(spark):
    ns = "lakemart_t"
    cat.create_namespace(spark, ns, scratch_path(spark, "ns"))
    name = f"{ns}.t_{uuid.uuid4().hex[:8]}"
    cat.create_table(spark, name, "id BIGINT, d DATE", location=scratch_path(spark, "tbl"),
                     partitioned_by=["d"])
    spark.sql(f"INSERT INTO {name} VALUES (1, DATE'2024-01-01'), (2, DATE'2024-01-02')")
    cat.analyze(spark, name)
    rows = {r.col_name: r.data_type for r in cat.describe(spark, name).collect()}
    assert rows["id"] == "bigint" and "Statistics" in rows
    assert spark.sql(f"SHOW NAMESPACES LIKE '{ns}'").count() == 1


def test_incremental_full_rerun_and_skip_on_error(spark):
    root = scratch_path(spark, "e-bronze")
    silver = scratch_path(spark, "e-silver")
    manifest = scratch_path(spark, "e-manifest")
    df = spark.range(10).select(F.col("id").cast("int").alias("VendorID"),
                                F.lit("2025-05").alias("slice"))
    lake.write_slices(df, root)
    assert lake.incremental_normalize(spark, root, silver, manifest).count() == 1
    assert lake.incremental_normalize(spark, root, silver, manifest).count() == 0
    full = lake.incremental_normalize(spark, root, silver, manifest, full=True).collect()
    assert [(r.slice, r.rows) for r in full] == [("2025-05", 10)]
    # a corrupt file in a new slice: "skip" reports it, "raise" fails fast
    bad = os.path.join(root.removeprefix("file:"), "slice=2025-06")
    os.makedirs(bad, exist_ok=True)
    with open(os.path.join(bad, "part-00000-bad.parquet"), "wb") as fh:
        fh.write(b"not parquet")
    skipped = lake.incremental_normalize(spark, root, silver, manifest, on_error="skip").collect()
    assert skipped[0].slice == "2025-06" and skipped[0].status.startswith("error")
    try:
        lake.incremental_normalize(spark, root, silver, manifest, on_error="raise").collect()
        raised = False
    except Exception:
        raised = True
    assert raised


def test_file_name_and_schema_drift(spark):
    df = spark.createDataFrame([("s3a://b/x/yellow_2025-01.parquet",), ("s3a://b/x/yellow_2025-02/",)], "p string")
    assert [r[0] for r in df.select(lake.file_name("p")).collect()] == ["yellow_2025-01", "yellow_2025-02"]
    a, b = scratch_path(spark, "d-a"), scratch_path(spark, "d-b")
    spark.range(3).withColumn("x", F.lit(1)).write.parquet(a)
    spark.range(3).withColumn("x", F.lit(1.5)).withColumn("y", F.lit("n")).write.parquet(b)
    got = {(r.column_name, r.slice): r.type for r in pf.schema_drift(spark, {"a": a, "b": b}).collect()}
    assert got[("x", "a")] == "int" and got[("x", "b")] == "double" and got[("y", "a")] is None


def test_describe_and_profiles(spark):
    from lakemart.session import PROFILES
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    rows = {r.summary: r.x for r in pf.describe(df).collect()}
    assert rows["count"] == "3" and float(rows["mean"]) == 2.0
    assert {"local", "cluster", "tuned", "streaming"} <= set(PROFILES)


def test_nested_helpers(spark):
    from lakemart.functions import nested as nx
    df = spark.createDataFrame([('["a", "b"]',), ("plain",), ("[note] kept",)], "t string")
    assert [r[0] for r in df.select(nx.text_of("t")).collect()] == ["ab", "plain", "[note] kept"]
    arr = spark.createDataFrame([([],), (["x", "y"],), (None,)], "a array<string>")
    assert [r[0] for r in arr.select(nx.first_or_null("a")).collect()] == [None, "x", None]
    doc = spark.createDataFrame(
        [(1, [([5.0, 6.0], 1.0)], 2.0)],
        "id int, items array<struct<sub: array<double>, price: double>>, price double")
    # $..price: top-level and inside the array of structs
    got = sorted(r.price for r in nx.deep_values(doc, "price", ["id"]).collect())
    assert got == [1.0, 2.0]
    nested = spark.createDataFrame([(1, [[{"price": 3.0}], [{"price": 4.0}]])],
                                   "id int, lv array<array<struct<price: double>>>")
    assert sorted(r.price for r in nx.deep_values(nested, "price", ["id"]).collect()) == [3.0, 4.0]


def test_deep_values_variant_heterogeneous(spark):
    from lakemart.functions import nested as nx
    docs = spark.createDataFrame([
        (1, '{"store": {"items": [{"price": 50}, {"price": 100}]}, "cart": {"products": [{"price": 75}], '
            '"total": 225}, "sale": {"price": 50}, "price": 100}'),
        (2, '[{"a": [[{"price": 1.5}]]}, {"price": "n/a"}, 3]'),
        (3, '{"nothing": true}'),
    ], "id int, j string")
    got = sorted((r.id, r.price) for r in nx.deep_values_variant(spark, docs, ["id"], "j", "price").collect())
    assert got == [(1, 50.0), (1, 50.0), (1, 75.0), (1, 100.0), (1, 100.0), (2, 1.5)]


def test_stream_restart_is_exactly_once(spark, sf):
    from lakemart.plans import q_stream as qs
    src = scratch_path(spark, "r-topic")
    out = scratch_path(spark, "r-out")
    ckpt = scratch_path(spark, "r-ckpt")
    rows = qs.topic_rows(spark, sf)
    first, second = rows.filter(F.col("offset") % 2 == 0), rows.filter(F.col("offset") % 2 == 1)
    first.write.mode("append").parquet(src)
    ev, gr = qs._dims(spark)

    def run():
        stream = spark.readStream.schema(rows.schema).parquet(src)
        q = (ss.enrich(ss.decode(stream), ev, gr).writeStream.option("checkpointLocation", ckpt)
             .foreachBatch(ss.idempotent_sink(out)).trigger(availableNow=True).start())
        q.awaitTermination()
        return q

    run()
    n1 = spark.read.parquet(out).count()
    q = run()                                   # restart: nothing new
    assert spark.read.parquet(out).count() == n1
    second.write.mode("append").parquet(src)    # new files arrive
    run()
    got = spark.read.parquet(out)
    assert got.count() == rows.count() == got.select("key").distinct().count()
