"""Cases that clean oracle data hides: missing objects, null groups, text numbers, depth, fresh listings."""

import os

import pytest
from pyspark.sql import functions as F

from lakemart.functions import features as fx
from lakemart.functions.nested import deep_values
from lakemart.operators import enrich, lake, profile, windows
from lakemart.plans import catalog as cat
from lakemart.session import scratch_path


def test_deep_values_keep_documents_without_a_path(spark):
    df = spark.read.json(spark.sparkContext.parallelize([
        '{"id": 1, "store": {"price": 5.0}}', '{"id": 2, "store": {"price": 7.0}, "cart": {"items": [{"price": 1.0}]}}']))
    assert sorted((r.id, r.price) for r in deep_values(df, "price", ["id"]).collect()) == [(1, 5.0), (2, 1.0), (2, 7.0)]
    assert deep_values(df, "absent", ["id"]).count() == 0


def test_typed_coalesce_reads_decimal_text(spark):
    df = spark.createDataFrame([("1.0",), ("7",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(fx.typed_coalesce("s", "int")).collect()] == [1, 7, 0, 0]


def test_group_averages_with_nulls(spark):
    df = spark.createDataFrame([(None, 2.0), (None, 4.0), ("a", 10.0), ("a", None)], "g string, v double")
    got = sorted((str(r.g), r.a) for r in windows.with_group_average(df, "g", "v", "a").collect())
    assert got == [("None", 3.0), ("None", 3.0), ("a", 10.0), ("a", 10.0)]
    fine = spark.createDataFrame([("x", 1, 8.0), ("x", 1, None), ("x", 2, 8.5)], "c string, f int, v double")
    rows = enrich.above_group_average(fine, ["c", "f"], ["c"], "v").collect()
    assert [(r.f, r.group_avg) for r in rows] == [(2, 8.25)]


def test_iqr_of_a_column_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 90.0)], "a double, b double")
    bounds = profile.iqr_bounds(spark, df, ["a", "b"])
    assert bounds.filter("column_name = 'a'").first().q1 is None
    assert profile.iqr_outliers(df, bounds).count() == 2


def test_hierarchy_by_levels(spark):
    rows = [(i, i - 1 if i else None, f"n{i}") for i in range(12)] + [(1000, 2000, "orphan")]
    out = windows.hierarchy(spark, spark.createDataFrame(rows, "id int, parent_id int, name string"))
    got = {r.id: (r.level, r.path) for r in out.collect()}
    assert got == {i: (i + 1, " -> ".join(f"n{k}" for k in range(i + 1))) for i in range(12)}


def test_table_sees_appended_files(spark, tmp_path):
    from lakemart.session import table
    path = str(tmp_path / "t.parquet")
    spark.range(5).write.parquet(path)
    assert table(spark, str(tmp_path), "t").count() == 5
    spark.range(5).write.mode("append").parquet(path)
    assert table(spark, str(tmp_path), "t").count() == 10


def test_bad_dates_do_not_stop_the_decoder(spark):
    from lakemart.streaming import stream
    rows = [("k", '{"id": 1, "date": "nonsense", "event_date": "also", "event_id": 1}', "t", 0, 1)]
    df = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long")
    r = stream.decode(df).first()
    assert (r.id, r.date, r.event_date) == (1, None, None)


def test_bad_slice_is_skipped_and_types_may_drift(spark):
    root, silver, manifest = (scratch_path(spark, f"drift-{x}") for x in ("bronze", "silver", "manifest"))
    for month, kind in (("2025-01", "bigint"), ("2025-02", "double")):
        (spark.range(4).select(F.col("id").cast("int").alias("VendorID"), F.lit(2).cast(kind).alias("passenger_count"))
         .write.parquet(f"{root}/slice={month}"))
    bad = os.path.join(root.removeprefix("file:"), "slice=2025-03")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-00000-bad.parquet"), "wb") as fh:
        fh.write(b"not parquet")
    got = {r.slice: (r.rows, r.status[:5]) for r in
           lake.incremental_normalize(spark, root, silver, manifest, on_error="skip").collect()}
    assert got == {"2025-01": (4, "done"), "2025-02": (4, "done"), "2025-03": (None, "error")}
    assert {r[0] for r in spark.read.parquet(silver).select("passenger_count").collect()} == {2}


def test_snapshot_keeps_added_columns_and_rejects_unknown_versions(spark):
    t = cat.SnapshotTable(spark, scratch_path(spark, "snap-drift"))
    t.commit(spark.range(2))
    t.commit(spark.range(3).withColumn("extra", F.lit("x")))
    assert t.read().filter("extra IS NULL").count() == 2 and t.read(1).count() == 2
    for version in (0, 99):
        with pytest.raises(ValueError):
            t.read(version)


def test_plan_report_counts_each_operator_once(spark):
    assert cat.plan_report(spark.range(10).groupBy("id").count().select("count"))["exchanges"] <= 1
    assert cat.plan_report(spark.range(10).repartition(3, "id"))["exchanges"] == 1
