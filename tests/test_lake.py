"""Slices, manifest, standardisation and the incremental driver."""

from pyspark.sql import functions as F

from lakemart.operators import lake
from lakemart.session import scratch_path


def test_slice_key_ignores_part_file_uuids(spark):
    paths = ["s3a://bronze/yellow_tripdata_2025-01.parquet",
             "s3a://bronze/yellow_tripdata_2024-12/part-00000-8f3e1234-5678-4abc.parquet",
             "file:/x/2023-01-01/slice=2025-03/part-00001-1234-56ab.parquet",
             "file:/x/part-00000-1234-5678-9999.parquet"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(lake.slice_key("p")).collect()] == ["2025-01", "2024-12", "2025-03", None]


def test_standardize_lowercases_casts_and_orders(spark):
    df = spark.createDataFrame([("1", "x", 2.5, "3"), (None, "y", None, "bad")],
                               "VendorID string, store_and_fwd_flag string, Fare_Amount double, Payment_Type string")
    out = lake.standardize(df)
    assert out.columns == ["vendorid", "store_and_fwd_flag", "payment_type", "fare_amount"]
    assert [tuple(r) for r in out.collect()] == [(1, "x", 3, 2.5), (0, "y", 0, 0.0)]
    full = lake.standardize(df, add_missing=True)
    assert full.columns == lake.TRIP_COLUMNS


def test_incremental_is_replay_safe(spark):
    root = scratch_path(spark, "t-bronze")
    silver = scratch_path(spark, "t-silver")
    manifest = scratch_path(spark, "t-manifest")
    df = spark.range(40).select(
        (F.col("id") % 3 + 1).cast("int").alias("VendorID"),
        F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(id % 2 * 40, 0, 0, 0)")
        .alias("tpep_pickup_datetime"),
        F.lit(1.0).alias("fare_amount"))
    df = df.withColumn("slice", F.date_format("tpep_pickup_datetime", "yyyy-MM"))
    lake.write_slices(df, root)
    first = lake.incremental_normalize(spark, root, silver, manifest)
    assert sorted((r.slice, r.rows) for r in first.collect()) == [("2025-01", 20), ("2025-02", 20)]
    again = lake.incremental_normalize(spark, root, silver, manifest)
    assert again.count() == 0
    assert spark.read.parquet(silver).count() == 40


def test_late_file_of_a_done_slice_is_read(spark):
    root, silver, manifest = (scratch_path(spark, n) for n in ("t-late-bronze", "t-late-silver", "t-late-manifest"))
    df = spark.range(20).select((F.col("id") % 3 + 1).cast("int").alias("VendorID"), F.lit(1.0).alias("fare_amount"),
                                F.concat(F.lit("2025-0"), F.col("id") % 2 + 1).alias("slice"))
    lake.write_slices(df, root)
    assert lake.incremental_normalize(spark, root, silver, manifest).count() == 2
    df.filter("slice = '2025-01'").limit(5).drop("slice").coalesce(1).write.mode("append").parquet(f"{root}/slice=2025-01")
    late = lake.incremental_normalize(spark, root, silver, manifest)
    assert [(r.slice, r.rows, r.status) for r in late.collect()] == [("2025-01", 15, "done")]
    assert spark.read.parquet(silver).count() == 25
    assert lake.incremental_normalize(spark, root, silver, manifest).count() == 0


def test_clean_report_single_pass(spark):
    df = spark.createDataFrame([(1,), (5,), (9,)], "passenger_count int").withColumns({
        "tpep_pickup_datetime": F.expr("timestamp_ntz'2024-01-01 00:00:00'"),
        "tpep_dropoff_datetime": F.expr("timestamp_ntz'2024-01-01 00:10:00'")})
    r = lake.clean_report(df, {"passenger_count": (0, 6, True, True)}).first()
    assert (r.rows_before, r.rows_after, r.rows_removed) == (3, 2, 1)
