"""JDBC option builders, idempotent stream sink, ML helpers, plan facts."""

import pytest
from pyspark.sql import functions as F

from lakemart.operators import ml
from lakemart.plans import catalog as cat
from lakemart.session import scratch_path
from lakemart.sources import jdbc
from lakemart.streaming import stream as ss


def test_jdbc_dispatch_and_options():
    conn = jdbc.connection("jdbc:postgresql://db:5432/x", "u", "p")
    assert conn["driver"] == "org.postgresql.Driver"
    assert jdbc.is_query("  WITH t AS (SELECT 1) SELECT * FROM t") and not jdbc.is_query("schema.selections")
    o = jdbc.read_options("SELECT id FROM t", conn, partition_column="id", lower=1, upper=100, num_partitions=4)
    assert o["dbtable"].startswith("(SELECT id FROM t) AS q") and o["numPartitions"] == "4"
    assert jdbc.read_options("nyc.list_vendor", conn, fetchsize=1000)["fetchsize"] == "1000"
    with pytest.raises(ValueError):
        jdbc.read_options("t", conn, partition_column="id")
    with pytest.raises(ValueError):
        jdbc.write_options("t", conn, lowerBound=1)
    assert jdbc.write_options("t", conn, batchsize=10000, truncate=True)["truncate"] == "true"


def test_idempotent_sink_replay(spark):
    out = scratch_path(spark, "sink")
    sink = ss.idempotent_sink(out)
    batch = spark.range(5)
    sink(batch, 7)
    sink(batch, 7)  # re-delivered batch
    sink(spark.range(3), 8)
    assert spark.read.parquet(out).count() == 8


def test_class_metrics_match_spark_evaluator(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (1.0, 0.0), (0.0, 0.0), (1.0, 1.0)],
                               "label double, prediction double")
    mine = ml.class_metrics(df).first()
    theirs = ml.multiclass_metrics(df)
    assert abs(mine.accuracy - theirs["accuracy"]) < 1e-12
    assert abs(mine.weighted_precision - theirs["weightedPrecision"]) < 1e-12
    assert abs(mine.weighted_recall - theirs["weightedRecall"]) < 1e-12
    assert abs(mine.f1 - theirs["f1"]) < 1e-12


def test_feature_importances_use_vector_metadata(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("b", 2.0, 1.0), ("c", 3.0, 1.0), ("a", 4.0, 0.0)] * 5,
                               "cat string, x double, label double")
    model = ml.build_pipeline(["cat"], ["x"], ml.rf_classifier("label", trees=3, depth=2)).fit(df)
    imp = ml.feature_importances(spark, model.stages[-1], model.transform(df))
    names = [r.feature for r in imp.collect()]
    assert len(names) == len(model.stages[-1].featureImportances) and "x" in names


def test_hash_split_is_deterministic(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = ml.hash_split(df, "k").filter("split = 'train'").count()
    b = ml.hash_split(df, "k").filter("split = 'train'").count()
    assert a == b and 600 < a < 800


def test_plan_pushdown_and_pruning(spark, sf):
    from lakemart.plans.q_sources import read_select_filter
    rep = cat.plan_report(read_select_filter(spark, sf))
    assert any("GreaterThan(l_quantity,45" in f for f in rep["pushed_filters"])
    assert rep["read_schema"] == ["struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>"]


def test_flagship_plan_has_no_cartesian_and_no_python(spark, sf):
    import __spark_entry__ as entry
    rep = cat.plan_report(entry.queries()["mart_trip_cube"](spark, sf))
    assert rep["nested_loop_joins"] == 0 and rep["python_udfs"] == 0
    assert rep["codegen_stages"] > 0


def test_event_trip_marts_never_shuffle_on_a_code_list_key(spark, sf):
    """Code-list dimensions (vendor, rate code, payment) are broadcast: the
    fact is shuffled only for its group-by, never on a few-value join key."""
    import __spark_entry__ as entry
    for name in ("mart_hourly", "mart_time_of_day", "trips_eda"):
        plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan, name
        assert "hashpartitioning(vendorid" not in plan, name


def test_group_aggregates_join_back_alike_however_the_join_is_planned(spark, sf):
    """Per-group aggregates are joined without a hint: Spark's size check picks
    the join, and with broadcasts off the rows are the same."""
    import __spark_entry__ as entry
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for name in ("sql03_above_avg_join", "sql03_above_avg_semi", "sql04_dept_avg", "above_group_avg"):
        small = sorted(map(str, entry.queries()[name](spark, sf).collect()))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            df = entry.queries()[name](spark, sf)
            assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString(), name
            assert sorted(map(str, df.collect())) == small, name
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_snapshot_time_travel(spark):
    t = cat.SnapshotTable(spark, scratch_path(spark, "snap"))
    t.commit(spark.range(3), "append")
    t.commit(spark.range(2), "append")
    t.commit(spark.range(10), "overwrite")
    assert t.read(2).count() == 5 and t.read(3).count() == 10 and t.read().count() == 10
    assert [r.operation for r in t.history().orderBy("version").collect()] == ["append", "append", "overwrite"]


def test_regressors_and_metrics_agree_with_spark(spark, sf):
    from lakemart.session import table
    li = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_extendedprice")
    data = ml.assembler(["l_quantity", "l_discount"]).transform(li)
    for model in (ml.gbt_regressor("l_extendedprice", iters=5, depth=3),
                  ml.rf_regressor("l_extendedprice", trees=5, depth=4)):
        pred = model.fit(data).transform(data)
        mine = ml.regression_metrics(pred, "l_extendedprice").first()
        theirs = ml.regression_metrics_eval(pred, "l_extendedprice")
        for k in ("rmse", "mse", "mae", "r2"):
            assert abs(mine[k] - theirs[k]) <= 1e-6 * max(1.0, abs(theirs[k]))


def test_gbt_classifier_binary_metrics(spark, sf):
    from lakemart.plans.q_ml import labeled
    data = labeled(spark, sf).drop("prediction").withColumn("label", F.col("label").cast("double"))
    model = ml.build_pipeline(["lang"], ["n_chars", "toxic"], ml.gbt_classifier("label", iters=5, depth=3)).fit(data)
    m = ml.binary_metrics(model.transform(data))
    assert 0.0 <= m["areaUnderROC"] <= 1.0 and 0.0 <= m["areaUnderPR"] <= 1.0

