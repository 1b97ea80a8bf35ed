"""Layers, skew joins, commits, progress reports, packs and small survey gaps."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakemart.functions import nested as nx
from lakemart.operators import clean, enrich, lake, layers, ml, skew
from lakemart.plans import catalog as cat
from lakemart.plans import q_nested
from lakemart.session import scratch_path
from lakemart.sources import connectors, files, jdbc
from lakemart.streaming import commits, progress, stream

DRIFT = ["1.5 AS fare_amount, 1 AS passenger_count", "'2.5' AS fare_amount, 1 AS passenger_count",
         "CAST(3 AS BIGINT) AS fare_amount, 'x' AS passenger_count"]


class DataFault(RuntimeError):
    pass


# ---- layers -------------------------------------------------------------------

def test_bisect_finds_bad_slices_in_few_jobs():
    calls = []

    def work(names):
        calls.append(len(names))
        if {"s17", "s40"} & set(names):
            raise DataFault("[FAILED_READ_FILE.CANNOT_READ_FILE_FOOTER] bad page")
    names = [f"s{i:02d}" for i in range(64)]
    assert set(layers.bisect(names, work, "skip")) == {"s17", "s40"}
    assert len(calls) <= 2 * 2 * 6 + 1
    with pytest.raises(DataFault):
        layers.bisect(names, work, "raise")


def test_bisect_raises_what_no_slice_has_caused():
    def work(names):
        raise RuntimeError("ExecutorLostFailure (executor 3 exited)")
    with pytest.raises(RuntimeError):
        layers.bisect(["a", "b"], work, "skip")


def _bronze(spark, months=12):
    root = scratch_path(spark, "r3-bronze")
    for i in range(months):
        (spark.range(4).selectExpr("CAST(id AS INT) AS VendorID", *DRIFT[i % 3].split(", "))
         .coalesce(1).write.parquet(f"{root}/slice=2024-{i + 1:02d}"))
    return root


def test_three_schemas_in_many_slices_are_one_write(spark, monkeypatch):
    root, silver, manifest = _bronze(spark), scratch_path(spark, "r3-silver"), scratch_path(spark, "r3-manifest")
    writes = []
    write = lake.write_slices
    monkeypatch.setattr(lake, "write_slices", lambda *a, **k: (writes.append(1), write(*a, **k)))
    paths = [r.path for r in lake.list_candidates(spark, root).collect()]
    assert len(lake.schema_groups(spark, paths)) == 3
    done = lake.incremental_normalize(spark, root, silver, manifest)
    assert sorted((r.slice, r.rows, r.status) for r in done.collect()) == [(f"2024-{i:02d}", 4, "done") for i in range(1, 13)]
    assert len(writes) == 1
    fares = {(r.slice, r.fare_amount) for r in spark.read.parquet(silver).select(F.col("slice").cast("string"), "fare_amount").collect()}
    assert fares == {(f"2024-{i + 1:02d}", (1.5, 2.5, 3.0)[i % 3]) for i in range(12)}


def test_unreadable_file_is_skipped_and_removed_slices_go(spark):
    root, silver, manifest = _bronze(spark, 4), scratch_path(spark, "r3-silver"), scratch_path(spark, "r3-manifest")
    spark.range(3).select(F.col("id").cast("string").alias("value")).coalesce(1).write.text(f"{root}/junk")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(conf)
    junk = [s.getPath() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/junk")) if s.getPath().getName().startswith("part")]
    fs.rename(junk[0], jvm.org.apache.hadoop.fs.Path(f"{root}/slice=2024-02/part-x.parquet"))
    status = {r.slice: r.status.split(":")[0] for r in lake.incremental_normalize(
        spark, root, silver, manifest, on_error="skip").collect()}
    assert status == {"2024-01": "done", "2024-02": "error", "2024-03": "done", "2024-04": "done"}
    layers.delete_slices(spark, root, ["2024-03"])
    again = {r.slice: r.status.split(":")[0] for r in lake.incremental_normalize(spark, root, silver, manifest, on_error="skip").collect()}
    assert again == {"2024-02": "error", "2024-03": "removed"}
    assert {str(r.slice) for r in spark.read.parquet(silver).select("slice").distinct().collect()} == {"2024-01", "2024-04"}


def test_gold_states_are_merged_and_replaced(spark):
    eda, ledger, states, gold = (scratch_path(spark, f"r3-{n}") for n in ("eda", "eda-ledger", "states", "gold-ledger"))
    measures = {"n": layers.Measure("count"), "s": layers.column_measure("sum", "v"), "a": layers.column_measure("avg", "v"),
                "hi": layers.column_measure("max", "v"), "lo": layers.column_measure("min", "v")}

    def put(run, rows):
        lake.write_slices(spark.createDataFrame(rows, "slice string, k string, v double"), eda)
        layers.append_ledger(spark, ledger, [(s, "done", 1, run, None) for s in {r[0] for r in rows}], run)
        return sorted(r.slice for r in layers.incremental_gold(spark, eda, ledger, states, gold, ["k"], measures).collect())

    assert put("r1", [("2024-01", "x", 1.0), ("2024-01", "y", None), ("2024-02", "x", 4.0)]) == ["2024-01", "2024-02"]
    assert put("r2", [("2024-02", "x", 7.0), ("2024-02", "x", 2.0)]) == ["2024-02"]
    found = {r.k: tuple(r)[1:] for r in layers.read_gold(spark, states, ["k"], measures).collect()}
    assert found == {"x": (3, 10.0, 10.0 / 3, 7.0, 1.0), "y": (1, None, None, None, None)}


# ---- skew ---------------------------------------------------------------------

def test_heavy_key_does_not_meet_in_one_task(spark):
    """A third of the rows on one key and a fifth without key: no task reads three times the median."""
    fact = spark.range(0, 60_000, numPartitions=8).select("id", F.when(F.col("id") % 3 == 0, 7).when(
        F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id") % 999).cast("bigint").alias("k"))
    dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).hint("merge")
    assert skew.heavy_keys(fact, "k", 0.1) == [7]
    out = skew.skew_left_join(fact, dim, "k", share=0.1, always=True)
    expected = fact.join(dim.withColumnRenamed("k", "kk"), F.col("k") == F.col("kk"), "left").drop("kk")
    assert out.exceptAll(expected).isEmpty() and out.count() == expected.count()
    plan = cat.explain_text(out, "simple")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
    conf = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = {c: spark.conf.get(c) for c in conf}
    try:
        spark.conf.set(conf[0], "false")
        spark.conf.set(conf[1], "8")
        rows = sorted(r["count"] for r in skew.skew_left_join(fact, dim, "k", share=0.1, always=True)
                      .groupBy(F.spark_partition_id()).count().collect())
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert rows[-1] <= 3 * rows[len(rows) // 2]


def test_small_dimension_is_joined_plainly(spark):
    fact, dim = spark.range(10).withColumnRenamed("id", "k"), spark.range(3).withColumn("v", F.lit(1)).withColumnRenamed("id", "k")
    assert cat.explain_text(skew.skew_left_join(fact, dim, "k"), "simple").count("Join") == 1
    with pytest.raises(ValueError):
        skew.heavy_keys(fact, "k", 0)


def test_marts_of_fact_columns_plan_no_dimension_join(spark, sf):
    import __spark_entry__ as entry
    q = entry.queries()
    for name in ("mart_payment", "mart_vendor", "bucket_distance", "kpi_summary", "daily_counts", "passenger_stats"):
        assert len([x for x in cat.explain_text(q[name](spark, sf), "simple").splitlines() if "Join " in x]) <= 1, name
    assert "Join" not in cat.explain_text(q["mart_hourly"](spark, sf), "simple")


# ---- snapshots ------------------------------------------------------------------

def test_two_writers_take_two_versions(spark):
    t = cat.SnapshotTable(spark, scratch_path(spark, "r3-race"))
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda i: t.commit(spark.range(i * 10, i * 10 + 10)), range(4)))
    assert sorted(versions) == [1, 2, 3, 4]
    assert sorted(r.id for r in t.read().collect()) == list(range(40))
    assert t.files().select("_version").distinct().count() == 4
    with pytest.raises(cat.CommitConflict):
        t.commit(spark.range(1), "overwrite", expected_version=3)
    assert t.commit(spark.range(1), "overwrite", expected_version=4) == 5
    assert t.read().count() == 1 and t.read(4).count() == 40


def test_data_without_a_log_file_is_not_read(spark):
    t = cat.SnapshotTable(spark, scratch_path(spark, "r3-orphan"))
    t.commit(spark.range(3))
    spark.range(100).write.parquet(f"{t.data}/orphan")
    assert t.read().count() == 3


# ---- streams --------------------------------------------------------------------

def test_source_lag():
    assert progress.source_lag('{"t": {"0": 20, "1": 7}}', {"t": {"0": 15, "1": 7}}) == 5
    assert progress.source_lag({"logOffset": 4}, {"logOffset": 1}) == 3
    assert progress.source_lag({"logOffset": 4}, None) == 5
    assert progress.source_lag(None, {"logOffset": 1}) is None
    assert progress.source_lag("not json", "{}") is None


def _messages(spark, low, high):
    return spark.range(low, high).select(F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"),
                                         F.col("id").alias("offset"))


def test_sink_stores_each_message_once(spark):
    root = scratch_path(spark, "r3-sink")
    sink = commits.ledgered_sink(root)
    sink(_messages(spark, 0, 10), 0)
    sink(_messages(spark, 0, 10), 0)                    # the same batch again
    sink(_messages(spark, 10, 20), 1)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "started-over")
    try:
        sink(_messages(spark, 0, 15), 0)                # all old
        sink(_messages(spark, 15, 30), 1)               # half of it old
        sink(_messages(spark, 30, 30), 2)               # empty
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    spark.range(5).selectExpr("'t' AS topic", "0 AS partition", "id AS offset").write.parquet(f"{root}/data/query=x/batch=9")
    assert sorted(r.offset for r in commits.read_committed(spark, root).collect()) == list(range(30))
    with pytest.raises(ValueError):
        commits.read_committed(spark, scratch_path(spark, "r3-none"))


def test_jdbc_sink_and_source_options(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.jdbc", lambda self, url, table, properties=None: seen.append((url, table)))
    stream.jdbc_batch_sink("jdbc:x", "t", {})(spark.range(1), 3)
    assert seen == [("jdbc:x", "t")]
    opts = stream.kafka_source_options("h:1", "t", max_offsets_per_trigger=10)
    assert opts["maxOffsetsPerTrigger"] == "10" and opts["failOnDataLoss"] == "false"


# ---- files ------------------------------------------------------------------------

def test_files_follow_bytes_not_documents(spark, sf):
    big, small = q_nested.write_chat_export(spark, sf), q_nested.write_chat_export(spark, sf, target=4096)
    count = [len(q_nested.read_chats(spark, p).inputFiles()) for p in (big, small)]
    assert count[0] == 1 < count[1] < spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count()
    key = ["chat_id", "message_id", "text"]
    a, b = (nx.explode_chats(q_nested.read_chats(spark, p)).select(*key) for p in (big, small))
    assert a.exceptAll(b).isEmpty() and a.count() == b.count()


def test_json_modes(spark):
    path = scratch_path(spark, "r3-json")
    spark.createDataFrame([('{"a": 1}',), ("{broken",)], "value string").write.text(path)
    assert files.read_json_lines(spark, path, "a INT", mode="DROPMALFORMED").count() == 1
    with pytest.raises((PySparkException, Py4JJavaError), match="FAILED_READ_FILE"):
        files.read_json_lines(spark, path, "a INT", mode="FAILFAST").collect()
    docs = scratch_path(spark, "r3-docs")
    spark.createDataFrame([('[{"a": 1},\n {"a": 2}]',)], "value string").write.text(docs)
    assert sorted(r.a for r in files.read_json_documents(spark, docs, "a INT").collect()) == [1, 2]


def test_csv_inferred_types(spark):
    path = scratch_path(spark, "r3-csv")
    spark.createDataFrame([(1, 2.5, "x", "2024-01-02 03:04:05")], "i int, d double, s string, t string").write.option("header", True).csv(path)
    df = files.read_csv(spark, path, infer=True)
    assert dict(df.dtypes) == {"i": "int", "d": "double", "s": "string", "t": "timestamp"}


def test_spread(spark):
    df = spark.range(100)
    assert files.spread(df, 7).rdd.getNumPartitions() == 7
    parts = files.spread(df.withColumn("k", F.col("id") % 5), 4, "k").select("k", F.spark_partition_id().alias("part")).distinct()
    assert parts.count() == 5
    with pytest.raises(ValueError):
        files.spread(df)


def test_connector_presets():
    assert connectors.mongo_options("u", "d", "c") == ("mongodb", {"connection.uri": "u", "database": "d", "collection": "c"})
    assert connectors.redis_read_options("h", 1, "k:*")[1]["keys.pattern"] == "k:*"
    assert connectors.redis_write_options("h", 1, "t", "id")[1]["key.column"] == "id"
    assert connectors.kafka_batch_options("s", "t")[1]["endingOffsets"] == "latest"
    assert connectors.s3a_conf("https://x")["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"


def test_extract(spark):
    got = []
    jdbc.extract(spark.range(10).withColumn("b", F.col("id") * 2), "id > 7", ["b"], lambda d: got.extend(r.b for r in d.collect()), partitions=1)
    assert sorted(got) == [16, 18]


# ---- catalog, ML, small helpers -----------------------------------------------------

def test_catalog_statements(spark):
    ns = "r3_ns"
    cat.create_namespace(spark, ns, scratch_path(spark, "r3-ns"))
    assert ns in [r.namespace for r in cat.show_namespaces(spark).collect()]
    assert tuple(cat.current_namespace(spark).first()) == ("spark_catalog", "default")
    assert "spark_catalog" in [r.catalog for r in cat.show_catalogs(spark).collect()]


def test_exact_median_model_is_saved_with_its_pipeline(spark):
    rows = [(1.0, None), (2.0, float("nan")), (10.0, None), (11.0, None), (None, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    model = ml.Pipeline(stages=[ml.ExactMedianImputer(["a", "b"])]).fit(df)
    path = scratch_path(spark, "r3-model")
    model.write().save(path)
    from pyspark.ml import PipelineModel
    for m in (model, PipelineModel.load(path)):
        out = m.transform(df).select("a_imputed", "b_imputed").collect()
        assert sorted(r.a_imputed for r in out) == [1.0, 2.0, 6.0, 10.0, 11.0]
        assert all(r.b_imputed is None for r in out)


def test_centres_are_means_in_own_units(spark):
    df = spark.createDataFrame([(float(i % 2 * 100 + i % 3), 5.0 * (i % 2)) for i in range(60)], "x double, y double")
    vec = ml.assembler(["x", "y"]).transform(df)
    scaling = ml.scaler().fit(vec)
    scaled = scaling.transform(vec)
    model = ml.kmeans(2, 42, "scaled").fit(scaled)
    centres = {(r.cluster, r.feature): r.centre for r in ml.cluster_centres(spark, model, ["x", "y"], scaling).collect()}
    for r in model.transform(scaled).groupBy("cluster").agg(F.avg("x").alias("x"), F.avg("y").alias("y")).collect():
        assert centres[r.cluster, "x"] == pytest.approx(r.x) and centres[r.cluster, "y"] == pytest.approx(r.y, abs=1e-9)


def test_helpers_without_a_query(spark):
    fact, dim = spark.range(3).withColumnRenamed("id", "k"), spark.createDataFrame([(1, "a")], "k long, v string")
    for bounded in (False, True):
        assert sorted((r.k, r.v) for r in enrich.left_enrich(fact, dim, "k", bounded).collect()) == [(0, None), (1, "a"), (2, None)]
    assert clean.existing_in_order(dim, ["v", "x", "k"]).columns == ["v", "k"]
    assert ml.stratified_sample(fact, "k", {0: 1.0, 1: 0.0}).count() == 1
    assert json.loads(spark.range(1).schema.json())["fields"][0]["name"] == "id"


def test_hints_follow_the_estimated_size(spark, sf):
    small = spark.read.parquet(f"{sf}/nation.parquet")
    fact = spark.range(10).withColumnRenamed("id", "n_nationkey")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for limit, join in ((enrich.HINT_BYTES, "BroadcastHashJoin"), (10, "SortMergeJoin")):
            assert join in cat.explain_text(fact.join(enrich.bounded(small, limit), "n_nationkey"), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    unknown = spark.createDataFrame([(1,)], "k long")
    assert enrich.bounded(unknown) is unknown or skew.estimated_bytes(unknown) <= enrich.HINT_BYTES


# ---- work that must not grow faster than its input ------------------------------

def test_a_bad_slice_is_written_apart(spark, monkeypatch):
    """Footers tell a slice of other types: the good ones are written once, without it."""
    root, target, ledger = (scratch_path(spark, x) for x in ("apart", "apart-eda", "apart-ledger"))
    names = [f"2024-{m:02d}" for m in range(1, 9)]
    for s in names:
        value = "'x'" if s == "2024-03" else "1.5"
        spark.sql(f"SELECT {value} AS fare, '{s}' AS slice").write.mode("append").partitionBy("slice").parquet(root)
    schema = spark.createDataFrame([], "fare decimal(2,1), slice string").schema
    calls, write = [], lake.write_slices
    monkeypatch.setattr(lake, "write_slices", lambda df, at, **kw: (calls.append(at), write(df, at, **kw)))
    inputs = spark.createDataFrame([(s, "done", "v1") for s in names], "slice string, status string, version string")

    def build(some):
        return spark.read.schema(schema).parquet(root).filter(F.col("slice").isin(some))
    got = {r.slice: r.status for r in layers.advance(
        spark, inputs, target, ledger, build, apart=lambda some: lake.split_by_schema(spark, root, some, schema)).collect()}
    assert got == {s: "error" if s == "2024-03" else "done" for s in names}
    assert len(calls) == 2


def test_normalised_slices_of_few_files_are_not_shuffled(spark, monkeypatch):
    seen, write = [], lake.write_slices
    monkeypatch.setattr(lake, "write_slices", lambda df, at, **kw: (seen.append(kw.get("clustered")), write(df, at, **kw)))
    for parts in (1, 9):                # files of a slice
        bronze, silver, manifest = (scratch_path(spark, x) for x in ("few", "few-silver", "few-manifest"))
        spark.range(90).selectExpr("CAST(id AS DOUBLE) AS fare_amount", "'2024-01' AS slice").repartition(parts).write.partitionBy(
            "slice").parquet(bronze)
        assert [(r.rows, r.status) for r in lake.incremental_normalize(spark, bronze, silver, manifest).collect()] == [(90, "done")]
        assert spark.read.parquet(silver).agg(F.sum("fare_amount")).first()[0] == sum(range(90))
    assert seen == [True, False]


def test_variant_levels_are_written_once_for_several(spark, monkeypatch):
    """Hits at every level of deep documents, scalars and containers of that name, one write for LEVELS levels."""
    from lakemart import session
    paths, path = [], session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda s, name: paths.append(name) or path(s, name))
    deep = '{"price": 1, "a": [{"price": 2, "b": {"price": {"price": 3, "c": [[{"price": 4}]]}}}], "e": {}, "n": null}'
    docs = [(1, deep), (2, '{"price": "5"}'), (3, '{"price": "no"}'), (4, "[]"), (5, "7"), (6, '{"price": [8, {"price": 9}]}')]
    got = nx.deep_values_variant(spark, spark.createDataFrame(docs, "id int, doc string"), ["id"], "doc", "price")
    assert sorted(map(tuple, got.collect())) == [(1, 1.0), (1, 2.0), (1, 3.0), (1, 4.0), (2, 5.0), (6, 9.0)]
    assert len(paths) == 2              # eight levels deep at most


def test_weighted_rows_train_the_same_trees(spark):
    rows = spark.range(4000).selectExpr("CAST(id % 20 AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) AS b",
                                        "CAST((id * 37) % 101 + 10 * (id % 20) + id % 7 AS DOUBLE) AS y")
    vectors = ml.assembler(["a", "b"])
    weighted = ml.weighted_rows(rows, ["a", "b"], "y")
    assert weighted.count() == 140 and weighted.agg(F.sum("weight")).first()[0] == 4000
    model = ml.gbt_regressor("y", 5, 3)
    test = vectors.transform(rows.select("a", "b").distinct())
    plain = {(r.a, r.b): r.prediction for r in model.fit(vectors.transform(rows)).transform(test).collect()}
    other = {(r.a, r.b): r.prediction for r in model.copy().setWeightCol("weight").fit(vectors.transform(weighted)).transform(test).collect()}
    assert other == pytest.approx(plain)
    assert ml.weighted_rows(spark.sql("SELECT 1 AS a, CAST(NULL AS DOUBLE) AS y"), ["a"], "y").first()["y"] is None


def test_rows_of_one_task_are_spread(spark):
    one = spark.range(0, 300_000, 1, 1)
    sizes = [r["count"] for r in ml.spread_rows(one).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 300_000 and max(sizes) <= 160_000
    assert ml.spread_rows(spark.range(0, 5000, 1, 1)).rdd.getNumPartitions() == 1
