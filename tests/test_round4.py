"""Round 4: trees trained on cells of binned features (gbt_regression_metrics on large tables)."""

import math

import pytest
from pyspark.ml.base import Estimator
from pyspark.sql import functions as F

from lakemart.operators import ml
from lakemart.plans import q_ml

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """30,000 rows: few values, many values, and some missing."""
    df = spark.range(0, 30_000, 1, 4).selectExpr(
        "CAST(id * 7919 % 12 AS DOUBLE) AS a", "CAST(id * 104729 % 9973 AS DOUBLE) AS b",
        "IF(id % 50 = 3, NULL, IF(id % 50 = 4, DOUBLE('NaN'), CAST(id % 5 AS DOUBLE))) AS c",
        "100.0 * (id * 7919 % 12) + 0.05 * (id * 104729 % 9973) + IF(id % 50 IN (3, 4), 300, 20 * (id % 5))"
        " + pmod(xxhash64(id), 200) AS y").persist()
    yield df
    df.unpersist()


def test_rows_drawn_once_are_those_of_random_split(spark):
    df = spark.range(0, 5000, 1, 3).selectExpr("id % 7 AS a", "IF(id % 11 = 0, NULL, id % 13) AS b",
                                               "CAST(id * 37 % 101 AS DOUBLE) AS y")
    drawn = ml.drawn_rows(df, 0.7, 42)
    train, test = ml.random_split(df, 0.7, 42)
    for part, flag in ((train, "is_train"), (test, "NOT is_train")):
        got = drawn.filter(flag).drop("is_train")
        assert got.collect() == part.collect()
        assert got.rdd.getNumPartitions() == part.rdd.getNumPartitions()
    drawn.unpersist()


def test_bins_are_those_of_a_tree(spark, rows):
    limits = ml.bin_thresholds(rows, FEATURES)
    assert limits["a"] == [x + 0.5 for x in range(11)] and limits["c"] == [0.5, 1.5, 2.5, 3.5]
    assert len(limits["b"]) == 31 and limits["b"] == sorted(set(limits["b"]))
    binned = ml.bin_features(rows, limits)
    assert binned.columns == rows.columns
    sizes = [r["count"] for r in binned.groupBy("b").count().collect()]
    assert len(sizes) == 32 and max(sizes) < 2 * min(sizes)
    odd = spark.createDataFrame([(x,) for x in (-math.inf, 0.5, 0.6, 3.5, 3.6, math.inf, math.nan, None)], "c double")
    codes = [r.c for r in ml.bin_features(odd, {"c": [0.5, 1.5, 2.5, 3.5]}).collect()]
    assert codes == [0.0, 0.0, 1.0, 3.0, 4.0, 4.0, 4.0, 4.0]        # x <= limit goes left, what is missing right
    assert [r.c for r in ml.bin_features(odd, {"c": []}).collect()] == [0.0] * 8
    for limits, seen in (([0.5, 1.5, 2.5, 3.5], [0.0, 1.0, 3.0, 4.0]), ([], [0.0] * 4)):
        strict = [r.c for r in ml.bin_features(odd, {"c": limits}, strict=True).collect()]
        assert [math.isnan(x) for x in strict] == [True, False, False, False, False, True, True, True] and strict[1:5] == seen
    mostly = spark.range(0, 20_000, 1, 2).selectExpr("IF(id % 10 > 0, 0.0, CAST(id AS DOUBLE)) AS z")
    limits = ml.bin_thresholds(mostly, ["z"])["z"]
    assert 29 <= len(limits) <= 31 and max(limits) > 17_000        # one value on most rows leaves bins for the others
    none = spark.sql("SELECT CAST(NULL AS DOUBLE) AS n, DOUBLE('NaN') AS m, 3 AS i")
    assert ml.bin_thresholds(none, ["n", "m", "i"]) == {"n": [], "m": [], "i": []}


def test_cell_numbers_turn_back(spark):
    names = [f"f{i}" for i in range(12)]
    df = spark.createDataFrame([tuple(float(x) for x in range(12)), (31.0,) * 12], names)
    got = df.select(ml.cell_number(names)).select(*ml.cell_features(names))
    assert got.collect() == df.collect()
    with pytest.raises(ValueError):
        ml.cell_number([f"f{i}" for i in range(13)])


def test_bootstrap_cells_draw_every_row(spark, monkeypatch):
    """Poisson counts per row and tree; a cell of most rows is dealt to several tasks."""
    monkeypatch.setattr(ml, "TASK_ROWS", 2000)
    df = spark.range(0, 20_000, 1, 4).selectExpr("IF(id % 4 = 0, CAST(id % 28 AS DOUBLE), 30.0) AS a", "CAST(id AS DOUBLE) AS y")
    cells = ml.weighted_rows(df, ["a"], "y")
    got = ml.bootstrap_cells(df, cells, ["a"], "y", 40, 1.0, 7)
    one = got.groupBy("tree").agg(F.sum("weight").alias("n"), (F.sum(F.col("weight") * F.col("y")) / F.sum("weight")).alias("mean")).collect()
    assert len(one) == 40
    n = [r.n for r in one]
    assert abs(sum(n) / 40 - 20_000) < 5 * math.sqrt(20_000 / 40) and len(set(n)) > 20
    spread = sum((x - 20_000) ** 2 for x in n) / 40
    assert 0.3 * 20_000 < spread < 2.5 * 20_000
    assert abs(sum(r.mean for r in one) / 40 - 9_999.5) < 5 * 5774 / math.sqrt(20_000 * 40)
    means = [r.mean for r in one]
    sd = math.sqrt(sum((m - 9_999.5) ** 2 for m in means) / 40)
    assert 0.5 < sd / (5774 / math.sqrt(20_000)) < 1.6               # rows are drawn, not cells
    hot = got.filter("cell = 30 AND tree = 0").count()
    assert hot > 1 and got.filter("cell <> 30").groupBy("tree", "cell").count().filter("count > 1").isEmpty()
    again = ml.bootstrap_cells(df.repartition(3), cells, ["a"], "y", 40, 1.0, 7)
    both = [sorted(map(tuple, x.filter("cell <> 30").collect())) for x in (got, again)]
    assert [x[:2] for x in both[0]] and len(both[0]) == len(both[1])
    half = ml.bootstrap_cells(df, cells, ["a"], "y", 20, 0.5, 7).agg(F.sum("weight")).first()[0]
    assert abs(half / 20 - 10_000) < 5 * math.sqrt(10_000 / 20)


def test_models_on_cells_are_those_on_rows(spark, rows):
    """Boosting gives the same trees; a forest, whose samples are drawn anew, nearly the same predictions
    (with all features in each node: drawn ones make forests of a few trees differ by seed)."""
    train, test = (rows.filter(x).filter("c >= 0 AND NOT isnan(c)") for x in ("b % 10 <> 1", "b % 10 = 1"))
    few = ["a", "c"]
    vectors = ml.assembler(few)
    models = {"gbt": ml.gbt_regressor("y", 5, 3).setWeightCol("weight"), "rf": ml.rf_regressor("y", 60, 4).setFeatureSubsetStrategy("all")}
    fitted, binned = ml.fit_on_cells(models, train, test, few, "y")
    plain = {"gbt": ml.gbt_regressor("y", 5, 3).fit(vectors.transform(train)),
             "rf": ml.rf_regressor("y", 60, 4).setFeatureSubsetStrategy("all").fit(vectors.transform(train))}
    assert fitted["rf"].getNumTrees == 60 and fitted["rf"].numFeatures == 2 and fitted["rf"].uid == models["rf"].uid
    for name, share in (("gbt", 1e-9), ("rf", 0.03)):
        now = [r.prediction for r in ml.predict_on_cells(fitted[name], binned, few).orderBy("y", "a", "b", "c").collect()]
        was = [r.prediction for r in plain[name].transform(vectors.transform(test)).orderBy("y", "a", "b", "c").collect()]
        assert len(now) == len(was) == test.count()
        assert now == pytest.approx(was, rel=share)
        assert fitted[name].featureImportances.toArray() == pytest.approx(plain[name].featureImportances.toArray(), abs=0.05)
    mine, theirs = (ml.regression_metrics(p, "y").first()["rmse"] for p in
                    (ml.predict_on_cells(fitted["rf"], binned, few), plain["rf"].transform(vectors.transform(test))))
    assert mine == pytest.approx(theirs, rel=0.03)


def test_missing_values_are_refused_on_cells_as_on_rows(spark, rows):
    train, test = rows.filter("c >= 0 AND NOT isnan(c)"), rows
    models = {"gbt": ml.gbt_regressor("y", 2, 2).setWeightCol("weight"), "rf": ml.rf_regressor("y", 2, 2)}
    for bad in (rows, rows.withColumn("c", F.when(F.isnan("c"), math.inf).otherwise(F.coalesce("c", F.lit(0.0))))):
        with pytest.raises(Exception, match="NaN"):
            models["rf"].fit(ml.assembler(FEATURES).transform(bad))
        with pytest.raises(ValueError, match="NaN"):
            ml.fit_on_cells(models, bad, test, FEATURES, "y")
    fitted, binned = ml.fit_on_cells(models, train, test, FEATURES, "y")
    assert ml.predict_on_cells(fitted["rf"], binned, FEATURES).count() == test.count()


def test_a_null_label_is_refused_on_cells(spark):
    df = spark.sql("SELECT CAST(id % 3 AS DOUBLE) AS a, IF(id = 5, NULL, CAST(id AS DOUBLE)) AS y FROM range(100)")
    models = {"gbt": ml.gbt_regressor("y", 2, 2).setWeightCol("weight"), "rf": ml.rf_regressor("y", 2, 2)}
    with pytest.raises(Exception, match="(?i)null"):
        ml.fit_on_cells(models, df, df, ["a"], "y")


def test_price_models_of_a_large_table_pass_over_cells(spark, tmp_path, monkeypatch):
    """gbt_regression_metrics: beyond CELLS_BEYOND rows no model is fitted to single rows, and
    the metrics are those of the models on rows."""
    spark.range(0, 9000, 1, 3).selectExpr(
        "CAST(id % 5 + 1 AS DOUBLE) AS l_quantity", "CAST(id % 2 AS DOUBLE) / 10 AS l_discount",
        "CAST(id % 3 AS DOUBLE) / 20 AS l_tax", "CAST(id % 4 + 1 AS INT) AS l_linenumber",
        "1000.0 * (id % 5 + 1) + 200 * (id % 4) + pmod(xxhash64(id), 500) AS l_extendedprice").write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, fit = [], Estimator.fit
    monkeypatch.setattr(Estimator, "fit", lambda self, df, *a: seen.append((type(self).__name__, df.count())) or fit(self, df, *a))
    gbt, rf = ml.gbt_regressor, ml.rf_regressor
    monkeypatch.setattr(ml, "gbt_regressor", lambda label: gbt(label, 4, 3))
    monkeypatch.setattr(ml, "rf_regressor", lambda label: rf(label, 30, 4))

    def metrics():
        return {(r.model_type, r.metric): r.value for r in q_ml.gbt_regression_metrics(spark, str(tmp_path)).collect()}

    small = metrics()
    assert dict(seen)["RandomForestRegressor"] > 6000 and len(seen) == 2
    seen.clear()
    monkeypatch.setattr(ml, "CELLS_BEYOND", 1000, raising=False)
    large = metrics()
    assert len(seen) == 31 and max(n for _, n in seen) == 60
    assert small.keys() == large.keys() and len(large) == 12
    for k, v in small.items():
        assert large[k] == pytest.approx(v, **({"rel": 1e-9} if k[0] == "gbt_regressor" else {"rel": 0.6}))
