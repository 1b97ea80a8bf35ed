"""Feature engineering, evaluation and model queries (§2 M, G33, G38, G39, E22, I7).

Labelled data = documents JOIN labels (quality is the class).  Evaluation
tables use a transparent rule-based predictor so their numbers are exactly
reproducible in SQL; trained models (random forest, k-means) are rows-only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions import features as fx
from lakemart.operators import ml
from lakemart.plans import trips as tp
from lakemart.plans.registry import query
from lakemart.session import table

LABELED_SQL = """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality AS label, l.toxic,
  CASE WHEN l.toxic = 0 AND d.n_chars >= 500 THEN 1 ELSE 0 END AS prediction
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def labeled(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf, "labels")
    j = d.join(lab, "doc_id")
    return j.select("doc_id", "lang", "source", "n_chars", F.col("quality").alias("label"), "toxic",
                    fx.flag((F.col("toxic") == 0) & (F.col("n_chars") >= 500)).alias("prediction"))


PRED_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS actual,
  l_quantity * 1500.0 AS prediction FROM lineitem"""


def predictions(spark, sf):
    """A baseline price model: quantity times a fixed unit price."""
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.col("l_extendedprice").alias("actual"), (F.col("l_quantity") * 1500.0).alias("prediction"))


@query("string_index", sql="""
SELECT p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS DOUBLE) AS p_type_idx
FROM part GROUP BY p_type""")
def string_index(spark, sf):
    """M2: StringIndexer (frequency desc, ties alphabetical) fitted on the whole column."""
    p = table(spark, sf, "part")
    model = ml.indexers(["p_type"])[0].fit(p)
    return model.transform(p.select("p_type").distinct())


@query("standard_scale", rnd=("quantity_scaled", "discount_scaled"), sql="""
SELECT l_orderkey, l_linenumber, l_partkey,
  (l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER () AS quantity_scaled,
  (l_discount - avg(l_discount) OVER ()) / stddev_samp(l_discount) OVER () AS discount_scaled
FROM lineitem""")
def standard_scale(spark, sf):
    """M1/M4: VectorAssembler + StandardScaler(withMean, withStd); statistics are one
    distributed aggregate, the transform is row-local."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount")
    vec = ml.assembler(["l_quantity", "l_discount"]).transform(li)
    scaled = ml.scaler("features", "scaled").fit(vec).transform(vec)
    return ml.vector_columns(scaled.select("l_orderkey", "l_linenumber", "l_partkey", "scaled"), "scaled",
                             ["quantity_scaled", "discount_scaled"])


@query("impute_median", sql="""
WITH j AS (SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS quality, CAST(l.toxic AS DOUBLE) AS toxic
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id, coalesce(quality, (SELECT quantile_disc(quality, 0.5) FROM j)) AS quality_imputed,
  coalesce(toxic, (SELECT quantile_disc(toxic, 0.5) FROM j)) AS toxic_imputed FROM j""")
def impute_median(spark, sf):
    """M5: median imputation of the label columns of unlabelled documents."""
    d = table(spark, sf, "documents").select("doc_id")
    j = d.join(table(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id", F.col("quality").cast("double"), F.col("toxic").cast("double"))
    out = ml.median_imputer(["quality", "toxic"]).fit(j).transform(j)
    return out.select("doc_id", "quality_imputed", "toxic_imputed")


@query("impute_median_exact", rnd=("price_imputed", "quantity_imputed"), sql="""
WITH j AS (SELECT l_orderkey, l_linenumber, l_partkey,
             CASE WHEN l_orderkey % 5 <> 0 THEN l_extendedprice END AS price,
             CASE WHEN l_linenumber <> 2 THEN l_quantity * 1.5 END AS quantity FROM lineitem),
m AS (SELECT quantile_cont(price, 0.5) AS mp, quantile_cont(quantity, 0.5) AS mq FROM j)
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(price, mp) AS price_imputed, coalesce(quantity, mq) AS quantity_imputed
FROM j CROSS JOIN m""")
def impute_median_exact(spark, sf):
    """M5/M6: the exact median imputer as a stage of a pipeline, on columns of many values;
    some prices are missing as NULL, some quantities as NaN."""
    li = table(spark, sf, "lineitem")
    j = li.select("l_orderkey", "l_linenumber", "l_partkey",
                  F.when(F.col("l_orderkey") % 5 != 0, F.col("l_extendedprice")).alias("price"),
                  F.when(F.col("l_linenumber") == 2, F.lit(float("nan"))).otherwise(F.col("l_quantity") * 1.5).alias("quantity"))
    model = ml.Pipeline(stages=[ml.ExactMedianImputer(["price", "quantity"])]).fit(j)
    return model.transform(j).drop("price", "quantity")


@query("prediction_sample", sql=f"""
SELECT l_orderkey, l_linenumber, actual, prediction FROM ({PRED_SQL}) WHERE l_linenumber = 1
ORDER BY l_orderkey, l_partkey, l_suppkey LIMIT 20""")
def prediction_sample(spark, sf):
    """The first 20 predictions by key."""
    p = predictions(spark, sf).filter("l_linenumber = 1")
    return ml.prediction_sample(p, ["l_orderkey", "l_linenumber", "actual", "prediction"],
                                ["l_orderkey", "l_partkey", "l_suppkey"])


@query("cluster_centres")
def cluster_centres(spark, sf):
    """M14 (rows-only): centres of the k-means on trip features, in the features' own units."""
    names = ["trip_distance", "trip_duration_minutes", "total_amount"]
    vec = ml.assembler(names).transform(tp.facts(spark, sf, "events", ()).select(*names))
    scaling = ml.scaler("features", "scaled").fit(vec)
    model = ml.kmeans(5, 42, "scaled").fit(scaling.transform(vec))
    return ml.cluster_centres(spark, model, names, scaling)


@query("gbt_class_metrics")
def gbt_class_metrics(spark, sf):
    """M11/M15/M16/M19 (rows-only): gradient-boosted classifier at the reference's size on a
    70/30 split, with its metrics."""
    data = labeled(spark, sf).drop("prediction").withColumn("label", F.col("label").cast("double"))
    train, test = ml.random_split(data, 0.7, 42)
    pred = ml.build_pipeline(["lang"], ["n_chars", "toxic"], ml.gbt_classifier("label")).fit(train).transform(test)
    return ml.metric_table(spark, "gbt", {**ml.binary_metrics(pred), **ml.multiclass_metrics(pred)})


@query("hash_split", sql=f"""
SELECT label, CASE WHEN ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 4))::INTEGER % 100 < 70
                   THEN 'train' ELSE 'test' END AS split, count(*) AS n
FROM ({LABELED_SQL}) GROUP BY ALL""")
def hash_split(spark, sf):
    """M8: deterministic, per-class (stratified) train/test split."""
    s = ml.hash_split(labeled(spark, sf), "doc_id")
    return s.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


@query("class_share", rnd=("share",), sql="""
SELECT quality, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM labels GROUP BY quality""")
def class_share(spark, sf):
    """Class distribution and share of the total (window over the tiny result)."""
    from pyspark.sql import Window
    c = table(spark, sf, "labels").groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


@query("confusion_matrix", sql=f"""
SELECT label, prediction, count(*) AS n FROM ({LABELED_SQL}) GROUP BY ALL""")
def confusion_matrix(spark, sf):
    """(label, prediction) counts."""
    return ml.confusion(labeled(spark, sf))


@query("class_metrics", rnd=("accuracy", "weighted_precision", "weighted_recall", "f1"), sql=f"""
WITH cm AS (SELECT label, prediction, count(*) AS n FROM ({LABELED_SQL}) GROUP BY ALL),
pl AS (SELECT label AS c, sum(n) AS support, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp
       FROM cm GROUP BY label),
pp AS (SELECT prediction AS c, sum(n) AS predicted FROM cm GROUP BY prediction),
per AS (SELECT pl.c, support, tp, coalesce(predicted, 0) AS predicted,
          coalesce(CASE WHEN coalesce(predicted, 0) <> 0 THEN tp / predicted END, 0.0) AS prec,
          tp / support AS rec FROM pl LEFT JOIN pp ON pl.c = pp.c)
SELECT sum(tp) / sum(support) AS accuracy, sum(prec * support) / sum(support) AS weighted_precision,
  sum(rec * support) / sum(support) AS weighted_recall,
  sum(coalesce(CASE WHEN prec + rec <> 0 THEN 2 * prec * rec / (prec + rec) END, 0.0) * support) / sum(support) AS f1
FROM per""")
def class_metrics(spark, sf):
    """Accuracy and weighted precision / recall / F1 from one confusion pass."""
    return ml.class_metrics(labeled(spark, sf))


@query("regression_metrics", rnd=(("rmse", 4), ("mse", 1), ("mae", 4), "r2", "mape"), sql=f"""
WITH p AS ({PRED_SQL})
SELECT sqrt(sum((prediction - actual) * (prediction - actual)) / count(*)) AS rmse,
  sum((prediction - actual) * (prediction - actual)) / count(*) AS mse,
  sum(abs(prediction - actual)) / count(*) AS mae,
  1 - sum((prediction - actual) * (prediction - actual))
      / (sum(actual * actual) - count(*) * avg(actual) * avg(actual)) AS r2,
  avg(CASE WHEN actual = 0 THEN 0.0 ELSE abs(prediction - actual) / actual * 100 END) AS mape
FROM p""")
def regression_metrics(spark, sf):
    """Rmse, mse, mae, r2 and MAPE in one aggregate."""
    return ml.regression_metrics(predictions(spark, sf), "actual")


@query("error_metrics", sql=f"""
SELECT *, abs(prediction - actual) AS abs_error,
  CASE WHEN actual = 0 THEN 0.0 ELSE abs(prediction - actual) / actual * 100 END AS pct_error
FROM ({PRED_SQL})""")
def error_metrics(spark, sf):
    """Absolute and percentage error per row (0 when the actual is 0)."""
    p = predictions(spark, sf)
    return p.withColumns({"abs_error": fx.abs_error("prediction", "actual"),
                          "pct_error": fx.pct_error("prediction", "actual")})


@query("worst_errors", sql=f"""
SELECT *, abs(prediction - actual) AS abs_error FROM ({PRED_SQL})
ORDER BY abs_error DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20""")
def worst_errors(spark, sf):
    """The 20 worst predictions."""
    return ml.worst_predictions(predictions(spark, sf), "actual", 20,
                                ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query("cluster_stats")
def cluster_stats(spark, sf):
    """M14/G33 (rows-only): k-means (k=5, seed 42) on trip features, then per
    cluster counts, averages and an approximate median amount."""
    t = tp.eda(spark, sf, "events").select("trip_distance", "trip_duration_minutes", "total_amount",
                                           "passenger_count")
    vec = ml.assembler(["trip_distance", "trip_duration_minutes", "total_amount"]).transform(t)
    scaled = ml.scaler("features", "scaled").fit(vec).transform(vec)
    clustered = ml.kmeans(5, 42, "scaled").fit(scaled).transform(scaled)
    return (clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("count"), F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"), F.avg("total_amount").alias("avg_amount"),
        F.avg("passenger_count").alias("avg_passengers"),
        F.percentile_approx("total_amount", 0.5).alias("median_amount")).orderBy("cluster"))


@query("model_metrics")
def model_metrics(spark, sf):
    """M6/M7/M10/M15/M16/M19 (rows-only): index -> one-hot -> assemble ->
    random forest on a 70/30 split, then a (model_type, metric, value) table."""
    data = labeled(spark, sf).drop("prediction").withColumn("label", F.col("label").cast("double"))
    train, test = ml.random_split(data, 0.7, 42)
    model = ml.build_pipeline(["lang", "source"], ["n_chars", "toxic"],
                              ml.rf_classifier("label")).fit(train)
    pred = model.transform(test)
    metrics = {**ml.binary_metrics(pred), **ml.multiclass_metrics(pred)}
    return ml.metric_table(spark, "random_forest", metrics)


@query("gbt_regression_metrics")
def gbt_regression_metrics(spark, sf):
    """M12/M13/M17/M19/M20 (rows-only): gradient-boosted and random-forest
    regressors predicting the line price from quantity, discount, tax and
    line number on a 70/30 split; one-pass metrics per model, plus the top
    feature importance, as (model_type, metric, value) rows."""
    li = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_linenumber",
                                            "l_extendedprice")
    feats = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    vectors = ml.assembler(feats)
    drawn = ml.drawn_rows(li, 0.7, 42)
    train, test = (drawn.filter(which).drop("is_train") for which in ("is_train", "NOT is_train"))
    models = {"gbt_regressor": ml.gbt_regressor("l_extendedprice").setWeightCol("weight"),
              "rf_regressor": ml.rf_regressor("l_extendedprice")}
    if train.count() > ml.CELLS_BEYOND:
        fitted, test = ml.fit_on_cells(models, train, test, feats, "l_extendedprice")
        predict = lambda model, rows: ml.predict_on_cells(model, rows, feats)
    else:
        train = ml.spread_rows(vectors.transform(train))
        # 100 boosted trees pass over their rows 600 times; the forest samples rows and needs each of them
        weighted = vectors.transform(ml.weighted_rows(train, feats, "l_extendedprice"))
        fitted = {name: model.fit(train if name == "rf_regressor" else weighted) for name, model in models.items()}
        predict = lambda model, rows: model.transform(vectors.transform(rows))
    out = None
    for name, model in fitted.items():
        pred = predict(model, test)
        m = ml.regression_metrics(pred, "l_extendedprice")
        rows = m.select(F.lit(name).alias("model_type"), F.explode(F.create_map(
            *[x for c in ("rmse", "mse", "mae", "r2", "mape") for x in (F.lit(c), F.col(c))])).alias("metric", "value"))
        top = ml.feature_importances(spark, model, vectors.transform(test)).limit(1).select(
            F.lit(name).alias("model_type"), F.concat(F.lit("top_feature:"), "feature").alias("metric"),
            F.col("importance").alias("value"))
        part = rows.unionByName(top)
        out = part if out is None else out.unionByName(part)
    found = out.collect()
    drawn.unpersist()
    return spark.createDataFrame(found, out.schema)
