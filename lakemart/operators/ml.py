"""Feature engineering, models and evaluation with Spark ML.

Everything is a Spark ML ``Pipeline`` stage or a DataFrame aggregate:
training is distributed by Spark ML; metrics that are sums over rows are
computed in ONE aggregate pass (confusion counts, error moments) rather than
by collecting predictions.  Feature importances are named from the vector
column's ``ml_attr`` metadata, so one-hot expanded features line up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import Bucketizer, Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import features as fx
from lakemart.operators.profile import exact_quantiles_multi, numeric_columns
from lakemart.session import scratch_path


def feature_columns(df: DataFrame, label: str, exclude: tuple = ()) -> list[str]:
    """M1: every numeric column except the label and excluded (text) columns."""
    return [c for c in numeric_columns(df) if c != label and c not in exclude]


def assembler(cols: list[str], out: str = "features") -> VectorAssembler:
    """M1 (``handleInvalid='keep'`` keeps rows with NULL/NaN as NaN)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep")


def indexers(cols: list[str]) -> list[StringIndexer]:
    """M2: frequency-ordered indexes; unseen / NULL values get their own index."""
    return [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in cols]


def one_hot(cols: list[str]) -> OneHotEncoder:
    """M3."""
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_ohe" for c in cols],
                         handleInvalid="keep")


def scaler(in_col: str = "features", out_col: str = "scaled", with_mean: bool = True,
           with_std: bool = True) -> StandardScaler:
    """M4: corrected (sample) standard deviation, as the notebook uses."""
    return StandardScaler(inputCol=in_col, outputCol=out_col, withMean=with_mean, withStd=with_std)


def median_imputer(cols: list[str], relative_error: float = 0.001) -> Imputer:
    """M5: median imputation (approximate quantile with bounded error)."""
    return Imputer(strategy="median", inputCols=cols, outputCols=[f"{c}_imputed" for c in cols],
                   relativeError=relative_error)


class ExactMedianModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """M5: fills NULL and NaN with the medians found by ``ExactMedianImputer``."""

    inputCols = Param(Params._dummy(), "inputCols", "columns to fill", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "filled columns", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "one median per column (NaN: no value seen)", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        def filled(name: str, median: float):
            value = F.col(name).cast("double")
            # a column without any value stays as it is
            other = F.lit(None).cast("double") if math.isnan(median) else F.lit(median)
            return F.when(value.isNull() | F.isnan(value), other).otherwise(value)
        names = zip(self.getOrDefault(self.inputCols), self.getOrDefault(self.outputCols), self.getOrDefault(self.medians),
                    strict=True)
        return dataset.withColumns({out: filled(c, m) for c, out, m in names})


class ExactMedianImputer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """M5: an estimator whose model holds exact medians (linear interpolation between
    the two middle values), found by the refinement rounds of ``exact_quantiles_multi``:
    no task ranks an unbounded set of values."""

    inputCols = Param(Params._dummy(), "inputCols", "columns to fill", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "filled columns", TypeConverters.toListString)

    def __init__(self, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols), outputCols=list(outputCols or [f"{c}_imputed" for c in inputCols]))

    def _fit(self, dataset: DataFrame) -> ExactMedianModel:
        cols = self.getOrDefault(self.inputCols)
        found = exact_quantiles_multi(dataset, cols, [0.5])
        model = ExactMedianModel()
        return model._set(inputCols=cols, outputCols=self.getOrDefault(self.outputCols),
                          medians=[math.nan if found[c][0] is None else found[c][0] for c in cols])


def build_pipeline(categorical: list[str], numeric: list[str], model) -> Pipeline:
    """M6: index -> one-hot -> assemble -> model."""
    stages = indexers(categorical)
    if categorical:
        stages.append(one_hot(categorical))
    stages.append(assembler(numeric + [f"{c}_ohe" for c in categorical]))
    stages.append(model)
    return Pipeline(stages=stages)


def random_split(df: DataFrame, train: float = 0.7, seed: int = 42):
    """M7."""
    return df.randomSplit([train, 1 - train], seed=seed)


def drawn_rows(df: DataFrame, train: float = 0.7, seed: int = 42, flag: str = "is_train") -> DataFrame:
    """M7: ``df`` with a flag for the rows that ``random_split`` puts into its first part,
    kept after one pass (each part of ``random_split`` sorts all rows anew whenever it is
    read).  The caller unpersists it."""
    ordered = df.sortWithinPartitions(*df.columns)
    return ordered.withColumn(flag, F.rand(seed) < train).persist(StorageLevel.MEMORY_AND_DISK)


#: Rows that make a training task worth its overhead, and rows it should not exceed.
TASK_ROWS, MOST_TASK_ROWS = 50_000, 1_000_000


def task_count(spark: SparkSession, rows: int) -> int:
    """Tasks for a pass over so many training rows."""
    return max(1, min(rows // TASK_ROWS, max(spark.sparkContext.defaultParallelism, rows // MOST_TASK_ROWS)))


def spread_rows(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over the session's cores if a few of its partitions hold
    most rows (a file of one row group is one task in each of a model's passes).
    A small table stays as it is."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    total = sum(sizes)
    n = task_count(df.sparkSession, total)
    return df.repartition(n) if max(sizes, default=0) > 2 * total / n else df


def weighted_rows(df: DataFrame, features: list[str], label: str, weight: str = "weight") -> DataFrame:
    """One row per distinct feature values: their number as ``weight`` and their mean label.

    To trees that split by variance, without row sampling, this is the same data:
    sums of weights and of weighted labels are equal in every node, and what labels
    vary within equal features is in no split's gain.  A null label stays null, as
    models refuse those."""
    mean = F.when(F.count(label) == F.count(F.lit(1)), F.avg(label)).alias(label)
    return df.groupBy(*features).agg(F.count(F.lit(1)).cast("double").alias(weight), mean)


#: Trees train on cells of binned features beyond so many rows.  Most bins of a feature (Spark's default).
CELLS_BEYOND, BINS = 1_000_000, 32
#: Rows whose bootstrap counts are drawn at once; trees of a forest that train at the same time.
DRAW_ROWS, TREES_AT_ONCE = 1 << 15, 3


def bin_thresholds(df: DataFrame, features: list[str], bins: int = BINS) -> dict[str, list[float]]:
    """Ascending split candidates per feature, as Spark's trees choose them: between any
    two neighbours of at most ``bins`` values, else the ``bins``-quantiles (of all rows
    here, of some 10,000 there).  Quantiles that fall on one value leave room for those
    of the other values."""
    def value(c):
        return F.when(~F.isnan(c), F.col(c).cast("double"))

    def found(cols: list[str], what) -> dict:
        return df.agg(*[what(value(c)).alias(c) for c in cols]).first().asDict() if cols else {}

    numbers = found(features, F.approx_count_distinct)              # off by a few hundredths
    few = found([c for c in features if numbers[c] <= 2 * bins], lambda v: F.sort_array(F.collect_set(v)))
    few = {c: values for c, values in few.items() if len(values) <= bins}
    out = {c: [] for c in features if c not in few}
    for _ in range(2):
        room = {c: bins - 1 - len(limits) for c, limits in out.items() if len(limits) < bins - 1}
        more = [F.percentile_approx(F.when(~value(c).isin(out[c]), value(c)), [i / (k + 1) for i in range(1, k + 1)], 1_000).alias(c)
                for c, k in room.items()]
        for c, values in (df.agg(*more).first().asDict() if more else {}).items():
            out[c] = sorted({*out[c], *(values or [])})
    for c, values in few.items():
        middle = [(a, (a + b) / 2) for a, b in zip(values, values[1:])]
        out[c] = [m if math.isfinite(m) else a for a, m in middle]
    return out


def bin_features(df: DataFrame, thresholds: dict[str, list[float]], strict: bool = False) -> DataFrame:
    """Each feature replaced by the number of its thresholds below it, as a double.  A tree
    tells rows apart by nothing else; NULL and NaN lie above all thresholds, as in a tree.
    ``strict``: NULL, NaN and infinite values become NaN (models refuse to train on them)."""
    cut = {c: limits for c, limits in thresholds.items() if limits}
    df = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(math.nan)) for c in thresholds})
    if cut:
        # a bucket begins with its lower end, a bin after it; NaN gets a bucket of its own
        df = Bucketizer(inputCols=list(cut), outputCols=[f"{c}_bin" for c in cut], handleInvalid="keep",
                        splitsArray=[[-math.inf, *(math.nextafter(t, math.inf) for t in limits), math.inf]
                                     for limits in cut.values()]).transform(df)

    def code(c: str):
        bin_ = F.least(F.col(f"{c}_bin"), F.lit(float(len(cut[c])))) if c in cut else F.lit(0.0)
        odd = F.isnan(c) | (F.abs(c) == math.inf)
        return F.when(odd, math.nan).otherwise(bin_) if strict else bin_
    return df.withColumns({c: code(c) for c in thresholds}).drop(*[f"{c}_bin" for c in cut])


def cell_number(features: list[str], bins: int = BINS):
    """One BIGINT for a row's bins; ``cell_features`` turns it back."""
    if bins ** len(features) >= 2 ** 63:
        raise ValueError(f"{len(features)} features of {bins} bins have no cell number")
    return sum((F.col(c).cast("long") * bins ** i for i, c in enumerate(features)), F.lit(0).cast("long")).alias("cell")


def cell_features(features: list[str], bins: int = BINS) -> list:
    return [F.expr(f"CAST(cell DIV {bins ** i} % {bins} AS DOUBLE)").alias(c) for i, c in enumerate(features)]


def bootstrap_cells(binned: DataFrame, cells: DataFrame, features: list[str], label: str, trees: int,
                    rate: float = 1.0, seed: int = 42) -> DataFrame:
    """(tree, cell, weight, label): the bootstrap samples of a forest, added up per tree and
    cell of equal features.

    Each row gets a Poisson(``rate``) count for each tree, as in Spark's forest: a
    Poisson number of draws with replacement gives its rows just such counts.  Rows meet
    by cell; one of very many rows (``cells``: ``weighted_rows`` of ``binned``) is dealt
    to several tasks, whose sums a tree adds up.  Tasks order their rows, so a sample
    depends on rows and seed alone."""
    total = int(cells.agg(F.sum("weight")).first()[0] or 0)
    n = task_count(binned.sparkSession, total)
    cell = cell_number(features)
    hot = [r[0] for r in cells.filter(F.col("weight") > total / (2 * n)).select(cell).collect()] if n > 1 else []
    slot = F.when(F.col("cell").isin(hot), F.floor(F.rand(seed) * n)).otherwise(0)
    rows = binned.select(cell, F.col(label).cast("double").alias("y")).withColumn("slot", slot).repartition(n, "cell", "slot")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False))
                 for b in batches if b.num_rows]
        if not parts:
            return
        code, y, part = (np.concatenate(x) for x in zip(*parts))
        del parts
        order = np.lexsort((y, part, code))
        code, y, part = code[order], y[order], part[order]
        first = np.r_[True, code[1:] != code[:-1]]
        at, own = np.cumsum(first) - 1, code[first]
        rng = np.random.default_rng([seed % 2 ** 63, int(code[0]), int(part[0])])
        weight, summed = np.zeros((trees, len(own))), np.zeros((trees, len(own)))
        for a in range(0, len(code), DRAW_ROWS):
            some, v = at[a:a + DRAW_ROWS], y[a:a + DRAW_ROWS]
            starts, m = np.flatnonzero(np.r_[True, some[1:] != some[:-1]]), len(some)
            here = slice(some[0], some[-1] + 1)
            for t in range(trees):
                times = np.bincount(rng.integers(0, m, rng.poisson(rate * m), dtype=np.int32), minlength=m)
                weight[t, here] += np.add.reduceat(times, starts)
                summed[t, here] += np.add.reduceat(times * v, starts)
        for t in range(trees):
            w = weight[t]
            in_it = w > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(in_it.sum(), t, np.int32)), pa.array(own[in_it]), pa.array(w[in_it]), pa.array(summed[t][in_it] / w[in_it])],
                names=["tree", "cell", "weight", label])

    return rows.mapInArrow(sums, f"tree int, cell long, weight double, `{label}` double")


def fit_forest_on_cells(forest: RandomForestRegressor, samples: DataFrame, features: list[str]) -> RandomForestRegressionModel:
    """``forest`` trained on its bootstrap samples (``bootstrap_cells``): Spark trains each
    tree on the cells of its sample, some at a time, with the features of a node drawn
    as in a forest; the trees make one model."""
    spark, trees = samples.sparkSession, forest.getNumTrees()
    path, label = scratch_path(spark, "forest"), forest.getLabelCol()
    samples.repartition("tree").sortWithinPartitions("tree", "cell", "weight", label).write.partitionBy("tree").parquet(path)
    subset = forest.getFeatureSubsetStrategy()
    one = forest.copy().setNumTrees(1).setBootstrap(False).setSubsamplingRate(1.0).setWeightCol("weight")
    one = one.setFeatureSubsetStrategy("onethird" if subset == "auto" and trees > 1 else subset)
    largest = spark.read.parquet(path).groupBy("tree").count().agg(F.max("count")).first()[0]
    one = with_all_bins(one, largest or 0)
    vectors = assembler(features, forest.getFeaturesCol())

    def tree(t: int):
        rows = spark.read.schema(f"cell long, weight double, `{label}` double").parquet(f"{path}/tree={t}")
        rows = vectors.transform(rows.select(*cell_features(features), "weight", label))
        return one.copy().setSeed(forest.getSeed() + t).fit(rows)._java_obj.trees()[0]

    with ThreadPoolExecutor(TREES_AT_ONCE) as pool:
        grown = list(pool.map(tree, range(trees)))
    sc, ml = spark.sparkContext, spark.sparkContext._jvm.org.apache.spark.ml.regression
    array = sc._gateway.new_array(ml.DecisionTreeRegressionModel, trees)
    for t, x in enumerate(grown):
        array[t] = x
    model = forest._copyValues(RandomForestRegressionModel(ml.RandomForestRegressionModel(forest.uid, array, len(features))))
    model._transfer_params_to_java()
    return model


def with_all_bins(model, rows: int):
    """``model`` with so many bins that Spark looks at all ``rows`` for its split candidates,
    not at a sample; bins that no value needs are not made."""
    return model.setMaxBins(max(model.getMaxBins(), min(math.isqrt(rows) + 1, 46_340)))  # its square is an int


def fit_on_cells(models: dict, train: DataFrame, test: DataFrame, features: list[str], label: str):
    """The fitted ``models`` (boosted trees with a weight column, or forests), and ``test``
    with the features that they know.  All see ``train`` through the same binned features,
    as trees do: work per tree grows with the cells (``BINS`` per feature at most), not with rows."""
    limits = bin_thresholds(train, features)
    binned, test = bin_features(train, limits, strict=True), bin_features(test, limits)
    cells = weighted_rows(binned, features, label).persist()
    n, odd = cells.agg(F.count(F.lit(1)), F.max(F.greatest(*[F.isnan(c).cast("int") for c in [*features, features[0]]]))).first()
    if odd:
        raise ValueError(f"NULL, NaN or infinite values in {features}: models are not trained on them")

    def fit(model):
        if isinstance(model, RandomForestRegressor):
            rate, seed = model.getSubsamplingRate(), model.getSeed()
            samples = bootstrap_cells(binned, cells, features, label, model.getNumTrees(), rate, seed)
            return fit_forest_on_cells(model, samples, features)
        rows = assembler(features).transform(cells.coalesce(task_count(cells.sparkSession, n))).persist()
        fitted = with_all_bins(model, n).fit(rows)
        rows.unpersist()
        return fitted

    with ThreadPoolExecutor(len(models)) as pool:
        fitted = dict(zip(models, pool.map(fit, models.values())))
    cells.unpersist()
    return fitted, test


#: Cells that every task may hold.
MOST_CELLS_SENT = 1 << 20


def predict_on_cells(model, binned: DataFrame, features: list[str]) -> DataFrame:
    """``binned`` with the model's ``prediction``, made once per cell."""
    cell = cell_number(features)
    made = model.transform(assembler(features).transform(binned.select(*features).distinct())).select(cell, "prediction")
    few = BINS ** len(features) <= MOST_CELLS_SENT
    return binned.select("*", cell).join(F.broadcast(made) if few else made, "cell").drop("cell")


def hash_bucket(key: str):
    """Deterministic 0..99 bucket from the md5 of a key (engine-independent)."""
    return (F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 4), 16, 10).cast("int") % 100)


def hash_split(df: DataFrame, key: str, train_pct: int = 70) -> DataFrame:
    """M8: deterministic split; applied within each class it keeps class
    proportions (the intent of a stratified split), with no shuffle."""
    return df.withColumn("split", F.when(hash_bucket(key) < train_pct, "train").otherwise("test"))


def stratified_sample(df: DataFrame, label: str, fractions: dict, seed: int = 42) -> DataFrame:
    """M8/M9: per-class Bernoulli sample (``sampleBy``)."""
    return df.sampleBy(label, fractions, seed)


# ---- fixed values: model hyper-parameters of the original notebooks -------
def rf_classifier(label: str = "label", trees: int = 100, depth: int = 10, subsample: float = 0.7):
    """M10."""
    return RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth,
                                  subsamplingRate=subsample, seed=42)


def gbt_classifier(label: str = "label", iters: int = 100, depth: int = 6, step: float = 0.1,
                   subsample: float = 0.8):
    """M11."""
    return GBTClassifier(labelCol=label, featuresCol="features", maxIter=iters, maxDepth=depth,
                         stepSize=step, subsamplingRate=subsample, seed=42)


def gbt_regressor(label: str, iters: int = 100, depth: int = 6, step: float = 0.1):
    """M12."""
    return GBTRegressor(labelCol=label, featuresCol="features", maxIter=iters, maxDepth=depth,
                        stepSize=step, seed=42)


def rf_regressor(label: str, trees: int = 100, depth: int = 10):
    """M13."""
    return RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth,
                                 seed=42)


def kmeans(k: int = 5, seed: int = 42, features: str = "features"):
    """M14."""
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster")


def cluster_centres(spark: SparkSession, model, columns: list[str], scaling=None) -> DataFrame:
    """(cluster, feature, centre) of a fitted k-means; with the fitted ``scaling``
    (StandardScalerModel) its input went through, in the features' own units."""
    rows = []
    for k, centre in enumerate(model.clusterCenters()):
        for i, c in enumerate(columns):
            value = float(centre[i])
            if scaling is not None:
                value = value * (scaling.std[i] if scaling.getWithStd() else 1.0) + (scaling.mean[i] if scaling.getWithMean() else 0.0)
            rows.append((k, c, float(value)))
    return spark.createDataFrame(rows, "cluster int, feature string, centre double")


def prediction_sample(pred: DataFrame, columns: list[str], order: list[str], n: int = 20) -> DataFrame:
    """The first ``n`` predictions by ``order``, to look at."""
    return pred.select(*columns).orderBy(*order).limit(n)


# ---- evaluation -------------------------------------------------------------

def binary_metrics(pred: DataFrame, label: str = "label") -> dict:
    """areaUnderROC and areaUnderPR."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction")
    return {m: ev.setMetricName(m).evaluate(pred) for m in ("areaUnderROC", "areaUnderPR")}


def multiclass_metrics(pred: DataFrame, label: str = "label") -> dict:
    """M16 with Spark's evaluator."""
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction")
    return {m: ev.setMetricName(m).evaluate(pred)
            for m in ("accuracy", "f1", "weightedPrecision", "weightedRecall")}


def regression_metrics_eval(pred: DataFrame, label: str) -> dict:
    """M17 with Spark's evaluator."""
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction")
    return {m: ev.setMetricName(m).evaluate(pred) for m in ("rmse", "mse", "mae", "r2")}


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction) counts."""
    return pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M16 in one pass: accuracy and support-weighted precision / recall / F1.

    Per-class counts come from the confusion table (classes x classes rows),
    so the metrics need only aggregates over a tiny table.
    """
    cm = confusion(pred, label, prediction)
    per_label = cm.groupBy(F.col(label).alias("c")).agg(F.sum("n").alias("support"),
                                                         F.sum(F.when(F.col(label) == F.col(prediction), F.col("n"))
                                                               .otherwise(0)).alias("tp"))
    per_pred = cm.groupBy(F.col(prediction).alias("c")).agg(F.sum("n").alias("predicted"))
    per = per_label.join(per_pred, "c", "left").fillna(0, ["predicted"])
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.try_divide(F.col("tp"), F.col("support"))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    total = F.sum("support")
    return per.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(prec * F.col("support")) / total).alias("weighted_precision"),
        (F.sum(rec * F.col("support")) / total).alias("weighted_recall"),
        (F.sum(f1 * F.col("support")) / total).alias("f1"),
    )


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """M17/M18 in one aggregate: rmse, mse, mae, r2, mape."""
    err = F.col(prediction) - F.col(label)
    agg = pred.agg(F.count(F.lit(1)).alias("n"), F.sum(err * err).alias("sse"), F.sum(F.abs(err)).alias("sae"),
                   F.avg(label).alias("mean"), F.sum(F.col(label) * F.col(label)).alias("s2"),
                   F.avg(fx.pct_error(prediction, label)).alias("mape"))
    sst = F.col("s2") - F.col("n") * F.col("mean") * F.col("mean")
    return agg.select((F.sqrt(F.col("sse") / F.col("n"))).alias("rmse"), (F.col("sse") / F.col("n")).alias("mse"),
                      (F.col("sae") / F.col("n")).alias("mae"), (1 - F.col("sse") / sst).alias("r2"), "mape")


def metric_table(spark: SparkSession, model_type: str, metrics: dict) -> DataFrame:
    """(model_type, metric, value) rows."""
    return spark.createDataFrame([(model_type, k, float(v)) for k, v in metrics.items()],
                                 "model_type string, metric string, value double")


def feature_importances(spark: SparkSession, model, transformed: DataFrame,
                        features_col: str = "features") -> DataFrame:
    """Importances named from the vector's ``ml_attr`` metadata (one name
    per slot, one-hot slots included), descending."""
    meta = transformed.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    names = {}
    for group in meta.values():
        for a in group:
            names[a["idx"]] = a["name"]
    imp = model.featureImportances.toArray()
    rows = [(names.get(i, f"f{i}"), float(v)) for i, v in enumerate(imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


def worst_predictions(pred: DataFrame, label: str, k: int = 20, keys: list[str] | None = None,
                      prediction: str = "prediction") -> DataFrame:
    """The k largest absolute errors (ties broken by the keys)."""
    out = pred.withColumn("abs_error", fx.abs_error(prediction, label))
    return out.orderBy(F.desc("abs_error"), *(keys or [])).limit(k)


def vector_columns(df: DataFrame, vec: str, names: list[str]) -> DataFrame:
    """Expand a vector column into named double columns."""
    arr = vector_to_array(vec)
    return df.select("*", *[arr[i].alias(n) for i, n in enumerate(names)]).drop(vec)
