"""Model training, scoring and forecasting on tables."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator, RegressionEvaluator
from pyspark.ml.feature import PCA, Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from loomtab.operators.density import density_clusters, reduced
from loomtab.operators.neighbors import nearest
from loomtab.operators.ordered import exact_quantiles, framed
from loomtab.operators.windows import top_per_group
from loomtab.session import written
from loomtab.sources.tables import numeric_columns

_CLASSIFIERS = {
    "boosted_trees_depth_4": lambda **p: GBTClassifier(**{"maxIter": 20, "maxDepth": 4, "seed": 1, **p}),
    "gradient_boosting": lambda **p: GBTClassifier(**{"maxIter": 20, "maxDepth": 3, "seed": 1, **p}),
    "random_forest": lambda **p: RandomForestClassifier(**{"numTrees": 50, "maxDepth": 6, "seed": 1, **p}),
    "logistic_regression": lambda **p: LogisticRegression(**{"maxIter": 50, "regParam": 1e-3, **p}),
}

# With these, boosted trees look at single rows.
_BY_ROW = {"subsamplingRate", "minInstancesPerNode", "validationIndicatorCol"}
_BIN = "_bin_of_"
FOLDED_ROWS = 20_000
"""Folded rows of a task, about, as far as there are shuffle partitions."""


def _spread_rows(rows: DataFrame) -> DataFrame:
    """Iterative training reads its rows many times: use every core for them."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def train_classifier(df: DataFrame, target: str, algorithm: str, features: Sequence[str] | None = None,
                     positive_weight: float | None = None, **params) -> PipelineModel:
    """One interface for the binary classifiers; numeric columns minus the target are the features.

    Positive rows weigh ``positive_weight``, by default negatives / positives.
    Boosted names and the forest train Spark's trees, on rows folded by the bins of their features: the trees see no more of a row than its bins.
    """
    if algorithm not in _CLASSIFIERS:
        raise ValueError(f"unknown algorithm {algorithm!r}; one of {sorted(_CLASSIFIERS)}")
    cols = list(features or numeric_columns(df, (target,)))
    if positive_weight is None:
        neg, pos = df.agg(F.count_if(F.col(target) == 0), F.count_if(F.col(target) == 1)).first()
        positive_weight = neg / pos if pos else 1.0
    rows = df.select(*cols, F.col(target).cast("double").alias("label"),
                     F.when(F.col(target) == 1, float(positive_weight)).otherwise(1.0).alias("weight"))
    model = _CLASSIFIERS[algorithm](labelCol="label", weightCol="weight", featuresCol="features", **params)
    if isinstance(model, GBTClassifier | RandomForestClassifier) and not _BY_ROW & params.keys():
        bins, join = binned(rows, cols, model.getMaxBins())
        few = folded(bins, rows)
        return PipelineModel([bins, join, forest(model, few, join) if isinstance(model, RandomForestClassifier) else model.fit(joined_bins(join, few))])
    return Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip"), model]).fit(_spread_rows(rows))


def binned(rows: DataFrame, cols: Sequence[str], bins: int) -> tuple[Bucketizer, VectorAssembler]:
    """The columns to their bins, and the bins to ``features``."""
    cut = Bucketizer(splitsArray=[[-math.inf, *b, math.inf] for b in bin_borders(rows, cols, bins)], inputCols=list(cols),
                     outputCols=[f"{_BIN}{c}" for c in cols], handleInvalid="skip")
    return cut, VectorAssembler(inputCols=cut.getOutputCols(), outputCol="features")


def joined_bins(join: VectorAssembler, few: DataFrame) -> DataFrame:
    """``features`` without the note that bins are categories: trees are to split them in their order."""
    return join.transform(few).withMetadata("features", {})


def bin_borders(df: DataFrame, cols: Sequence[str], bins: int) -> list[list[float]]:
    """Borders of at most ``bins`` bins per column: halfway between values where there are so few, else quantiles of the rows without missing values."""
    rows = df.dropna(subset=list(cols))
    about = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    out = []
    for c in cols:
        values = sorted(float(r[0]) for r in rows.select(F.col(c).cast("double")).distinct().collect()) if about[c] <= 2 * bins else []
        if 0 < len(values) <= bins:
            borders = [(a + b) / 2 for a, b in zip(values, values[1:])]
        else:
            lowest, *quantiles = rows.approxQuantile(c, [i / bins for i in range(bins)], 1e-3) or [0.0]
            borders = sorted({q for q in quantiles if q > lowest})
        out.append([b for b in borders if math.isfinite(b)] or [values[0] if values and math.isfinite(values[0]) else 0.0])
    return out


def folded(bins: Bucketizer, rows: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """One row for each label, combination of bins and value of ``more``, with the summed weight and the ``rows``: their number is bounded by the bins, not by the rows."""
    by = [*bins.getOutputCols(), "label", *more]
    out = written(bins.transform(rows).groupBy(*by).agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("rows")), "folded")
    return out.repartition(max(out.sparkSession.sparkContext.defaultParallelism, min(int(out.sparkSession.conf.get("spark.sql.shuffle.partitions")), out.count() // FOLDED_ROWS)))


def drawn_times(few: DataFrame, by: Sequence[str], trees: int, rate: float, seed: int) -> DataFrame:
    """``drawn``: how many rows of each folded one every tree draws with replacement.

    A forest draws each row a Poisson number of times for each tree, apart from all others; the sum over n rows is Poisson too, of n times the
    mean, so drawing it at once for n equal rows gives the same forest in distribution. Draws follow from the row, not from its place.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            draws = [np.random.default_rng(h % 2 ** 64).poisson(n * rate, trees) for h, n in zip(f.pop("_h").tolist(), f["rows"].tolist())]
            yield f.assign(drawn=draws)

    schema = StructType([*few.schema.fields, *StructType.fromDDL("drawn array<long>").fields])
    return written(few.withColumn("_h", F.xxhash64(F.lit(seed), *by)).mapInPandas(run, schema), "drawn")


def forest(model: RandomForestClassifier, few: DataFrame, join: VectorAssembler, more: Sequence[str] = (), at_once: int = 8) -> RandomForestClassificationModel:
    """The forest of folded rows (bins, label, weight, rows, ``more``): each tree is trained on the rows it draws, weighed by how often.

    As rows of one label have one weight, so has each of the rows folded into one. A tree that draws nothing at all sees every row.
    """
    count, ways, rng = model.getNumTrees(), model.getFeatureSubsetStrategy(), np.random.default_rng(model.getSeed() % 2 ** 64)
    seeds = rng.integers(0, 2 ** 62, count).tolist()
    # A single tree draws no rows and tries all features, as Spark has it.
    bagged, ways = model.getBootstrap() and count > 1, "sqrt" if ways == "auto" and count > 1 else ways
    if bagged:
        few = drawn_times(few, [*join.getInputCols(), "label", *more], count, model.getSubsamplingRate(), model.getSeed())
    highest, held, *drew = few.agg(F.max("label"), F.count(F.lit(1)), *[F.sum(F.col("drawn")[i]) for i in range(count) if bagged]).first()
    if highest is None:
        raise ValueError("no rows to train on")
    classes = {"ml_attr": {"type": "nominal", "num_vals": int(highest) + 1, "name": "label"}}  # a tree may draw rows of one label only
    rows = joined_bins(join, few).withMetadata("label", classes).coalesce(max(1, held // FOLDED_ROWS))  # several trees are trained at a time

    def tree(i: int) -> RandomForestClassificationModel:
        times = F.col("drawn")[i] / F.col("rows") if bagged and drew[i] else F.lit(1.0)
        one = model.copy({model.numTrees: 1, model.bootstrap: False, model.featureSubsetStrategy: ways, model.seed: seeds[i], model.weightCol: "weight"})
        return one.fit(rows.select("features", "label", (F.col("weight") * times).alias("weight")).where("weight > 0"))

    with ThreadPool(at_once) as pool:
        trained = pool.map(inheritable_thread_target(few.sparkSession)(tree), range(count))
    return joined(model, trained)


def joined(model: RandomForestClassifier, trained: Sequence[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """One forest of the trees of several; Spark has no public way to make it but this constructor."""
    from pyspark.sql import SparkSession

    context = SparkSession.active().sparkContext
    kinds, parts = context._jvm.org.apache.spark.ml.classification, [t for m in trained for t in m._java_obj.trees()]
    trees = context._gateway.new_array(kinds.DecisionTreeClassificationModel, len(parts))
    for i, t in enumerate(parts):
        trees[i] = t
    java = kinds.RandomForestClassificationModel(model.uid, trees, trained[0].numFeatures, trained[0].numClasses)
    out = model._copyValues(RandomForestClassificationModel(java))
    out._transfer_params_to_java()
    return out


def feature_importance(model: PipelineModel) -> DataFrame:
    """(feature, importance), best first: the gains of a tree model, the absolute coefficients of a linear one."""
    from pyspark.sql import SparkSession

    names, last = model.stages[0].getInputCols(), model.stages[-1]
    values = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    rows = [(n, abs(float(v))) for n, v in zip(names, values.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def train_linear(df: DataFrame, target: str, features: Sequence[str], **params) -> PipelineModel:
    line = LinearRegression(labelCol=target, featuresCol="features", **params)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip"), line]).fit(_spread_rows(df))


def cross_validated_r2(df: DataFrame, key: str, target: str, features: Sequence[str], folds: int = 5, seed: int = 1,
                       train: Callable[..., PipelineModel] | None = None) -> DataFrame:
    """(folds, mean_score, std_score): share of the variance explained on the rows left out; folds follow a seeded hash of the key."""
    from loomtab.operators.splits import seeded_key

    fold = F.pmod(F.conv(F.substring(seeded_key(key, seed), 1, 7), 16, 10).cast("long"), F.lit(folds))
    rows = df.withColumn("_fold", fold)
    scores = []
    for i in range(folds):
        model = (train or train_linear)(rows.where(F.col("_fold") != i), target, features)
        scored = model.transform(rows.where(F.col("_fold") == i))
        scores.append(RegressionEvaluator(labelCol=target, predictionCol="prediction", metricName="r2").evaluate(scored))
    return df.sparkSession.createDataFrame([(folds, float(np.mean(scores)), float(np.std(scores)))], "folds int, mean_score double, std_score double")


def rank_experiments(runs: DataFrame, name: str, first: str, second: str) -> DataFrame:
    """Runs by their first metric, then the second, then the name: ``rank``, ``best`` and the ``gap`` of each to the best."""
    w = Window.orderBy(F.desc_nulls_last(first), F.desc_nulls_last(second), name)  # one row per experiment
    out = runs.withColumn("rank", F.row_number().over(w))
    return out.withColumns({"best": F.col("rank") == 1, "gap": runs.agg(F.max(first)).scalar() - F.col(first)})


def save_model(model: PipelineModel, path: str, features: Sequence[str], target: str) -> None:
    """The fitted pipeline and, beside it, its feature columns and target."""
    from pyspark.sql import SparkSession

    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    spark.createDataFrame([(json.dumps({"features": list(features), "target": target}),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load_model(spark, path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), json.loads(spark.read.text(f"{path}/about").first()[0])


def predict_table(model: PipelineModel, df: DataFrame, target: str | None = None, cut: float = 0.5) -> DataFrame:
    """Adds predicted_prob (6 digits), predicted_class and, with a target, correct."""
    out = model.transform(df).withColumn("predicted_prob", F.round(vector_to_array("probability")[1], 6))
    out = out.withColumn("predicted_class", (F.col("predicted_prob") >= cut).cast("int"))
    if target:
        out = out.withColumn("correct", F.col("predicted_class") == F.col(target))
    return out.drop("features", "rawPrediction", "probability", "prediction", *[c for c in out.columns if c.startswith(_BIN) and c not in df.columns])


def train_regressor(df: DataFrame, target: str, features: Sequence[str], **params) -> PipelineModel:
    gbt = GBTRegressor(labelCol=target, featuresCol="features", **{"maxIter": 10, "maxDepth": 4, "seed": 1, **params})
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip"), gbt]).fit(_spread_rows(df))


def train_naive_bayes(df: DataFrame, target: str, features: Sequence[str]) -> PipelineModel:
    nb = NaiveBayes(modelType="gaussian", labelCol=target, featuresCol="features")
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip"), nb]).fit(_spread_rows(df))


def knn_classify(train: DataFrame, rows: DataFrame | None, key: str, vector: str, label: str, k: int) -> DataFrame:
    """(key, predicted): vote of the k exact nearest training rows, ties to the smaller label.

    Without ``rows`` every training row is classified by the others.
    """
    near = nearest(train, key, vector, k, queries=rows)
    votes = (near.join(train.select(F.col(key).alias("neighbor"), F.col(label).alias("_y")), "neighbor")
             .groupBy(key, "_y").agg(F.count(F.lit(1)).alias("_n")))
    return votes.groupBy(key).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col("_y").alias("y")))["y"].alias("predicted"))


def _vectors(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="skip").transform(df)


def kmeans(df: DataFrame, cols: Sequence[str], k: int = 2, seed: int = 1) -> tuple[DataFrame, float, list[list[float]]]:
    """(rows with cluster, silhouette, centres)."""
    rows = _vectors(df, cols)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(rows)
    out = model.transform(rows)
    score = ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(out)
    return out.drop("features"), score, [list(map(float, c)) for c in model.clusterCenters()]


def soft_clusters(df: DataFrame, key: str, vector: str, components: int = 5, neighbors: int = 15, min_size: int = 50, top: int | None = None) -> DataFrame:
    """(key, cluster, memberships): clusters by density after a PCA, NULL for noise; of all clusters, or of the ``top`` that a row joins first."""
    return density_clusters(reduced(df, key, vector, components), key, vector, neighbors, min_size, top)


def grid_search(df: DataFrame, target: str, features: Sequence[str], depths: Sequence[int], folds: int = 3, parallelism: int = 4) -> DataFrame:
    """(max_depth, mean_score): mean cross-validated area under ROC per value, best first.

    Rows are dealt to folds one by one, then folded by fold, label and bins (borders of all rows); forests are trained and scored on these.
    """
    tree = RandomForestClassifier(numTrees=10, seed=1)
    dealt = df.select(*features, F.col(target).cast("double").alias("label"), F.lit(1.0).alias("weight"), F.floor(F.rand(1) * folds).alias("_fold"))
    bins, join = binned(dealt, features, tree.getMaxBins())
    few, judge = folded(bins, dealt, ["_fold"]), BinaryClassificationEvaluator(weightCol="weight")

    def score(depth: int, i: int) -> float:
        model = forest(tree.copy({tree.maxDepth: depth}), few.where(F.col("_fold") != i), join, ["_fold"], parallelism)
        return judge.evaluate(model.transform(join.transform(few.where(F.col("_fold") == i))))

    means = [(int(d), float(np.mean([score(d, i) for i in range(folds)]))) for d in depths]
    return df.sparkSession.createDataFrame(means, "max_depth int, mean_score double").orderBy(F.desc("mean_score"), "max_depth")


def regression_mae(scored: DataFrame, target: str) -> float:
    return RegressionEvaluator(labelCol=target, predictionCol="prediction", metricName="mae").evaluate(scored)


def score_batches(df: DataFrame, key: str, features: Sequence[str], load: Callable[[], Callable[[np.ndarray], np.ndarray]],
                  batch: int = 30) -> DataFrame:
    """(key, score): a model loaded once per task, applied to small row batches."""
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for f in frames:
            x = f[list(features)].to_numpy(dtype=float)
            scores = [model(x[i:i + batch]) for i in range(0, len(x), batch)]
            yield pd.DataFrame({key: f[key].to_numpy(), "score": np.concatenate(scores) if scores else np.empty(0)})

    return df.select(key, *features).mapInPandas(run, f"`{key}` {kind}, score double")


# ---- forecasting -------------------------------------------------------------------

def forecast_series(df: DataFrame, series: str, date: str, value: str, steps: int, season: int = 7) -> DataFrame:
    """(series, date, seasonal_naive, drift): the next ``steps`` days of each daily series.

    Only the last season, the first and the last point and the count are
    needed, all of which aggregate map-side; no series is loaded whole.
    """
    ends = df.groupBy(series).agg(F.min(F.struct(date, value)).alias("_a"), F.max(F.struct(date, value)).alias("_z"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(series).orderBy(F.desc(date))
    tail = df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= season).select(series, "_r", F.col(value).alias("_season"))
    ahead = ends.withColumn("_h", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    ahead = ahead.withColumn("_r", season - F.pmod(F.col("_h") - 1, F.lit(season)))
    slope = (F.col(f"_z.{value}") - F.col(f"_a.{value}")) / F.greatest(F.col("_n") - 1, F.lit(1))
    return ahead.join(tail, [series, "_r"], "left").select(
        series, F.date_add(F.to_date(F.col(f"_z.{date}")), F.col("_h")).alias("date"), F.col("_season").alias("seasonal_naive"),
        (F.col(f"_z.{value}") + F.col("_h") * slope).alias("drift"))


def forecast_custom(df: DataFrame, series: str, date: str, value: str, fn: Callable[[np.ndarray, int], np.ndarray], steps: int,
                    history: int) -> DataFrame:
    """(series, date, forecast) by a function of the newest ``history`` points of each series.

    The points are limited before the shuffle, so a long series sends at most
    ``history`` rows per task; ``history`` is the method's look-back.
    """
    points = df.select(series, F.to_date(date).alias(date), F.col(value).cast("double").alias(value))
    recent = top_per_group(points, [series], [F.desc(date)], history)
    kind = df.schema[series].dataType.simpleString()

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(date)
        last = f[date].iloc[-1]
        out = np.asarray(fn(f[value].to_numpy(), steps), dtype=float)
        days = [last + pd.Timedelta(days=i + 1) for i in range(steps)]
        return pd.DataFrame({series: f[series].iloc[0], "date": days, "forecast": out})

    return recent.groupBy(series).applyInPandas(run, f"`{series}` {kind}, date date, forecast double")


def residual_quantiles(df: DataFrame, series: str, actual: str, naive: str, probs: Sequence[float]) -> DataFrame:
    """Naive forecast plus the residual quantiles of its series: columns q{i}."""
    res = df.withColumn("_e", F.col(actual) - F.col(naive))
    q = exact_quantiles(res.where("_e is not null"), [series], ["_e"], probs)
    return res.join(q, series).withColumns({f"q{i}": F.col(naive) + F.col(f"_e_q{i}") for i in range(len(probs))}).drop("_e")


def ensemble_stats(df: DataFrame, cell: Sequence[str], value: str) -> DataFrame:
    """(cell..., mean, spread, mean_spread): over members per cell, and the mean spread of all cells."""
    per = df.groupBy(*cell).agg(F.avg(value).alias("mean"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("spread"))
    return per.withColumn("mean_spread", per.agg(F.avg("spread")).scalar())


def convergence(df: DataFrame, run: str, iteration: str, value: str, threshold: float) -> DataFrame:
    """Change rate against the iteration before and whether it fell below the threshold."""
    out = framed(df, [run], [iteration], 1, 0, lambda w: {"_p": F.lag(value).over(w)})
    rate = F.abs(F.col(value) - F.col("_p")) / F.greatest(F.abs("_p"), F.lit(1e-12))
    return out.withColumn("change_rate", rate).withColumn("converged", F.coalesce(rate < threshold, F.lit(False))).drop("_p")
