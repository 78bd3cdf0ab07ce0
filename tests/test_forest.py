"""Forests of folded rows against Spark's on single rows."""

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from loomtab.operators import metrics as M, ml as L
from test_boosted import drawn


def test_forest_as_on_all_rows(spark, tmp_path):
    df = spark.createDataFrame(drawn(4000) + [(None, 1.0, 2, 1)], "x double, y double, k int, target int")
    model = L.train_classifier(df, "target", "random_forest", numTrees=12, maxDepth=5)
    plain = L.train_classifier(df, "target", "random_forest", numTrees=12, maxDepth=5, minInstancesPerNode=1)  # named, so single rows are looked at
    assert type(model.stages[0]) is Bucketizer and type(plain.stages[0]) is not Bucketizer
    last = model.stages[-1]
    assert type(last) is RandomForestClassificationModel and last.getNumTrees == 12 and last.numClasses == 2 and len({t.toDebugString for t in last.trees}) > 6
    mine, whole = (L.predict_table(m, df, "target") for m in (model, plain))
    assert mine.columns == whole.columns and mine.count() == whole.count() == 4000
    assert "categorical" not in str(last.toDebugString) and " in {" not in last.toDebugString  # bins are split in their order
    a, b = (M.roc_auc(s, "target", "predicted_prob").first()["roc_auc"] for s in (mine, whole))
    assert a > 0.95 and abs(a - b) < 0.01
    a, b = ({r["feature"]: r["importance"] for r in L.feature_importance(m).collect()} for m in (model, plain))
    assert max(abs(a[f"{L._BIN}{c}"] - b[c]) if f"{L._BIN}{c}" in a else abs(a[c] - b[c]) for c in b) < 0.15
    L.save_model(model, str(tmp_path / "m"), ["x", "y", "k"], "target")
    again = L.predict_table(L.load_model(spark, str(tmp_path / "m"))[0], df, "target")
    assert sorted(r["predicted_prob"] for r in again.collect()) == sorted(r["predicted_prob"] for r in mine.collect())


def test_each_tree_draws_its_rows(spark):
    few = spark.createDataFrame([(float(i), float(i % 2), 2.0 * n, n) for i, n in enumerate([1, 5, 1000, 100_000] * 25)], "a double, label double, weight double, rows long")
    got = L.drawn_times(few, ["a", "label"], 40, 1.0, 3).orderBy("a").collect()
    other = L.drawn_times(few.repartition(7), ["a", "label"], 40, 1.0, 3).orderBy("a").collect()
    assert [r["drawn"] for r in got] == [r["drawn"] for r in other]
    draws, rows = np.array([r["drawn"] for r in got], float), np.array([r["rows"] for r in got])
    off = (draws - rows[:, None]) / np.sqrt(rows)[:, None]  # of mean 0 and variance 1 for Poisson draws
    for n in (1, 5, 1000, 100_000):
        part = off[rows == n]
        assert abs(part.mean()) < 0.15 and abs(part.var() - 1) < 0.25
        assert abs(np.corrcoef(part[:, 0], part[:, 1])[0, 1]) < 0.6


def test_few_rows_of_one_label(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (3.0, 0)], "x double, target int")
    assert L.predict_table(L.train_classifier(df, "target", "random_forest", numTrees=9), df, "target").count() == 3


def test_training_rows_do_not_grow_with_the_table(spark, monkeypatch):
    seen = []
    was = L.drawn_times
    monkeypatch.setattr(L, "drawn_times", lambda few, *rest: seen.append(few.count()) or was(few, *rest))
    df = spark.range(20_000).selectExpr("cast(id % 5 AS double) AS x", "cast(id % 3 AS double) AS y", "cast(id % 5 + id % 3 > 3 AS int) AS target")
    out = L.grid_search(df, "target", ["x", "y"], [1, 3])
    assert seen == [30] * 6 or max(seen) <= 30  # two folds of three, 15 combinations each
    assert [r["max_depth"] for r in out.collect()] == [3, 1] and out.first()["mean_score"] > 0.99 and out.columns == ["max_depth", "mean_score"]
