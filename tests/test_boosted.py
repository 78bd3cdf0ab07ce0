"""Boosted trees on rows folded by bins against Spark's on all rows."""

import math
import random

from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from loomtab.operators import metrics as M, ml as L


def drawn(n, seed=3):
    r = random.Random(seed)
    rows = [(r.random(), r.gauss(0, 5), r.choice([1, 2, 2, 7])) for _ in range(n)]
    return [(x, y, k, int(x * 10 + y / 5 + k + r.random() > 7)) for x, y, k in rows]


def test_folded_rows_are_bounded_by_bins_not_rows(spark):
    odd = [(None, 1.0, 2, 1), (float("nan"), 1.0, 2, 0)]
    df = spark.createDataFrame(drawn(4000) + odd, "x double, y double, k int, label int").withColumn("weight", F.lit(0.5))
    cols = ["x", "y", "k"]
    borders = L.bin_borders(df, cols, 4)
    assert [len(b) for b in borders[:2]] == [3, 3] and borders[2] == [1.5, 4.5]
    bins = Bucketizer(splitsArray=[[-math.inf, *b, math.inf] for b in borders], inputCols=cols, outputCols=["a", "b", "c"], handleInvalid="skip")
    got = L.folded(bins, df)
    assert got.count() <= 4 * 4 * 3 * 2 and got.agg(F.sum("weight")).first()[0] == 2000
    one = spark.createDataFrame([(5.0,), (None,)], "v double")
    assert L.bin_borders(one, ["v"], 4) == [[5.0]] and L.bin_borders(one.limit(0), ["v"], 4) == [[0.0]]


def test_trained_as_on_all_rows(spark):
    df = spark.createDataFrame(drawn(4000), "x double, y double, k int, target int")
    model = L.train_classifier(df, "target", "gradient_boosting")
    plain = L.train_classifier(df, "target", "gradient_boosting", minInstancesPerNode=1)  # named, so single rows are looked at
    mine, whole = (L.predict_table(m, df, "target") for m in (model, plain))
    assert mine.columns == whole.columns == [*df.columns, "predicted_prob", "predicted_class", "correct"]
    a, b = (M.roc_auc(s, "target", "predicted_prob").first()["roc_auc"] for s in (mine, whole))
    assert a > 0.95 and abs(a - b) < 0.01
    assert type(model.stages[0]) is Bucketizer and type(plain.stages[0]) is not Bucketizer
    a, b = ({r["feature"]: r["importance"] for r in L.feature_importance(m).collect()} for m in (model, plain))
    assert a.keys() == b.keys() and max(abs(a[c] - b[c]) for c in a) < 0.1
