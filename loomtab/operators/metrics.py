"""Evaluation metrics on prediction tables.

Threshold metrics need only the counts per distinct score, so the row data is
aggregated first and the order work runs on that smaller table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomtab.operators.ordered import attach, keyed_join, running


def weighted_gini(df: DataFrame, y: str, p: str, tie: str, negative: float = 20.0, share: float = 0.04) -> DataFrame:
    """Capture rate in the top ``share`` of weight, normalised Gini and the mean of both."""
    rows = df.select(F.col(y).cast("double").alias("y"), (-F.col(p)).alias("_o"), F.col(tie).alias("_t"),
                     (F.lit(negative) - F.col(y) * (negative - 1)).cast("double").alias("w"))
    cum = running(rows, [], ["_o", "_t"], {"cw": ("sum", F.col("w")), "cy": ("sum", F.col("y") * F.col("w"))})
    cum = attach(cum, rows.agg(F.sum("w").alias("w"), F.sum(F.col("y") * F.col("w")).alias("yw")))
    cw, lz = F.col("cw") / F.col("_s.w"), F.col("cy") / F.col("_s.yw")
    out = cum.agg((F.sum(F.when(cw <= share, F.col("y")).otherwise(0.0)) / F.sum("y")).alias("capture"),
                  F.sum((lz - cw) * F.col("w")).alias("g"), F.sum("y").alias("np"),
                  (F.count(F.lit(1)) - F.sum("y")).alias("nn"))
    total = F.col("np") + negative * F.col("nn")
    gini = F.col("g") / (negative / 2 * F.col("nn") * (total - (negative - 1)) / total)
    return out.select("capture", gini.alias("gini"), (0.5 * (F.col("capture") + gini)).alias("score"))


def score_counts(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., score, pos, neg) per distinct score."""
    return df.groupBy(*by, F.col(p).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))


def roc_points(df: DataFrame, y: str, p: str) -> DataFrame:
    """(score, tp, fp, tpr, fpr) for the cut at each distinct score, highest first."""
    counts = score_counts(df, y, p).withColumn("_o", -F.col("score"))
    cum = running(counts, [], ["_o"], {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))})
    cum = attach(cum, counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")))
    return cum.select("score", "pos", "neg", "tp", "fp", (F.col("tp") / F.col("_s.p")).alias("tpr"), (F.col("fp") / F.col("_s.n")).alias("fpr"))


def roc_auc(df: DataFrame, y: str, p: str) -> DataFrame:
    """Area with ties counted half: rank-sum over distinct scores."""
    pts = roc_points(df, y, p)
    wins = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return pts.agg((wins / (F.max("tp") * F.max("fp"))).alias("roc_auc"))


def average_precision(df: DataFrame, y: str, p: str) -> DataFrame:
    """Sum of recall steps times precision over distinct scores."""
    pts = roc_points(df, y, p)
    return pts.agg((F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))) / F.max("tp")).alias("average_precision"))


def tpr_at_fpr(df: DataFrame, y: str, p: str, marks: Sequence[float]) -> DataFrame:
    """TPR at the FPR nearest each mark; the largest TPR among equally near ones."""
    pts = roc_points(df, y, p).select("tpr", "fpr")
    best = pts.agg(*[F.min(F.struct(F.abs(F.col("fpr") - m).alias("d"), (-F.col("tpr")).alias("t"))).alias(f"m{i}")
                     for i, m in enumerate(marks)])
    return best.select(F.inline(F.array(*[F.struct(F.lit(float(m)).alias("fpr_mark"), (-F.col(f"m{i}.t")).alias("tpr"))
                                          for i, m in enumerate(marks)])))


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    """(y, predicted, n, share of the true class)."""
    n = df.groupBy(F.col(y).alias("y"), F.col(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    total = n.groupBy("y").agg(F.sum("n").alias("_t"))
    return keyed_join(n, total, ["y"]).select("y", "predicted", "n", (F.col("n") / F.col("_t")).alias("share"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def threshold_metrics(df: DataFrame, y: str, p: str, thresholds: Sequence[float]) -> DataFrame:
    """(threshold, precision, recall, f1) for ``p >= threshold``; 0 where undefined. One pass."""
    hit = {t: F.col(p) >= t for t in thresholds}
    pos = F.col(y) == 1
    wide = df.agg(*[e for i, t in enumerate(thresholds) for e in (
        F.count_if(hit[t] & pos).alias(f"tp{i}"), F.count_if(hit[t] & ~pos).alias(f"fp{i}"))], F.count_if(pos).alias("p"))
    rows = []
    for i, t in enumerate(thresholds):
        tp, fp = F.col(f"tp{i}"), F.col(f"fp{i}")
        rows.append(F.struct(F.lit(float(t)).alias("threshold"), _ratio(tp, tp + fp).alias("precision"),
                             _ratio(tp, F.col("p")).alias("recall"), _ratio(2 * tp, tp + fp + F.col("p")).alias("f1")))
    return wide.select(F.inline(F.array(*rows)))


def macro_f1(df: DataFrame, y: str, pred: str) -> DataFrame:
    """(label, f1, accuracy) per class plus label NULL holding the mean f1 and overall accuracy."""
    cells = df.groupBy(F.col(y).alias("y"), F.col(pred).alias("q")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("t"), F.lit(0).cast("long").alias("q"), F.when(F.col("y") == F.col("q"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("q").alias("label"), F.lit(0).cast("long").alias("t"), F.col("n").alias("q"), F.lit(0).cast("long").alias("hit")))))
    per = sides.groupBy("label").agg(F.sum("t").alias("t"), F.sum("q").alias("q"), F.sum("hit").alias("hit"))
    out = per.select("label", _ratio(2 * F.col("hit"), F.col("t") + F.col("q")).alias("f1"), _ratio(F.col("hit"), F.col("t")).alias("accuracy"))
    mean = per.agg(F.avg(_ratio(2 * F.col("hit"), F.col("t") + F.col("q"))).alias("f1"), (F.sum("hit") / F.sum("t")).alias("accuracy"))
    kind = df.schema[y].dataType
    return out.unionByName(mean.select(F.lit(None).cast(kind).alias("label"), "f1", "accuracy"))


def verification_curve(pairs: DataFrame, same: str, distance: str, fold: str, thresholds: int = 400, step: float = 0.01) -> DataFrame:
    """(fold, threshold, tp, fp, p, n) for ``distance < threshold`` on a fixed grid.

    A pair is counted once in the grid cell where it starts to be accepted; the
    counts are then accumulated over the cells, so pairs are not multiplied by
    the number of thresholds.
    """
    first = F.greatest(F.lit(0), F.least(F.lit(thresholds), F.floor(F.col(distance) / step).cast("int") + 1))
    cell = pairs.groupBy(F.col(fold).alias("fold"), first.alias("i")).agg(
        F.count_if(F.col(same)).alias("s"), F.count_if(~F.col(same)).alias("d"))
    w = Window.partitionBy("fold").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    totals = cell.groupBy("fold").agg(F.sum("s").alias("p"), F.sum("d").alias("n"))
    dense = totals.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(thresholds - 1))))
    full = dense.join(cell, ["fold", "i"], "left").fillna(0, subset=["s", "d"])
    return full.select("fold", (F.col("i") * step).alias("threshold"), "i", F.sum("s").over(w).alias("tp"),
                       F.sum("d").over(w).alias("fp"), "p", "n")


def verification_folds(pairs: DataFrame, same: str, distance: str, fold: str, thresholds: int = 400, step: float = 0.01) -> DataFrame:
    """Per fold: the threshold best on the other folds and accuracy, tpr, fpr on this one."""
    curve = verification_curve(pairs, same, distance, fold, thresholds, step)
    every = curve.groupBy("i").agg(*[F.sum(c).alias(f"a_{c}") for c in ("tp", "fp", "p", "n")])
    both = curve.join(every, "i")
    right = (F.col("a_tp") - F.col("tp")) + ((F.col("a_n") - F.col("n")) - (F.col("a_fp") - F.col("fp")))
    best = both.groupBy("fold").agg(F.max_by(F.struct("i", "threshold", "tp", "fp", "p", "n"),
                                             F.struct(right, -F.col("i"))).alias("b"))
    b = F.col("b")
    return best.select("fold", b["threshold"].alias("threshold"),
                       ((b["tp"] + b["n"] - b["fp"]) / (b["p"] + b["n"])).alias("accuracy"),
                       _ratio(b["tp"], b["p"]).alias("tpr"), _ratio(b["fp"], b["n"]).alias("fpr"))


def threshold_at_far(curve: DataFrame, target: float) -> DataFrame:
    """Threshold where the false accept rate reaches ``target``, by linear interpolation between grid cells."""
    far = (curve.groupBy("i", "threshold").agg((F.sum("fp") / F.sum("n")).alias("far")))
    w = Window.partitionBy(F.lit(0)).orderBy("i")  # one row per grid cell
    step = far.select("threshold", "far", F.lag("threshold").over(w).alias("t0"), F.lag("far").over(w).alias("f0"))
    cross = step.where((F.col("far") >= target) & (F.col("f0") < target)).agg(F.min(F.struct("threshold", "far", "t0", "f0")).alias("c"))
    c = F.col("c")
    return cross.select((c["t0"] + (c["threshold"] - c["t0"]) * (target - c["f0"]) / (c["far"] - c["f0"])).alias("threshold"))


def rmspe(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Root mean squared percentage error of log-space values, targets above 0.001."""
    a, b = F.exp(F.col(y)), F.exp(F.col(pred))
    return df.where(a > 0.001).agg(F.sqrt(F.avg(F.pow((a - b) / a, F.lit(2.0)))).alias("rmspe"))


def mae(df: DataFrame, y: str, pred: str) -> DataFrame:
    return df.agg(F.avg(F.abs(F.col(y) - F.col(pred))).alias("mae"))


def label_agreement(df: DataFrame, score: str, known: str, cut: float = -0.05) -> DataFrame:
    """Accuracy, precision and recall of ``score < cut`` on rows with a known 0/1 label."""
    hit, pos = F.col(score) < cut, F.col(known) == 1
    c = df.where(F.col(known).isNotNull()).agg(
        F.count_if(hit & pos).alias("tp"), F.count_if(hit & ~pos).alias("fp"), F.count_if(~hit & pos).alias("fn"),
        F.count_if(~hit & ~pos).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(_ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"))


def quantile_forecast_eval(df: DataFrame, series: str, actual: str, quantiles: dict[float, str]) -> DataFrame:
    """(series, quantile, pinball loss, coverage); series NULL is the mean over series."""
    cells = []
    for q, c in quantiles.items():
        e = F.col(actual) - F.col(c)
        cells.append(F.struct(F.lit(q).alias("quantile"), F.greatest(q * e, (q - 1) * e).alias("l"),
                              (F.col(actual) <= F.col(c)).cast("double").alias("c")))
    per = (df.select(F.col(series).cast("string").alias("series"), F.inline(F.array(*cells)))
           .groupBy("series", "quantile").agg(F.avg("l").alias("pinball"), F.avg("c").alias("coverage")))
    mean = per.groupBy("quantile").agg(F.avg("pinball").alias("pinball"), F.avg("coverage").alias("coverage"))
    return per.unionByName(mean.withColumn("series", F.lit(None).cast("string")))


def retrieval_metrics(ranked: DataFrame, truth: DataFrame, k: int, query: str = "query_id", item: str = "item_id") -> DataFrame:
    """Mean recall@k, NDCG@k and MRR with one relevant item per query; queries without a hit count 0."""
    hit = ranked.join(truth, [query, item]).groupBy(query).agg(F.min("rank").alias("_r"))
    all_q = truth.join(hit, query, "left")
    top = F.col("_r") <= k
    return all_q.agg(F.avg(F.when(top, 1.0).otherwise(0.0)).alias("recall"),
                     F.avg(F.when(top, 1.0 / F.log2(F.col("_r") + 1)).otherwise(0.0)).alias("ndcg"),
                     F.avg(F.coalesce(1.0 / F.col("_r"), F.lit(0.0))).alias("mrr"))
