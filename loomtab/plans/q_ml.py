"""Training, scoring, evaluation and forecasting over the given tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from loomtab.operators import metrics as M, ml as L
from loomtab.operators.density import mutual_reachability
from loomtab.operators.ordered import framed
from loomtab.plans.registry import R, query, rnd
from loomtab.session import scratch

_FEATS = ["l_quantity", "l_discount", "l_tax"]


def _rows(t):
    """Order lines with a target the features carry some signal for."""
    noisy = F.col("l_quantity") + F.col("l_discount") * 100 + F.col("l_orderkey") % 12
    return t.lineitem.select("l_orderkey", "l_linenumber", *_FEATS, (noisy > 40).cast("int").alias("target"))


def _auc(t, algorithm):
    rows = _rows(t)
    model = L.train_classifier(rows.drop("l_orderkey", "l_linenumber"), "target", algorithm)
    scored = L.predict_table(model, rows, "target")
    return (M.roc_auc(scored, "target", "predicted_prob").select(F.lit(algorithm).alias("algorithm"), (F.col("roc_auc") > 0.8).alias("good"))
            .withColumn("accurate", scored.agg(F.avg(F.col("correct").cast("double")) > 0.7).scalar()))


_GOOD = "SELECT '{0}' AS algorithm, true AS good, true AS accurate FROM lineitem LIMIT 1"


@query("train_classifier", _GOOD.format("logistic_regression"))
def _(t):
    return _auc(t, "logistic_regression")


@query("train_classifier_forest", _GOOD.format("random_forest"))
def _(t):
    return _auc(t, "random_forest")


@query("train_classifier_boosted", _GOOD.format("gradient_boosting"))
def _(t):
    return _auc(t, "gradient_boosting")


@query("train_regressor", "SELECT true AS below_mean_error FROM lineitem LIMIT 1")
def _(t):
    price = F.col("l_quantity") * 900 * (1 - F.col("l_discount")) + F.col("l_orderkey") % 500
    rows = t.lineitem.select("l_quantity", "l_discount", price.alias("price"))
    scored = L.train_regressor(rows, "price", ["l_quantity", "l_discount"]).transform(rows)
    base = rows.withColumn("prediction", rows.agg(F.avg("price")).scalar())
    mine, naive = M.mae(scored, "price", "prediction"), M.mae(base, "price", "prediction")
    return mine.select((F.col("mae") < 0.3 * naive.scalar()).alias("below_mean_error"))


_SIGNAL = "CAST(l_quantity + l_discount * 100 + l_orderkey % 12 > 40 AS INTEGER)"
_STATS = ", ".join(f"avg({c}) AS m{i}, var_pop({c}) + (SELECT eps FROM e) AS v{i}" for i, c in enumerate(_FEATS))
_LOGP = " - ".join(["ln(n)", *(f"0.5 * (ln(v{i}) + pow({c} - m{i}, 2) / v{i})" for i, c in enumerate(_FEATS))])


@query("train_naive_bayes", f"""WITH r AS (SELECT l_orderkey, l_linenumber, {", ".join(_FEATS)}, {_SIGNAL} AS target FROM lineitem),
e AS (SELECT 1e-9 * greatest({", ".join(f"var_pop({c})" for c in _FEATS)}) AS eps FROM r),
c AS (SELECT target, count(*) AS n, {_STATS} FROM r GROUP BY target)
SELECT {", ".join(_FEATS)}, CAST(c.target AS DOUBLE) AS prediction FROM (SELECT DISTINCT {", ".join(_FEATS)} FROM r), c
QUALIFY row_number() OVER (PARTITION BY {", ".join(_FEATS)} ORDER BY {_LOGP} DESC) = 1""")
def _(t):
    rows = _rows(t).withColumn("target", F.col("target").cast("double"))
    return L.train_naive_bayes(rows, "target", _FEATS).transform(rows).select(*_FEATS, "prediction").distinct()


def _slope(x, other):
    top = f"(covar_pop({x}, y) * var_pop({other}) - covar_pop({other}, y) * covar_pop({x}, {other}))"
    return f"SELECT '{x}' AS feature, {R(f'abs({top} / (var_pop({x}) * var_pop({other}) - pow(covar_pop({x}, {other}), 2)))', 3)} AS importance FROM f"


@query("feature_importance", f"""WITH f AS (SELECT l_quantity, l_discount, l_quantity * 900 * (1 - l_discount) + l_orderkey % 500 AS y FROM lineitem)
{_slope("l_quantity", "l_discount")} UNION ALL {_slope("l_discount", "l_quantity")}""")
def _(t):
    y = F.col("l_quantity") * 900 * (1 - F.col("l_discount")) + F.col("l_orderkey") % 500
    model = L.train_linear(t.lineitem.select("l_quantity", "l_discount", y.alias("y")), "y", ["l_quantity", "l_discount"], solver="normal")
    return L.feature_importance(model).withColumn("importance", rnd("importance", 3))


@query("cross_validated_r2", "SELECT CAST(4 AS INTEGER) AS folds, CAST(1 AS DOUBLE) AS mean_score, CAST(0 AS DOUBLE) AS std_score FROM part LIMIT 1")
def _(t):
    # An exact linear relation: every fold must explain all of it.
    rows = t.part.select("p_partkey", "p_size", "p_retailprice", (F.col("p_size") * 3 + F.col("p_retailprice") * 0.5 + 7).alias("y"))
    out = L.cross_validated_r2(rows, "p_partkey", "y", ["p_size", "p_retailprice"], folds=4)
    return out.select("folds", rnd("mean_score", 6).alias("mean_score"), rnd("std_score", 6).alias("std_score"))


@query("rank_experiments", f"""WITH r AS (SELECT event_type AS name, avg(value) AS auc, min(value) AS f1 FROM events GROUP BY 1)
SELECT name, CAST(row_number() OVER (ORDER BY auc DESC, f1 DESC, name) AS INTEGER) AS rank, auc = max(auc) OVER () AS best, {R('max(auc) OVER () - auc', 6)} AS gap FROM r""")
def _(t):
    runs = t.events.groupBy(F.col("event_type").alias("name")).agg(F.avg("value").alias("auc"), F.min("value").alias("f1"))
    return L.rank_experiments(runs, "name", "auc", "f1").select("name", "rank", "best", rnd("gap", 6).alias("gap"))


_V = "(SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


@query("knn_classify", f"""WITH n AS (SELECT a.vec_id, b.label FROM {_V} a JOIN {_V} b ON a.vec_id <> b.vec_id
 QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) <= 5),
c AS (SELECT vec_id, label, count(*) AS n FROM n GROUP BY ALL)
SELECT vec_id, label AS predicted FROM c QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) = 1""")
def _(t):
    return L.knn_classify(t.embeddings, None, "vec_id", "embedding", "label", 5)


@query("kmeans_silhouette", "SELECT CAST(2 AS BIGINT) AS clusters, CAST(count(*) AS BIGINT) AS n, true AS valid FROM embeddings")
def _(t):
    names = [f"d{i}" for i in range(64)]
    rows, score, centres = L.kmeans(t.embeddings.select("vec_id", *[F.get("embedding", F.lit(i)).alias(n) for i, n in enumerate(names)]), names)
    return rows.agg(F.countDistinct("cluster").alias("clusters"), F.count(F.lit(1)).alias("n"), F.lit(-1 <= score <= 1 and len(centres) == 2).alias("valid"))


@query("soft_clusters")
def _(t):
    out = L.soft_clusters(t.embeddings, "vec_id", "embedding", neighbors=10, min_size=20)
    return out.select("vec_id", "cluster", rnd(F.aggregate("memberships", F.lit(0.0), lambda a, m: a + m["membership"])).alias("in_some_cluster"),
                      rnd(F.coalesce(F.get("memberships", F.lit(0))["membership"], F.lit(0.0))).alias("first"))


@query("mutual_reachability", f"""WITH n AS (SELECT a.vec_id AS a, b.vec_id AS b, list_distance(a.v, b.v) AS d FROM {_V} a JOIN {_V} b ON a.vec_id <> b.vec_id
 QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) <= 5),
c AS (SELECT a, max(d) AS core FROM n GROUP BY a)
SELECT DISTINCT least(n.a, n.b) AS a, greatest(n.a, n.b) AS b, {R('greatest(n.d, x.core, y.core)')} AS weight FROM n JOIN c x ON x.a = n.a JOIN c y ON y.a = n.b""")
def _(t):
    return mutual_reachability(t.embeddings, "vec_id", "embedding", 5).select("a", "b", rnd("weight").alias("weight"))


@query("hyperparameter_grid")
def _(t):
    return L.grid_search(_rows(t), "target", _FEATS, [2, 4])


@query("predict_table", "SELECT CAST(count(*) AS BIGINT) AS n, true AS consistent FROM lineitem")
def _(t):
    rows = _rows(t)
    path = scratch(t.spark, "model")
    L.save_model(L.train_classifier(rows, "target", "logistic_regression", _FEATS, maxIter=5), path, _FEATS, "target")
    model, about = L.load_model(t.spark, path)
    out = L.predict_table(model, rows, about["target"])
    ok = ((F.col("predicted_prob") >= 0.5) == (F.col("predicted_class") == 1)) & (F.col("correct") == (F.col("predicted_class") == F.col("target")))
    return out.agg(F.count(F.lit(1)).alias("n"), F.bool_and(ok).alias("consistent"))


def _linear():
    weights = np.array([0.5, -2.0, 1.0])
    return lambda x: x @ weights


@query("batch_score_udf", f"SELECT l_orderkey, l_linenumber, {R('0.5 * l_quantity - 2 * l_discount + l_tax', 6)} AS score FROM lineitem")
def _(t):
    keyed = t.lineitem.withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    out = L.score_batches(keyed, "key", _FEATS, _linear)
    parts = F.split("key", "-")
    return out.select(parts[0].cast("long").alias("l_orderkey"), parts[1].cast("int").alias("l_linenumber"), rnd("score", 6).alias("score"))


# ---- evaluation ------------------------------------------------------------------------

_P = """s AS (SELECT quality AS y, toxic, doc_id, round(CAST(('0x' || left(md5(CAST(doc_id AS VARCHAR)), 7)) AS BIGINT) / 268435456.0, 2) AS p FROM labels)"""


def _scored(t):
    raw = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 7), 16, 10).cast("long") / 268435456.0
    return t.labels.select(F.col("quality").alias("y"), "toxic", "doc_id", F.round(raw, 2).alias("p"))


@query("confusion_matrix", f"""WITH {_P}, c AS (SELECT y, CAST(p >= 0.5 AS INTEGER) AS predicted, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1, 2)
SELECT y, predicted, n, {R('n / sum(n) OVER (PARTITION BY y)', 6)} AS share FROM c""")
def _(t):
    s = _scored(t).withColumn("q", (F.col("p") >= 0.5).cast("int"))
    return M.confusion(s, "y", "q").withColumn("share", rnd("share", 6))


def _tm(c):
    return f"""SELECT {c}::DOUBLE AS threshold, {R(f'coalesce(count(*) FILTER (p >= {c} AND y = 1) / nullif(count(*) FILTER (p >= {c}), 0), 0)', 6)} AS precision,
 {R(f'count(*) FILTER (p >= {c} AND y = 1) / count(*) FILTER (y = 1)', 6)} AS recall, {R(f'2 * count(*) FILTER (p >= {c} AND y = 1) / (count(*) FILTER (p >= {c}) + count(*) FILTER (y = 1))', 6)} AS f1 FROM s"""


_CUTS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


@query("threshold_metrics", f"WITH {_P} " + " UNION ALL ".join(map(_tm, _CUTS)))
def _(t):
    out = M.threshold_metrics(_scored(t), "y", "p", _CUTS)
    return out.withColumns({c: rnd(c, 6) for c in ("precision", "recall", "f1")})


@query("roc_auc", f"""WITH {_P} SELECT {R('sum(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END) / count(*)', 6)} AS roc_auc FROM s a JOIN s b ON a.y = 1 AND b.y = 0""")
def _(t):
    return M.roc_auc(_scored(t), "y", "p").select(rnd("roc_auc", 6).alias("roc_auc"))


_ROC = f"""{_P}, c AS (SELECT p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM s GROUP BY p),
k AS (SELECT p, pos, neg, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp FROM c),
z AS (SELECT *, tp / max(tp) OVER () AS tpr, fp / max(fp) OVER () AS fpr FROM k)"""


@query("average_precision", f"WITH {_ROC} SELECT {R('sum(pos * tp / (tp + fp)) / max(tp)', 6)} AS average_precision FROM z")
def _(t):
    return M.average_precision(_scored(t), "y", "p").select(rnd("average_precision", 6).alias("average_precision"))


@query("macro_f1", f"""WITH {_P}, q AS (SELECT y, CAST(p >= 0.3 AS INTEGER) AS q FROM s), l AS (SELECT unnest([0, 1]) AS label),
f AS (SELECT label, 2 * count(*) FILTER (y = label AND q = label) / (count(*) FILTER (y = label) + count(*) FILTER (q = label)) AS f1, count(*) FILTER (y = label AND q = label) / count(*) FILTER (y = label) AS accuracy FROM l, q GROUP BY label)
SELECT label, {R('f1', 6)} AS f1, {R('accuracy', 6)} AS accuracy FROM f UNION ALL SELECT NULL, {R('(SELECT avg(f1) FROM f)', 6)}, {R('avg(CAST(y = q AS INT))', 6)} FROM q""")
def _(t):
    s = _scored(t).withColumn("q", (F.col("p") >= 0.3).cast("int"))
    return M.macro_f1(s, "y", "q").withColumns({"f1": rnd("f1", 6), "accuracy": rnd("accuracy", 6)})


@query("tpr_at_fpr", f"WITH {_ROC} " + " UNION ALL ".join(
    f"SELECT {m}::DOUBLE AS fpr_mark, {R('(SELECT tpr FROM z ORDER BY abs(fpr - %s), tpr DESC LIMIT 1)' % m, 6)} AS tpr" for m in (0.01, 0.1, 0.5)))
def _(t):
    return M.tpr_at_fpr(_scored(t), "y", "p", [0.01, 0.1, 0.5]).withColumn("tpr", rnd("tpr", 6))


_PAIRS = """p AS (SELECT a.vec_id, a.label = b.label AS same, round(pow(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 2), 4) AS d, CAST(a.vec_id % 5 AS INTEGER) AS fold
 FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
g AS (SELECT fold, i, i * 0.01 AS threshold, count(*) FILTER (same AND least(400, floor(d / 0.01) + 1) <= i) AS tp, count(*) FILTER (NOT same AND least(400, floor(d / 0.01) + 1) <= i) AS fp,
 count(*) FILTER (same) AS p, count(*) FILTER (NOT same) AS n FROM p, range(0, 400) r(i) GROUP BY fold, i)"""


def _pairs(t):
    from loomtab.functions.expr import squared_distance
    a = t.embeddings.select("vec_id", (F.col("vec_id") + 1).alias("o"), F.col("embedding").alias("x"), F.col("label").alias("la"))
    b = t.embeddings.select(F.col("vec_id").alias("o"), F.col("embedding").alias("y"), F.col("label").alias("lb"))
    return a.join(b, "o").select("vec_id", (F.col("la") == F.col("lb")).alias("same"), F.round(squared_distance("x", "y"), 4).alias("d"),
                                 (F.col("vec_id") % 5).cast("int").alias("fold"))


@query("verification_threshold", f"""WITH {_PAIRS}, a AS (SELECT i, sum(tp) AS tp, sum(fp) AS fp, sum(n) AS n FROM g GROUP BY i),
r AS (SELECT fold, i, g.threshold, g.tp, g.fp, g.p, g.n, (a.tp - g.tp) + ((a.n - g.n) - (a.fp - g.fp)) AS ok FROM g JOIN a USING (i) QUALIFY row_number() OVER (PARTITION BY fold ORDER BY ok DESC, i) = 1)
SELECT fold, {R('threshold')} AS threshold, {R('(tp + n - fp) / (p + n)', 6)} AS accuracy, {R('coalesce(tp / nullif(p, 0), 0)', 6)} AS tpr, {R('fp / n', 6)} AS fpr FROM r""")
def _(t):
    out = M.verification_folds(_pairs(t), "same", "d", "fold")
    return out.select("fold", rnd("threshold").alias("threshold"), *[rnd(c, 6).alias(c) for c in ("accuracy", "tpr", "fpr")])


@query("verification_at_far", f"""WITH {_PAIRS}, f AS (SELECT i, i * 0.01 AS t, sum(fp) / sum(n) AS far FROM g GROUP BY i), l AS (SELECT *, lag(far) OVER (ORDER BY i) AS f0, lag(t) OVER (ORDER BY i) AS t0 FROM f)
SELECT {R('t0 + (t - t0) * (0.1 - f0) / (far - f0)', 5)} AS threshold FROM l WHERE far >= 0.1 AND f0 < 0.1 ORDER BY t LIMIT 1""")
def _(t):
    curve = M.verification_curve(_pairs(t), "same", "d", "fold")
    return M.threshold_at_far(curve, 0.1).select(rnd("threshold", 5).alias("threshold"))


@query("rmspe", f"SELECT {R('sqrt(avg(pow((o_totalprice - o_totalprice * (0.9 + (o_orderkey % 5) / 20.0)) / o_totalprice, 2)))', 6)} AS rmspe FROM orders WHERE o_totalprice > 0.001")
def _(t):
    s = t.orders.select(F.ln("o_totalprice").alias("y"), F.ln(F.col("o_totalprice") * (0.9 + (F.col("o_orderkey") % 5) / 20.0)).alias("q"))
    return M.rmspe(s, "y", "q").select(rnd("rmspe", 6).alias("rmspe"))


@query("mae", f"SELECT {R('avg(abs(o_totalprice - (SELECT avg(o_totalprice) FROM orders)))', 3)} AS mae FROM orders")
def _(t):
    s = t.orders.withColumn("q", t.orders.agg(F.avg("o_totalprice")).scalar())
    return M.mae(s, "o_totalprice", "q").select(rnd("mae", 3).alias("mae"))


@query("label_agreement", f"""WITH {_P}, h AS (SELECT 0.2 - p AS s, toxic AS k FROM s)
SELECT {R('avg(CAST((s < -0.05) = (k = 1) AS INT))', 6)} AS accuracy, {R('count(*) FILTER (s < -0.05 AND k = 1) / count(*) FILTER (s < -0.05)', 6)} AS precision, {R('count(*) FILTER (s < -0.05 AND k = 1) / count(*) FILTER (k = 1)', 6)} AS recall FROM h""")
def _(t):
    s = _scored(t).select((0.2 - F.col("p")).alias("s"), F.col("toxic").alias("k"))
    return M.label_agreement(s, "s", "k").select(*[rnd(c, 6).alias(c) for c in ("accuracy", "precision", "recall")])


# ---- forecasts ---------------------------------------------------------------------------

def _daily(t):
    return t.events.groupBy("event_type", F.to_date("ts").alias("d")).agg(F.avg("value").alias("v"))


_D = "d AS (SELECT event_type, CAST(ts AS DATE) AS d, avg(value) AS v FROM events GROUP BY ALL)"


@query("forecast_quantile_eval", f"""WITH {_D}, l AS (SELECT *, lag(v) OVER (PARTITION BY event_type ORDER BY d) AS f FROM d),
q AS (SELECT event_type, quantile_cont(v - f, [0.1, 0.5, 0.9]) AS q FROM l WHERE f IS NOT NULL GROUP BY 1),
e AS (SELECT event_type, unnest([0.1, 0.5, 0.9]) AS quantile, v, f + unnest(q) AS h FROM l JOIN q USING (event_type) WHERE f IS NOT NULL),
s AS (SELECT event_type AS series, CAST(quantile AS DOUBLE) AS quantile, avg(greatest(quantile * (v - h), (quantile - 1) * (v - h))) AS pinball, avg(CAST(v <= h + 1e-9 AS INT)) AS coverage FROM e GROUP BY ALL)
SELECT series, quantile, {R('pinball', 5)} AS pinball, {R('coverage', 5)} AS coverage FROM s UNION ALL SELECT NULL, quantile, {R('avg(pinball)', 5)}, {R('avg(coverage)', 5)} FROM s GROUP BY quantile""")
def _(t):
    d = framed(_daily(t), ["event_type"], ["d"], 1, 0, lambda w: {"f": F.lag("v").over(w)}).where("f is not null")
    q = L.residual_quantiles(d, "event_type", "v", "f", [0.1, 0.5, 0.9])
    q = q.withColumns({f"q{i}": F.col(f"q{i}") + 1e-9 for i in range(3)})
    out = M.quantile_forecast_eval(q, "event_type", "v", {0.1: "q0", 0.5: "q1", 0.9: "q2"})
    return out.select("series", "quantile", rnd("pinball", 5).alias("pinball"), rnd("coverage", 5).alias("coverage"))


@query("series_forecast", f"""WITH {_D}, r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY d DESC) AS r FROM d),
e AS (SELECT event_type, arg_min(v, d) AS a, arg_max(v, d) AS z, max(d) AS last, count(*) AS n FROM d GROUP BY 1)
SELECT e.event_type, CAST(last + CAST(h AS INTEGER) AS DATE) AS date, {R('r.v', 5)} AS seasonal_naive, {R('z + h * (z - a) / (n - 1)', 5)} AS drift
FROM e, range(1, 15) s(h) JOIN r ON true WHERE r.event_type = e.event_type AND r.r = 7 - (h - 1) % 7""")
def _(t):
    out = L.forecast_series(_daily(t), "event_type", "d", "v", 14)
    return out.select("event_type", "date", rnd("seasonal_naive", 5).alias("seasonal_naive"), rnd("drift", 5).alias("drift"))


def _mean_of_tail(values, steps):
    return np.full(steps, values[-5:].mean())


@query("series_forecast_custom", f"""WITH {_D}, r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY d DESC) AS r FROM d),
m AS (SELECT event_type, avg(v) FILTER (r <= 5) AS f, max(d) AS last FROM r GROUP BY 1)
SELECT event_type, CAST(last + CAST(h AS INTEGER) AS DATE) AS date, {R('f', 5)} AS forecast FROM m, range(1, 4) s(h)""")
def _(t):
    return L.forecast_custom(_daily(t), "event_type", "d", "v", _mean_of_tail, 3, history=5).withColumn("forecast", rnd("forecast", 5))


@query("ensemble_stats", f"""WITH c AS (SELECT event_type, hour(ts) AS h, avg(value) AS m, coalesce(stddev_samp(value), 0) AS s FROM events GROUP BY ALL)
SELECT event_type, CAST(h AS INTEGER) AS h, {R('m', 5)} AS mean, {R('s', 5)} AS spread, {R('avg(s) OVER ()', 5)} AS mean_spread FROM c""")
def _(t):
    out = L.ensemble_stats(t.events.withColumn("h", F.hour("ts")), ["event_type", "h"], "value")
    return out.select("event_type", "h", *[rnd(c, 5).alias(c) for c in ("mean", "spread", "mean_spread")])


@query("convergence_flag", f"""WITH {_D}, l AS (SELECT *, lag(v) OVER (PARTITION BY event_type ORDER BY d) AS p FROM d)
SELECT event_type, d, {R('abs(v - p) / greatest(abs(p), 1e-12)', 6)} AS change_rate, coalesce(abs(v - p) / greatest(abs(p), 1e-12) < 0.05, false) AS converged FROM l""")
def _(t):
    out = L.convergence(_daily(t), "event_type", "d", "v", 0.05)
    return out.select("event_type", "d", rnd("change_rate", 6).alias("change_rate"), "converged")
