"""Aggregates over the given tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from loomtab.operators import aggregates as A
from loomtab.operators.ordered import exact_quantiles, keyed_join
from loomtab.plans.registry import R, query, rnd
from loomtab.session import scratch

_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_SPLIT = "TIMESTAMP '1998-07-01'"
_FACTS = "SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def _n():
    return F.count(F.lit(1)).alias("n")


def _facts(t):
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


@query("group_mean_count", f"SELECT c_mktsegment, {R('avg(c_acctbal)')} AS mean, CAST(count(*) AS BIGINT) AS n FROM customer "
       "WHERE c_acctbal > 0 GROUP BY 1 ORDER BY mean DESC")
def _(t):
    return (t.customer.where("c_acctbal > 0").groupBy("c_mktsegment").agg(rnd(F.avg("c_acctbal")).alias("mean"), _n())
            .orderBy(F.desc("mean")))


@query("count_distinct", "SELECT event_type, CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n, "
       "CAST(count(DISTINCT user_id) AS BIGINT) AS users FROM events GROUP BY 1, 2")
def _(t):
    return t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(_n(), F.countDistinct("user_id").alias("users"))


@query("sum_product", f"SELECT l_suppkey, {R('sum(l_quantity * l_extendedprice)', 2)} AS spend FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(rnd(F.sum(F.col("l_quantity") * F.col("l_extendedprice")), 2).alias("spend"))


@query("avg_change_two_periods", f"""
WITH f AS ({_FACTS})
SELECT l_partkey, {R(f'avg(l_quantity) FILTER (o_orderdate < {_SPLIT})')} AS avg_old, {R(f'avg(l_quantity) FILTER (o_orderdate >= {_SPLIT})')} AS avg_new
FROM f WHERE l_quantity > 0 GROUP BY 1 HAVING avg_old IS NOT NULL AND avg_new IS NOT NULL ORDER BY avg_new - avg_old DESC, 1""")
def _(t):
    early = F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp")
    out = _facts(t).where("l_quantity > 0").groupBy("l_partkey").agg(
        rnd(F.avg(F.when(early, F.col("l_quantity")))).alias("avg_old"),
        rnd(F.avg(F.when(~early, F.col("l_quantity")))).alias("avg_new"))
    return out.dropna().orderBy(F.desc(F.col("avg_new") - F.col("avg_old")), "l_partkey")


@query("group_corr", f"""
WITH f AS ({_FACTS}), c AS (SELECT l_suppkey, corr(l_extendedprice, l_quantity) FILTER (o_orderdate < {_SPLIT}) AS old,
  corr(l_extendedprice, l_quantity) FILTER (o_orderdate >= {_SPLIT}) AS new FROM f GROUP BY 1)
SELECT l_suppkey, {R('old', 6)} AS old, {R('new', 6)} AS new, {R('abs(new - old)', 6)} AS change FROM c
WHERE NOT isnan(old) AND NOT isnan(new)""")
def _(t):
    early = F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp")
    price = F.col("l_extendedprice")
    c = _facts(t).groupBy("l_suppkey").agg(A.safe_corr(F.when(early, price), "l_quantity").alias("old"),
                                           A.safe_corr(F.when(~early, price), "l_quantity").alias("new"))
    return c.dropna().select("l_suppkey", rnd("old", 6).alias("old"), rnd("new", 6).alias("new"),
                             rnd(F.abs(F.col("new") - F.col("old")), 6).alias("change"))


_UP = """SELECT user_id, CAST(count(*) AS BIGINT) AS n, {0} AS mean, {1} AS std, {2} AS top, {3} AS med_lat, {4} AS med_lon,
 CAST(arg_min(event_id % 50, ts) AS BIGINT) AS first_age, min(ts) AS first_ts FROM events GROUP BY user_id"""


@query("user_profile", _UP.format(R("avg(value)"), R("coalesce(stddev_samp(value), 0)", 5), R("max(value)"),
                                  R("quantile_cont(value, 0.5)"), R("quantile_cont(CAST(event_id % 90 AS DOUBLE), 0.5)")))
def _(t):
    e = t.events.withColumn("lon", (F.col("event_id") % 90).cast("double"))
    base = e.groupBy("user_id").agg(_n(), rnd(F.avg("value")).alias("mean"),
                                    rnd(F.coalesce(F.stddev_samp("value"), F.lit(0.0)), 5).alias("std"),
                                    rnd(F.max("value")).alias("top"),
                                    F.min_by(F.col("event_id") % 50, "ts").alias("first_age"), F.min("ts").alias("first_ts"))
    med = exact_quantiles(e, ["user_id"], ["value", "lon"], [0.5])
    return keyed_join(base, med, ["user_id"]).select(*base.columns, rnd("value_q0").alias("med_lat"), rnd("lon_q0").alias("med_lon"))


@query("ungrouped_stats", "SELECT CAST(count(value) AS BIGINT) AS count, round(avg(value), 2) AS mean, round(min(value), 2) AS min, "
       "round(max(value), 2) AS max, round(stddev_pop(value), 2) AS std, round(quantile_cont(value, 0.5), 2) AS median FROM events")
def _(t):
    return A.column_stats(t.events, "value")


@query("value_counts", f"SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, {R('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct FROM lineitem GROUP BY 1")
def _(t):
    return A.value_counts(t.lineitem, "l_returnflag").withColumn("pct", rnd("pct"))


def _cc(c):
    return (f"SELECT l_returnflag, '{c}' AS \"column\", {R(f'avg({c})')} AS mean, {R(f'stddev_samp({c})', 5)} AS std, {R(f'min({c})')} AS min, "
            f"{R(f'max({c})')} AS max, {R(f'quantile_cont({c}, 0.5)')} AS median, CAST(count({c}) AS BIGINT) AS n FROM lineitem GROUP BY 1")


@query("class_conditional_stats", " UNION ALL ".join(map(_cc, _NUM)))
def _(t):
    out = A.class_conditional_stats(t.lineitem, "l_returnflag", _NUM)
    return out.withColumns({**{c: rnd(c) for c in ("mean", "min", "max", "median")}, "std": rnd("std", 5)})


@query("group_feature_means", "SELECT p_brand, CAST(count(*) AS BIGINT) AS n, " + ", ".join(
    f"{R(f'avg({c})')} AS mean_{c}" for c in ("p_size", "p_retailprice")) + " FROM part GROUP BY 1")
def _(t):
    out = A.group_feature_means(t.part, "p_brand", ["p_size", "p_retailprice"])
    return out.withColumns({c: rnd(c) for c in ("mean_p_size", "mean_p_retailprice")})


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, " + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 4)") + " AS corr FROM lineitem" +
    (" GROUP BY ()" if a == b else "") for a in _NUM for b in _NUM).replace("1.0::DOUBLE AS corr FROM lineitem GROUP BY ()", "any_value(1.0::DOUBLE) AS corr FROM lineitem"))
def _(t):
    return A.corr_matrix(t.lineitem, _NUM)


@query("feature_target_corr", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {R(f'corr({c}, l_extendedprice)', 6)} AS corr FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")))
def _(t):
    out = A.target_correlations(t.lineitem, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return out.withColumn("corr", rnd("corr", 6))


@query("corr_by_group", " UNION ALL ".join(
    f"SELECT l_returnflag, '{c}' AS \"column\", {R(f'corr({c}, l_extendedprice)', 6)} AS corr FROM lineitem GROUP BY 1" for c in ("l_quantity", "l_discount", "l_tax")))
def _(t):
    out = A.target_correlations(t.lineitem, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"], by=["l_returnflag"])
    return out.withColumn("corr", rnd("corr", 6))


def _os(c):
    return (f"SELECT '{c}' AS \"column\", {R(f'quantile_cont({c}, 0.01)')} AS p1, {R(f'quantile_cont({c}, 0.99)')} AS p99, {R(f'avg({c})')} AS mean, "
            f"{R(f'stddev_samp({c})', 5)} AS std, {R(f'avg(CASE WHEN abs({c} - (SELECT avg({c}) FROM lineitem)) > 3 * (SELECT stddev_samp({c}) FROM lineitem) THEN 1.0 ELSE 0.0 END)', 6)} AS outlier_share FROM lineitem")


@query("outlier_summary", " UNION ALL ".join(map(_os, ["l_quantity", "l_extendedprice"])))
def _(t):
    out = A.outlier_summary(t.lineitem, ["l_quantity", "l_extendedprice"])
    return out.withColumns({"p1": rnd("p1"), "p99": rnd("p99"), "mean": rnd("mean"), "std": rnd("std", 5), "outlier_share": rnd("outlier_share", 6)})


@query("missing_pct", f"""
WITH d AS (SELECT documents.doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
m AS (SELECT avg(CAST(doc_id IS NULL AS INT)) * 100 AS a, avg(CAST(quality IS NULL AS INT)) * 100 AS b, avg(CAST(toxic IS NULL AS INT)) * 100 AS c FROM d)
SELECT 'doc_id' AS "column", {R('a')} AS missing_pct FROM m UNION ALL SELECT 'quality', {R('b')} FROM m UNION ALL SELECT 'toxic', {R('c')} FROM m
UNION ALL SELECT '*', {R('(a + b + c) / 3')} FROM m""")
def _(t):
    d = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return A.missing_pct(d).withColumn("missing_pct", rnd("missing_pct"))


def _dp():
    parts = ["SELECT 'rows' AS metric, '*' AS \"column\", CAST(count(*) AS DOUBLE) AS value FROM labels",
             "SELECT 'columns', '*', CAST(3 AS DOUBLE) FROM (SELECT 1) WHERE EXISTS (SELECT 1 FROM labels)"]
    for c in ("doc_id", "quality"):
        for n, e in (("count", f"count({c})"), ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"), ("min", f"min({c})"), ("max", f"max({c})")):
            parts.append(f"SELECT '{n}', '{c}', {R(f'CAST({e} AS DOUBLE)')} FROM labels")
    for c in ("doc_id", "quality", "toxic"):
        parts.append(f"SELECT 'missing_pct', '{c}', {R(f'avg(CAST({c} IS NULL AS INT)) * 100.0')} FROM labels")
    parts.append(f"SELECT 'class_pct', CAST(toxic AS VARCHAR), {R('count(*) * 100.0 / sum(count(*)) OVER ()')} FROM labels GROUP BY toxic")
    parts.append("SELECT 'n_classes', 'toxic', CAST(count(DISTINCT toxic) AS DOUBLE) FROM labels")
    parts.append("SELECT 'is_imbalanced', 'toxic', CAST(min(n) * 100.0 / sum(n) < 20 AS INT)::DOUBLE FROM (SELECT count(*) AS n FROM labels GROUP BY toxic)")
    return " UNION ALL ".join(parts)


@query("dataset_profile", _dp())
def _(t):
    return A.dataset_profile(t.labels, "toxic").withColumn("value", F.when(
        F.col("metric").isin("rows", "columns", "n_classes", "is_imbalanced"), F.col("value")).otherwise(rnd("value")))


@query("infer_task_type", "SELECT CAST(count(DISTINCT l_quantity) AS BIGINT) AS n_unique, CASE WHEN count(DISTINCT l_quantity) <= 20 "
       "OR count(DISTINCT l_quantity) / count(*) < 0.05 THEN 'classification' ELSE 'regression' END AS task FROM lineitem")
def _(t):
    return A.infer_task_type(t.lineitem, "l_quantity")


@query("quality_score", """
WITH d AS (SELECT documents.doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
p AS (SELECT count(*) AS n, sum(CAST(quality IS NULL AS INT) + CAST(toxic IS NULL AS INT)) / (count(*) * 3.0) AS miss FROM d),
i AS (SELECT max(n) / min(n) AS imb FROM (SELECT count(*) AS n FROM d WHERE toxic IS NOT NULL GROUP BY toxic))
SELECT CAST(n AS BIGINT) AS n, round(1.0 - CASE WHEN n < 100 THEN .4 WHEN n < 1000 THEN .2 ELSE 0 END - CASE WHEN miss > .5 THEN .3 WHEN miss > .1 THEN .1 ELSE 0 END
 - CASE WHEN imb > 10 THEN .2 WHEN imb > 3 THEN .05 ELSE 0 END, 4)::DOUBLE AS score FROM p, i""")
def _(t):
    d = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return A.quality_score(d, "toxic").select("n", "score")


@query("conditional_funnel_counts", """
SELECT 'quantity' AS stage, CAST(count(*) FILTER (l_quantity BETWEEN 5 AND 30) AS BIGINT) AS n FROM lineitem
UNION ALL SELECT 'price', CAST(count(*) FILTER (l_quantity BETWEEN 5 AND 30 AND l_extendedprice < 40000) AS BIGINT) FROM lineitem
UNION ALL SELECT 'tax', CAST(count(*) FILTER (l_quantity BETWEEN 5 AND 30 AND l_extendedprice < 40000 AND l_tax <= 0.05) AS BIGINT) FROM lineitem""")
def _(t):
    return A.funnel_counts(t.lineitem, {"quantity": F.col("l_quantity").between(5, 30), "price": F.col("l_extendedprice") < 40000,
                                        "tax": F.col("l_tax") <= 0.05})


@query("class_weights", f"""
WITH c AS (SELECT label, count(*) AS n, (CASE WHEN label = 3 THEN 2.0 ELSE 1.0 END) / (count(*) + 1e-6) AS w FROM embeddings GROUP BY label)
SELECT label, CAST(n AS BIGINT) AS n, {R('w / (SELECT sum(w) / count(*) FROM c)', 6)} AS weight FROM c""")
def _(t):
    return A.class_weights(t.embeddings, "label", {3: 2.0}).withColumn("weight", rnd("weight", 6))


@query("positive_weight", f"SELECT {R('count(*) FILTER (toxic = 0) / count(*) FILTER (toxic = 1)', 6)} AS pos_weight FROM labels")
def _(t):
    return A.positive_weight(t.labels, "toxic").select(rnd("pos_weight", 6).alias("pos_weight"))


@query("mean_over_files", f"SELECT {R('sum(value)', 2)} AS total, {R('avg(value)')} AS mean, CAST(count(*) AS BIGINT) AS n FROM events")
def _(t):
    path = scratch(t.spark, "shards")
    t.events.select("event_id", "value").write.option("maxRecordsPerFile", 2000).json(path)
    shards = t.spark.read.schema("event_id long, value double").json(path)
    return shards.agg(rnd(F.sum("value"), 2).alias("total"), rnd(F.avg("value")).alias("mean"), _n())


@query("tree_reduce", f"SELECT {R('sum(l_extendedprice)', 2)} AS total FROM lineitem")
def _(t):
    # Partial and final aggregation are the two levels of the tree.
    return t.lineitem.agg(rnd(F.sum("l_extendedprice"), 2).alias("total"))


def _partial(rows: pd.DataFrame) -> dict:
    return {"n": int(len(rows)), "energy": float((rows["value"] ** 2).sum())}


def _merge(a: dict, b: dict) -> dict:
    return {"n": a["n"] + b["n"], "energy": a["energy"] + b["energy"]}


@query("grouped_custom_reduce", f"SELECT event_type, CAST(count(*) AS BIGINT) AS n, {R('sum(value * value)', 2)} AS energy, "
       "CAST(0 AS BIGINT) AS rerun_rows FROM events GROUP BY 1")
def _(t):
    path = scratch(t.spark, "reduced")
    e = t.events.select("event_type", "value")
    A.grouped_reduce(e, "event_type", _partial, _merge, "n long, energy double").write.parquet(path)
    done = t.spark.read.parquet(path)
    again = A.grouped_reduce(e, "event_type", _partial, _merge, "n long, energy double", done=done)
    return done.select("event_type", "n", rnd("energy", 2).alias("energy"),
                       again.agg(F.count(F.lit(1))).scalar().alias("rerun_rows"))


@query("top_bottom_union", """
WITH c AS (SELECT c_custkey, c_acctbal FROM customer)
(SELECT c_custkey, c_acctbal, 'top' AS side FROM c ORDER BY c_acctbal DESC, c_custkey LIMIT 10) UNION ALL
(SELECT c_custkey, c_acctbal, 'bottom' FROM c ORDER BY c_acctbal, c_custkey LIMIT 10)""")
def _(t):
    return A.top_bottom(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 10, "c_custkey")


@query("metric_by_config", f"""
WITH r AS (SELECT DISTINCT event_type, user_id % 4 AS batch, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value FROM events)
SELECT event_type, batch, {R('avg(value)')} AS mean_value, {R('max(value)')} AS max_value FROM r WHERE value IS NOT NULL GROUP BY 1, 2""")
def _(t):
    e = t.events.select("event_type", (F.col("user_id") % 4).alias("batch"),
                        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"), (F.col("event_id") % 2).alias("half"))
    runs = [e.where("half = 0").drop("half"), e.where("half = 1").drop("half")]
    out = A.metric_by_config(runs, ["event_type", "batch"], "value")
    return out.withColumns({"mean_value": rnd("mean_value"), "max_value": rnd("max_value")})


@query("status_counts", """
SELECT CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS finished, CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS failed,
 CAST(count(*) - count(*) FILTER (o_orderstatus IN ('F', 'O')) AS BIGINT) AS queued FROM orders""")
def _(t):
    s = F.col("o_orderstatus")
    return t.orders.agg(F.count_if(s == "F").alias("finished"), F.count_if(s == "O").alias("failed"),
                        (F.count(F.lit(1)) - F.count_if(s.isin("F", "O"))).alias("queued"))


@query("best_row", "SELECT arg_max(o_orderkey, {'a': o_totalprice, 'b': o_orderkey}) AS best, arg_min(o_orderkey, {'a': o_totalprice, 'b': o_orderkey}) AS worst FROM orders")
def _(t):
    by = F.struct("o_totalprice", "o_orderkey")
    return t.orders.agg(F.max_by("o_orderkey", by).alias("best"), F.min_by("o_orderkey", by).alias("worst"))


@query("unit_template_mean", f"""
WITH v AS (SELECT label, vec_id % 3 AS media, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
m AS (SELECT label, media, pos, avg(x) AS x FROM v GROUP BY ALL), s AS (SELECT label, pos, sum(x) AS x FROM m GROUP BY ALL)
SELECT label, CAST(pos AS INTEGER) AS pos, {R('x / sqrt(sum(x * x) OVER (PARTITION BY label))', 6)} AS x FROM s""")
def _(t):
    e = t.embeddings.withColumn("media", F.col("vec_id") % 3)
    out = A.template_mean(e, "label", "media", "embedding", 64)
    return out.select("label", F.posexplode("embedding").alias("pos", "x")).withColumn("x", rnd("x", 6))
