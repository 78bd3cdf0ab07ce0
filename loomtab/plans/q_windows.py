"""Ordered features over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtab.operators import indicators as I, windows as W
from loomtab.operators.ordered import row_index, running
from loomtab.plans.registry import R, query, rnd
from loomtab.sources import files as S

_BY, _ORD = ["user_id"], ["ts", "event_id"]
_W = "(PARTITION BY user_id ORDER BY ts, event_id"


@query("rolling_stats", f"""
SELECT event_id, {R('avg(value) OVER w6', 5)} AS mean_6, {R('coalesce(stddev_samp(value) OVER w6, 0)', 5)} AS std_6,
 min(value) OVER w6 AS min_6, max(value) OVER w6 AS max_6, {R('avg(value) OVER w12', 5)} AS mean_12 FROM events
WINDOW w6 AS {_W} ROWS 5 PRECEDING), w12 AS {_W} ROWS 11 PRECEDING)""")
def _(t):
    out = W.rolling_stats(t.events, _BY, _ORD, ["value"], [6, 12])
    return out.select("event_id", rnd("value_mean_6", 5).alias("mean_6"), rnd("value_std_6", 5).alias("std_6"),
                      F.col("value_min_6").alias("min_6"), F.col("value_max_6").alias("max_6"),
                      rnd("value_mean_12", 5).alias("mean_12"))


@query("lag_features", f"SELECT event_id, lag(value, 1) OVER {_W}) AS lag_1, lag(value, 3) OVER {_W}) AS lag_3 FROM events")
def _(t):
    out = W.lag_features(t.events, _BY, _ORD, ["value"], [1, 3])
    return out.select("event_id", F.col("value_lag_1").alias("lag_1"), F.col("value_lag_3").alias("lag_3"))


def _holes(t):
    return t.events.withColumn("value", F.when(F.col("event_id") % 3 != 0, F.col("value")))


_HOLES = "(SELECT event_id, user_id, ts, CASE WHEN event_id % 3 <> 0 THEN value END AS value FROM events)"


@query("forward_fill", f"SELECT event_id, coalesce(last_value(value IGNORE NULLS) OVER {_W}), 0) AS value FROM {_HOLES}")
def _(t):
    return W.forward_fill(_holes(t), _BY, _ORD, ["value"], 0.0).select("event_id", "value")


@query("ffill_bfill_mean", f"""
SELECT event_id, {R(f'''coalesce(last_value(value IGNORE NULLS) OVER {_W}),
  first_value(value IGNORE NULLS) OVER {_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), (SELECT avg(value) FROM {_HOLES}))''')} AS value FROM {_HOLES}""")
def _(t):
    return W.fill_both_ways(_holes(t), _BY, _ORD, "value").select("event_id", rnd("value").alias("value"))


@query("drop_or_zero_fill", f"SELECT 'drop' AS how, event_id, value FROM {_HOLES} WHERE value IS NOT NULL UNION ALL SELECT 'zero', event_id, coalesce(value, 0) FROM {_HOLES}")
def _(t):
    h = _holes(t).select("event_id", "value")
    return h.dropna().select(F.lit("drop").alias("how"), "*").unionByName(h.fillna(0.0).select(F.lit("zero").alias("how"), "*"))


@query("days_since_flag", f"""
WITH e AS (SELECT event_id, user_id, ts, CAST(ts AS DATE) AS d, event_type = 'error' AS f FROM events)
SELECT event_id, CAST(date_diff('day', coalesce(max(CASE WHEN f THEN d END) OVER {_W}), min(d) OVER {_W})), d) AS INTEGER) AS after_error,
 CAST(date_diff('day', coalesce(min(CASE WHEN f THEN d END) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC),
   max(d) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)), d) AS INTEGER) AS before_error FROM e""")
def _(t):
    e = t.events.withColumn("d", F.to_date("ts"))
    return (W.days_since_flag(e, _BY, _ORD, "d", F.col("event_type") == "error", "error")
            .select("event_id", "after_error", "before_error"))


@query("keep_last_per_key", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def _(t):
    out = W.top_per_group(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return out.select("o_custkey", "o_orderkey", "o_totalprice")


@query("topk_per_group", "SELECT source, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) "
       "<= 100 // (SELECT count(DISTINCT source) FROM documents)")
def _(t):
    d = t.documents.select("source", "doc_id", "n_chars")
    return W.top_per_group(d, ["source"], [F.desc("n_chars"), F.asc("doc_id")], W.even_share(d, "source", 100))


@query("rank_by_two", f"""
WITH s AS (SELECT l_suppkey, round(sum(l_extendedprice), 0) AS revenue, sum(l_quantity) AS qty FROM lineitem GROUP BY 1)
SELECT l_suppkey, CAST(row_number() OVER (ORDER BY revenue DESC, qty DESC, l_suppkey) AS BIGINT) AS rank FROM s""")
def _(t):
    s = t.lineitem.groupBy("l_suppkey").agg(F.round(F.sum("l_extendedprice"), 0).alias("revenue"), F.sum("l_quantity").alias("qty"))
    s = s.withColumns({"_a": -F.col("revenue"), "_b": -F.col("qty")})
    return row_index(s, [], ["_a", "_b", "l_suppkey"], "rank").select("l_suppkey", (F.col("rank") + 1).alias("rank"))


_DAY = "(SELECT event_type, CAST(ts AS DATE) AS d, avg(value) AS close FROM events GROUP BY ALL)"


@query("prior_next_order", f"""
WITH d AS {_DAY}, w AS (SELECT *, avg(close) OVER (PARTITION BY event_type ORDER BY d ROWS 4 PRECEDING) AS ma,
  close / lag(close) OVER (PARTITION BY event_type ORDER BY d) - 1 AS ret FROM d),
v AS (SELECT *, stddev_samp(ret) OVER (PARTITION BY event_type ORDER BY d ROWS 4 PRECEDING) AS vol FROM w)
SELECT a.event_type, b.event_type AS other, a.d, {R('a.ma', 5)} AS ma, {R('a.ret', 5)} AS ret, {R('a.vol', 5)} AS vol, {R('a.close - b.close', 5)} AS spread
FROM v a JOIN v b ON a.d = b.d AND b.event_type = 'click' AND a.event_type <> 'click'""")
def _(t):
    d = t.events.groupBy("event_type", F.to_date("ts").alias("d")).agg(F.avg("value").alias("close"))
    return S.sql_query(t.spark, """
        WITH w AS (SELECT *, avg(close) OVER (PARTITION BY event_type ORDER BY d ROWS 4 PRECEDING) AS ma,
                   close / lag(close) OVER (PARTITION BY event_type ORDER BY d) - 1 AS ret FROM {d}),
             v AS (SELECT *, stddev_samp(ret) OVER (PARTITION BY event_type ORDER BY d ROWS 4 PRECEDING) AS vol FROM w)
        SELECT a.event_type, b.event_type AS other, a.d, round(a.ma + 1e-9, 5) AS ma, round(a.ret + 1e-9, 5) AS ret,
               round(a.vol + 1e-9, 5) AS vol, round(a.close - b.close + 1e-9, 5) AS spread
        FROM v a JOIN v b ON a.d = b.d AND b.event_type = 'click' AND a.event_type <> 'click'""", d=d)


def _bars(t):
    return I.bars(t.events, "event_type", "ts", "value", "hour")


_B = """b AS (SELECT event_type AS symbol, date_trunc('hour', ts) AS t, max(value) AS high, min(value) AS low,
 arg_max(value, ts) AS close, CAST(count(*) AS BIGINT) AS volume FROM events GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY t) AS i FROM b)"""
_P = "(PARTITION BY symbol ORDER BY t"


def _ewm(src, value, alpha, name):
    return (f"(SELECT a.symbol, a.t, a.i, sum(z.{value} * pow({1 - alpha!r}, a.i - z.i)) / sum(pow({1 - alpha!r}, a.i - z.i)) AS {name} "
            f"FROM {src} a JOIN {src} z ON a.symbol = z.symbol AND z.i <= a.i GROUP BY ALL)")


@query("sma", f"WITH {_B} SELECT symbol, t, {R(f'avg(close) OVER {_P} ROWS 49 PRECEDING)', 5)} AS sma_50, "
       f"{R(f'avg(close) OVER {_P} ROWS 199 PRECEDING)', 5)} AS sma_200 FROM n")
def _(t):
    return I.sma(_bars(t), [50, 200]).select("symbol", "t", rnd("sma_50", 5).alias("sma_50"), rnd("sma_200", 5).alias("sma_200"))


@query("ema", f"WITH {_B}, e AS {_ewm('n', 'close', 2 / 11, 'v')} SELECT symbol, t, {R('v', 5)} AS ema_10 FROM e")
def _(t):
    return I.ema(_bars(t), [10]).select("symbol", "t", rnd("ema_10", 5).alias("ema_10"))


@query("macd", f"""WITH {_B}, f AS {_ewm('n', 'close', 2 / 13, 'v')}, s AS {_ewm('n', 'close', 2 / 27, 'v')},
m AS (SELECT symbol, t, f.i, f.v - s.v AS macd FROM f JOIN s USING (symbol, t)), g AS {_ewm('m', 'macd', 2 / 10, 'sig')}
SELECT symbol, t, {R('macd', 5)} AS macd, {R('sig', 5)} AS signal, {R('macd - sig', 5)} AS hist FROM m JOIN g USING (symbol, t)""")
def _(t):
    return I.macd(_bars(t)).select("symbol", "t", rnd("macd", 5).alias("macd"), rnd("macd_signal", 5).alias("signal"),
                                   rnd("macd_hist", 5).alias("hist"))


@query("rsi", f"""WITH {_B}, d AS (SELECT *, coalesce(close - lag(close) OVER {_P}), 0) AS d FROM n),
g AS (SELECT symbol, t, i, greatest(d, 0) AS up, greatest(-d, 0) AS down FROM d),
u AS {_ewm('g', 'up', 1 / 14, 'u')}, w AS {_ewm('g', 'down', 1 / 14, 'w')}
SELECT symbol, t, {R('CASE WHEN u + w > 1e-12 THEN 100 * u / (u + w) END', 4)} AS rsi FROM u JOIN w USING (symbol, t)""")
def _(t):
    return I.rsi(_bars(t)).select("symbol", "t", rnd("rsi", 4).alias("rsi"))


@query("bollinger", f"""WITH {_B}, w AS (SELECT *, avg(close) OVER {_P} ROWS 19 PRECEDING) AS m, stddev_samp(close) OVER {_P} ROWS 19 PRECEDING) AS s FROM n)
SELECT symbol, t, {R('m', 5)} AS boll, {R('m + 2 * s', 5)} AS ub, {R('m - 2 * s', 5)} AS lb FROM w""")
def _(t):
    return I.bollinger(_bars(t)).select("symbol", "t", rnd("boll", 5).alias("boll"), rnd("boll_ub", 5).alias("ub"), rnd("boll_lb", 5).alias("lb"))


@query("atr", f"""WITH {_B}, p AS (SELECT *, lag(close) OVER {_P}) AS pc FROM n),
r AS (SELECT symbol, t, i, greatest(high - low, abs(high - pc), abs(low - pc)) AS tr FROM p), a AS {_ewm('r', 'tr', 1 / 14, 'atr')}
SELECT symbol, t, {R('tr', 5)} AS tr, {R('atr', 5)} AS atr FROM r JOIN a USING (symbol, t)""")
def _(t):
    return I.atr(_bars(t)).select("symbol", "t", rnd("tr", 5).alias("tr"), rnd("atr", 5).alias("atr"))


@query("vwma", f"WITH {_B} SELECT symbol, t, {R(f'sum((high + low + close) / 3 * volume) OVER {_P} ROWS 13 PRECEDING) / sum(volume) OVER {_P} ROWS 13 PRECEDING)', 5)} AS vwma FROM n")
def _(t):
    return I.vwma(_bars(t)).select("symbol", "t", rnd("vwma", 5).alias("vwma"))


@query("mfi", f"""WITH {_B}, p AS (SELECT *, (high + low + close) / 3 AS tp FROM n), m AS (SELECT *, tp - lag(tp) OVER {_P}) AS mv FROM p),
s AS (SELECT symbol, t, sum(CASE WHEN mv > 0 THEN tp * volume ELSE 0 END) OVER {_P} ROWS 13 PRECEDING) AS up,
 sum(CASE WHEN mv < 0 THEN tp * volume ELSE 0 END) OVER {_P} ROWS 13 PRECEDING) AS down FROM m)
SELECT symbol, t, {R('CASE WHEN up + down > 1e-9 THEN 100 * up / (up + down) ELSE 50 END', 4)} AS mfi FROM s""")
def _(t):
    return I.mfi(_bars(t)).select("symbol", "t", rnd("mfi", 4).alias("mfi"))


@query("indicator_lookup", f"""
WITH s AS (SELECT CAST(ts AS DATE) AS date, avg(value) AS v FROM events WHERE event_type = 'click' AND isodow(ts) <= 5 GROUP BY 1),
c AS (SELECT CAST(DATE '2024-01-25' - CAST(i AS INTEGER) AS DATE) AS date FROM range(0, 15) r(i))
SELECT date, coalesce(CAST(CAST(round(v * 100 + 1e-6) AS BIGINT) AS VARCHAR), 'N/A: not a trading day') AS value FROM c LEFT JOIN s USING (date) ORDER BY date DESC""")
def _(t):
    s = (t.events.where("event_type = 'click' and weekday(ts) < 5").groupBy(F.to_date("ts").alias("date"))
         .agg(F.round(F.avg("value") * 100 + 1e-6).cast("long").alias("value")))
    return W.lookback_values(s, "date", "value", "2024-01-25", 14)


@query("time_bucket_trend", f"""
WITH a AS (SELECT time_bucket(INTERVAL 6 HOURS, ts) AS b, count(*) AS n, avg(value) AS m, sum(value) AS s FROM events WHERE event_id % 97 < 3 GROUP BY 1),
c AS (SELECT unnest(generate_series((SELECT min(b) FROM a), (SELECT max(b) FROM a), INTERVAL 6 HOURS)) AS b)
SELECT c.b AS bucket, CAST(coalesce(n, 0) AS BIGINT) AS n, {R('m')} AS mean, {R('coalesce(s, 0)')} AS total FROM c LEFT JOIN a ON a.b = c.b ORDER BY c.b DESC LIMIT 60""".replace(" WHERE event_id % 97 < 3", " WHERE event_type = 'signup'"))
def _(t):
    out = W.time_bucket_trend(t.events.where("event_type = 'signup'"), "ts", ["value"], "6h", 60)
    return out.select("bucket", "n", rnd("value_mean").alias("mean"), rnd("value_sum").alias("total"))


@query("zscore_normalize", f"SELECT event_id, {R('(value - (SELECT avg(value) FROM events)) / (SELECT stddev_samp(value) FROM events)', 5)} AS value FROM events")
def _(t):
    return W.zscore(t.events, ["value"]).select("event_id", rnd("value", 5).alias("value"))


@query("group_normalized_score", f"""SELECT event_id, {R('(value - avg(value) OVER (PARTITION BY user_id)) / (stddev_pop(value) OVER (PARTITION BY user_id) + 1e-4)', 5)} AS score FROM events""")
def _(t):
    return W.group_normalized(t.events, ["user_id"], "value").select("event_id", rnd("score", 5).alias("score"))


_SCORE = "CAST(('0x' || left(md5(CAST(doc_id AS VARCHAR)), 7)) AS BIGINT) / 268435456.0"


def scored_labels(t, target="quality"):
    score = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 7), 16, 10).cast("long") / 268435456.0
    return t.labels.select("doc_id", F.col(target).alias("y"), score.alias("p"))


@query("cumulative_weighted_gini", f"""
WITH s AS (SELECT quality AS y, {_SCORE} AS p, doc_id, 20.0 - quality * 19.0 AS w FROM labels),
c AS (SELECT *, sum(w) OVER (ORDER BY p DESC, doc_id) / sum(w) OVER () AS cw, sum(y * w) OVER (ORDER BY p DESC, doc_id) / sum(y * w) OVER () AS lz FROM s),
g AS (SELECT sum(CASE WHEN cw <= 0.04 THEN y ELSE 0 END) / sum(y) AS d, sum((lz - cw) * w) AS gini, sum(y) AS np, CAST(count(*) - sum(y) AS DOUBLE) AS nn FROM c)
SELECT {R('d', 6)} AS capture, {R('gini / (10 * nn * (np + 20 * nn - 19) / (np + 20 * nn))', 6)} AS gini,
 {R('0.5 * (d + gini / (10 * nn * (np + 20 * nn - 19) / (np + 20 * nn)))', 6)} AS score FROM g""")
def _(t):
    from loomtab.operators.metrics import weighted_gini
    out = weighted_gini(scored_labels(t), "y", "p", "doc_id")
    return out.select(*[rnd(c, 6).alias(c) for c in ("capture", "gini", "score")])


@query("cluster_margin_ecdf", f"""
WITH e AS (SELECT vec_id, list_sort([abs(embedding[1])::DOUBLE, abs(embedding[2])::DOUBLE, abs(embedding[3])::DOUBLE], 'DESC') AS p FROM embeddings WHERE label <> 0),
m AS (SELECT vec_id, round(p[1] - p[2], 3) AS margin FROM e)
SELECT vec_id, margin, {R('cume_dist() OVER (ORDER BY margin)', 6)} AS ecdf FROM m""")
def _(t):
    probs = F.array(*[F.abs(F.get("embedding", F.lit(i))).cast("double") for i in range(3)])
    m = (t.embeddings.where("label <> 0").withColumn("p", probs)
         .select("vec_id", F.round(W.top_two_margin("p"), 3).alias("margin")))
    return W.ecdf(m, "margin").select("vec_id", "margin", rnd("ecdf", 6).alias("ecdf"))


@query("running_version_chain", """
SELECT conv_id, turn, role, lag(sha256(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS old_sha, sha256(text) AS new_sha FROM conversations""")
def _(t):
    return W.version_chain(t.conversations, "conv_id", ["turn"], "text").select("conv_id", "turn", "role", "old_sha", "new_sha")


@query("version_current", "SELECT conv_id, max(turn) AS turn, arg_max(sha256(text), turn) AS sha FROM conversations GROUP BY conv_id")
def _(t):
    return t.conversations.groupBy("conv_id").agg(F.max("turn").alias("turn"), F.max_by(F.sha2("text", 256), "turn").alias("sha"))


@query("running_total", f"SELECT event_id, {R('sum(value) OVER (ORDER BY ts, event_id)', 3)} AS total FROM events")
def _(t):
    return running(t.events, [], _ORD, {"total": ("sum", F.col("value"))}).select("event_id", rnd("total", 3).alias("total"))
