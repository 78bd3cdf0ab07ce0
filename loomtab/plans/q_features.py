"""Features, contracts, drift and feature tables over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtab.operators import features as E, quality as Q
from loomtab.plans.registry import R, query, rnd
from loomtab.session import scratch


def _gaps(t):
    c = F.col
    return t.customer.select(
        "c_custkey", F.when(c("c_custkey") % 4 != 0, c("c_acctbal")).alias("bal"),
        F.when(c("c_custkey") % 5 != 0, c("c_mktsegment")).alias("seg"),
        F.when(c("c_custkey") % 11 != 0, c("c_nationkey")).alias("target"))


_GAPS = """g AS (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS bal, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS seg,
 CASE WHEN c_custkey % 11 <> 0 THEN c_nationkey END AS target FROM customer)"""


@query("fill_median_mode", f"""WITH {_GAPS}, k AS (SELECT * FROM g WHERE target IS NOT NULL),
m AS (SELECT seg FROM g WHERE seg IS NOT NULL GROUP BY seg ORDER BY count(*) DESC, seg LIMIT 1)
SELECT c_custkey, {R('coalesce(bal, (SELECT quantile_cont(bal, 0.5) FROM g))')} AS bal, coalesce(seg, (SELECT seg FROM m)) AS seg, target FROM k""")
def _(t):
    return E.fill_median_mode(_gaps(t), "target").select(F.col("c_custkey").cast("long"), rnd("bal").alias("bal"), "seg", "target")


@query("impute_mean_median", f"""WITH {_GAPS} SELECT 'mean' AS how, c_custkey, {R('coalesce(bal, (SELECT avg(bal) FROM g))')} AS bal FROM g
UNION ALL SELECT 'median', c_custkey, {R('coalesce(bal, (SELECT quantile_cont(bal, 0.5) FROM g))')} FROM g""")
def _(t):
    g = _gaps(t).select("c_custkey", "bal")
    parts = [E.impute(g, how, ["c_custkey"]).select(F.lit(how).alias("how"), "c_custkey", rnd("bal").alias("bal")) for how in ("mean", "median")]
    return parts[0].unionByName(parts[1])


@query("one_hot_encode", "SELECT o_orderkey, " + ", ".join(f"CAST(o_orderstatus = '{v}' AS INTEGER) AS \"o_orderstatus_{v}\"" for v in "FOP") + " FROM orders")
def _(t):
    return E.one_hot(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", 10).drop("o_orderstatus")


@query("label_encode", "SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS code FROM part")
def _(t):
    return E.label_encode(t.part.select("p_partkey", "p_brand"), "p_brand", "code").select("p_partkey", "code")


@query("vocabulary_lookup", """
WITH v AS (SELECT DISTINCT nullif(p_type, 'ECONOMY') AS k FROM part), d AS (SELECT k, row_number() OVER (ORDER BY coalesce(k, ''), k IS NOT NULL) - 1 AS code FROM v)
SELECT p_partkey, CAST(code AS BIGINT) AS code FROM part JOIN d ON nullif(p_type, 'ECONOMY') IS NOT DISTINCT FROM k""")
def _(t):
    p = t.part.select("p_partkey", F.nullif(F.col("p_type"), F.lit("ECONOMY")).alias("kind"))
    vocab = E.vocabulary([p.where("p_partkey % 2 = 0"), p.where("p_partkey % 2 = 1")], "kind")
    return E.lookup_code(p, vocab, "kind", "code").select("p_partkey", "code")


_TRAIN = "(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"


@query("robust_scale", f"""WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.5) AS m, quantile_cont(o_totalprice, 0.75) AS b FROM {_TRAIN})
SELECT o_orderkey, {R('(o_totalprice - m) / (b - a)', 6)} AS scaled FROM orders, q""")
def _(t):
    train = t.orders.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp"))
    return E.robust_scale(train, t.orders, ["o_totalprice"]).select("o_orderkey", rnd("o_totalprice", 6).alias("scaled"))


@query("select_variance", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {R(f'var_pop({c})', 3)} AS variance, var_pop({c}) > 0.01 AS kept FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")))
def _(t):
    return E.variance_report(t.lineitem, ["l_quantity", "l_discount", "l_tax"]).withColumn("variance", rnd("variance", 3))


@query("select_correlation", """SELECT p_partkey, p_size, p_retailprice, target FROM (SELECT *, p_retailprice * 2 AS target FROM part)""")
def _(t):
    price = F.col("p_retailprice")
    df = t.part.select("p_partkey", "p_size", "p_retailprice", (price * 2).alias("target"),
                       (price * 3 + F.col("p_size") * 0.01).alias("near_copy"))
    return E.select_correlation(df, ["p_size", "p_retailprice", "near_copy"], "target", 0.95)


def _mi(c):
    return f"""SELECT '{c}' AS "column", {R('sum(n / nt * ln(n * nt / (nb * ny)))', 6)} AS mi FROM (
 SELECT *, CAST(sum(n) OVER () AS DOUBLE) AS nt, CAST(sum(n) OVER (PARTITION BY b) AS DOUBLE) AS nb, CAST(sum(n) OVER (PARTITION BY y) AS DOUBLE) AS ny
 FROM (SELECT l_returnflag AS y, least(9, floor(({c} - (SELECT min({c}) FROM lineitem)) / (SELECT max({c}) - min({c}) FROM lineitem) * 10)) AS b, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY ALL))"""


@query("select_mutual_info", " UNION ALL ".join(map(_mi, ["l_quantity", "l_extendedprice", "l_tax"])))
def _(t):
    return E.mutual_information(t.lineitem, ["l_quantity", "l_extendedprice", "l_tax"], "l_returnflag").withColumn("mi", rnd("mi", 6))


_NEAR = ["l_quantity", "l_extendedprice"]


def _near():
    """The estimate by nearest neighbours (three of a class), for rows of any class size above three."""
    raw = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", l_returnflag AS y, l_orderkey * 8 + l_linenumber AS id, CAST({c} AS DOUBLE) AS raw FROM lineitem" for c in _NEAR)
    pairs = [(a, b) for a, b in (("x", "h3"), ("l1", "h2"), ("l2", "h1"), ("l3", "x"))]
    picks = ", ".join(f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {{'r': greatest(x - {a}, {b} - x), 'a': {a}, 'b': {b}}} END" for a, b in pairs)
    return f"""WITH raw AS ({raw}), st AS (SELECT "column", stddev_pop(raw) AS d, avg(abs(raw)) AS a, count(*) AS n FROM raw GROUP BY 1),
r AS (SELECT "column", y, id, raw / d + ((id % 2147483648) * 2654435761 % 4294967296) / 4294967296 * 1e-10 * greatest(1.0, a / d) AS x,
 count(*) OVER (PARTITION BY "column", y) AS ny FROM raw JOIN st USING ("column")),
w AS (SELECT *, lag(x, 1) OVER o AS l1, lag(x, 2) OVER o AS l2, lag(x, 3) OVER o AS l3, lead(x, 1) OVER o AS h1, lead(x, 2) OVER o AS h2, lead(x, 3) OVER o AS h3
 FROM r WINDOW o AS (PARTITION BY "column", y ORDER BY x, id)),
c AS (SELECT "column", y, id, x, ny, list_min(list_filter([{picks}], lambda p: p IS NOT NULL)) AS c FROM w),
e AS (SELECT "column", id, x, CASE WHEN x - c.a = c.r THEN c.a ELSE x - c.r END AS a, CASE WHEN c.b - x = c.r THEN c.b ELSE x + c.r END AS b FROM c),
m AS (SELECT "column", id, b AS v, 0 AS kind FROM e UNION ALL SELECT "column", id, x, 1 FROM e UNION ALL SELECT "column", id, a, 2 FROM e),
k AS (SELECT "column", id, kind, sum(CAST(kind = 1 AS INT)) OVER (PARTITION BY "column" ORDER BY v, kind, id ROWS UNBOUNDED PRECEDING) AS rank FROM m),
i AS (SELECT "column", id, sum(CASE kind WHEN 0 THEN rank WHEN 2 THEN -rank ELSE 0 END) AS m FROM k GROUP BY 1, 2),
of_m AS (SELECT "column", avg({E.digamma_sql('m')}) AS of_m, count(*) AS n FROM i GROUP BY 1),
of_c AS (SELECT "column", avg({E.digamma_sql('3')} - {E.digamma_sql('ny')}) AS of_class FROM r GROUP BY 1)
SELECT "column", {R(f"greatest(0.0, {E.digamma_sql('n')} + of_class - of_m)", 9)} AS mi FROM of_m JOIN of_c USING ("column")"""


@query("select_mutual_info_neighbors", _near())
def _(t):
    rows = t.lineitem.withColumn("id", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return E.neighbor_information(rows, _NEAR, "l_returnflag", "id").withColumn("mi", rnd("mi", 9))


def _f(c):
    return f"""SELECT '{c}' AS "column", {R('(sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*)))', 5)} AS f
 FROM (SELECT l_linestatus, count(*) AS n, avg({c}) AS m, var_pop({c}) AS v, (SELECT avg({c}) FROM lineitem) AS g FROM lineitem GROUP BY 1)"""


@query("select_kbest_f", " UNION ALL ".join(map(_f, ["l_quantity", "l_extendedprice", "l_discount"])))
def _(t):
    return E.anova_f(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"], "l_linestatus").withColumn("f", rnd("f", 5))


@query("select_variance_applied", "SELECT p_partkey, p_size, p_retailprice FROM part")
def _(t):
    df = t.part.select("p_partkey", "p_size", "p_retailprice", F.lit(3).alias("constant"), F.when(F.col("p_size") < 0, 1.0).alias("never"))
    return E.select_variance(df, ["p_size", "p_retailprice", "constant", "never"])


_FLAGGED = "CAST(CASE WHEN l_linestatus = 'F' THEN 100 ELSE 0 END AS INTEGER) + l_linenumber"


def _with_signal(t):
    signal = F.when(F.col("l_linestatus") == "F", 100).otherwise(0) + F.col("l_linenumber")
    return t.lineitem.select("l_orderkey", "l_linestatus", "l_quantity", "l_tax", signal.alias("signal"))


@query("select_kbest_applied", f"SELECT l_orderkey, l_linestatus, {_FLAGGED} AS signal FROM lineitem")
def _(t):
    df, cols = _with_signal(t), ["l_quantity", "l_tax", "signal"]
    return E.select_top(df, E.anova_f(df, cols, "l_linestatus"), "f", cols, 1)


@query("select_mutual_info_applied", f"SELECT l_orderkey, l_linestatus, {_FLAGGED} AS signal FROM lineitem")
def _(t):
    df, cols = _with_signal(t), ["l_quantity", "l_tax", "signal"]
    return E.select_top(df, E.mutual_information(df, cols, "l_linestatus"), "mi", cols, 1)


# ---- contracts ---------------------------------------------------------------


@query("schema_contract", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def _(t):
    base = Q.Contract({"c_custkey": "long", "c_name": "string"})
    child = base.extend({"c_nationkey": "int"})
    return Q.enforce(t.customer.select("c_custkey", "c_name", "c_nationkey"), child)


_RULES = [("l_quantity >= 3", "l_quantity < 3"), ("l_discount <= 0.08", "l_discount > 0.08"),
          ("l_tax in [0.01, 0.07]", "l_tax NOT BETWEEN 0.01 AND 0.07"), ("l_returnflag in ['A', 'N']", "l_returnflag NOT IN ('A', 'N')")]


@query("range_and_set_checks", " UNION ALL ".join(
    f"SELECT '{n.replace(chr(39), chr(39) * 2)}' AS rule, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER ({b}) AS BIGINT) AS n_bad, count(*) FILTER ({b}) = 0 AS ok FROM lineitem" for n, b in _RULES))
def _(t):
    return Q.check_rules(t.lineitem, [Q.at_least("l_quantity", 3), Q.at_most("l_discount", 0.08), Q.in_range("l_tax", 0.01, 0.07),
                                      Q.one_of("l_returnflag", ["A", "N"])])


@query("cross_column_check", """SELECT 'price per unit' AS rule, CAST(count(*) AS BIGINT) AS n_rows,
 CAST(count(*) FILTER (abs(l_extendedprice - l_quantity * p_retailprice) > 0.01 * l_extendedprice) AS BIGINT) AS n_bad FROM lineitem JOIN part ON l_partkey = p_partkey""")
def _(t):
    j = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    rule = Q.Rule("price per unit", lambda: F.abs(F.col("l_extendedprice") - F.col("l_quantity") * F.col("p_retailprice")) <= 0.01 * F.col("l_extendedprice"))
    return Q.check_rules(j, [rule]).drop("ok")


@query("on_error_mode", "SELECT 'warned' AS outcome, CAST(count(*) AS BIGINT) AS n FROM lineitem UNION ALL SELECT 'stopped', CAST(0 AS BIGINT) FROM lineitem HAVING count(*) > 0")
def _(t):
    import warnings
    contract = Q.Contract({"l_orderkey": "long", "l_quantity": "double"}, rules=(Q.at_least("l_quantity", 3),))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        kept = Q.enforce(t.lineitem, contract, "warn")
    try:
        stopped = Q.enforce(t.lineitem, contract)
    except Q.ContractError:
        stopped = t.lineitem.where("false")
    n = F.count(F.lit(1)).alias("n")
    return kept.agg(F.lit("warned").alias("outcome"), n).unionByName(stopped.agg(F.lit("stopped").alias("outcome"), n))


_SUITE = """[{"kind": "not_null", "column": "event_id"}, {"kind": "in_range", "column": "value", "low": 0, "high": 500},
 {"kind": "one_of", "column": "event_type", "values": ["click", "view", "purchase", "error"]}]"""


@query("expectation_suite", """
WITH e AS (SELECT * FROM events WHERE year(ts) = 2024 AND month(ts) = 1)
SELECT 'event_id not null' AS rule, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (event_id IS NULL) AS BIGINT) AS n_bad FROM e
UNION ALL SELECT 'value in [0, 500]', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (value NOT BETWEEN 0 AND 500) AS BIGINT) FROM e
UNION ALL SELECT 'event_type in [''click'', ''error'', ''purchase'', ''view'']', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (event_type = 'signup') AS BIGINT) FROM e""")
def _(t):
    return Q.run_suite(t.events, _SUITE, (F.col("ts") >= F.lit("2024-01-01").cast("timestamp")) & (F.col("ts") < F.lit("2024-02-01").cast("timestamp"))).drop("ok")


@query("metric_constraints", f"""
SELECT 'value' AS "column", 'min_above' AS "constraint", {R('min(value)')} AS value, min(value) > -1 AS ok FROM events
UNION ALL SELECT 'value', 'max_below', {R('max(value)')}, max(value) < 10 FROM events UNION ALL SELECT 'value', 'mean_low', {R('avg(value)')}, avg(value) >= 5 FROM events
UNION ALL SELECT 'value', 'null_pct_below', {R('avg(CAST(value IS NULL AS INT)) * 100.0')}, true FROM events""")
def _(t):
    out = Q.metric_constraints(t.events, {"value": {"min_above": -1, "max_below": 10, "mean_low": 5, "null_pct_below": 5}})
    return out.withColumn("value", rnd("value"))


_HALF = "TIMESTAMP '2024-01-15'"


@query("drift_report", f"""
WITH r AS (SELECT value AS v FROM events WHERE ts < {_HALF}), n AS (SELECT value * 1.1 AS v FROM events WHERE ts >= {_HALF}),
q AS (SELECT quantile_cont(v, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS e FROM r),
b AS (SELECT 'r' AS s, v, len(list_filter(e, lambda x: v > x)) AS b FROM r, q UNION ALL SELECT 'n', v, len(list_filter(e, lambda x: v > x)) FROM n, q),
c AS (SELECT b, greatest(count(*) FILTER (s = 'n') / (SELECT count(*) FROM n), 1e-4) AS a, greatest(count(*) FILTER (s = 'r') / (SELECT count(*) FROM r), 1e-4) AS e FROM b GROUP BY b),
k AS (SELECT max(abs(cr - cn)) AS ks FROM (SELECT sum(count(*) FILTER (s = 'r')) OVER (ORDER BY v) / (SELECT count(*) FROM r) AS cr,
  sum(count(*) FILTER (s = 'n')) OVER (ORDER BY v) / (SELECT count(*) FROM n) AS cn FROM b GROUP BY v))
SELECT 'value' AS "column", {R('((SELECT avg(v) FROM n) - (SELECT avg(v) FROM r)) / (SELECT stddev_samp(v) FROM r)', 6)} AS mean_shift,
 {R('(SELECT sum((a - e) * ln(a / e)) FROM c)', 6)} AS psi, {R('(SELECT ks FROM k)', 6)} AS ks FROM (SELECT 1)""")
def _(t):
    edge = F.lit("2024-01-15").cast("timestamp")
    ref = t.events.where(F.col("ts") < edge).select("value")
    new = t.events.where(F.col("ts") >= edge).select((F.col("value") * 1.1).alias("value"))
    out = Q.drift_if_broken(ref, new, {"value": {"max_below": 10.0}})
    return out.select("column", *[rnd(c, 6).alias(c) for c in ("mean_shift", "psi", "ks")])


@query("source_freshness", f"""
SELECT max(ts) AS newest, {R("(epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 3.6e9", 4)} AS age_hours,
 CASE WHEN (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 3.6e9 > 72 THEN 'error' WHEN (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 3.6e9 > 24 THEN 'warn' ELSE 'pass' END AS status FROM events""")
def _(t):
    return Q.freshness(t.events, "ts", "2024-02-01", 24, 72).withColumn("age_hours", rnd("age_hours"))


_LATEST = "SELECT user_id, max(ts) AS ts, arg_max(value, ts) AS value FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-04' GROUP BY user_id"


def _latest(t):
    feats = Q.latest_features(t.events, "user_id", "ts", ["value"], "2024-01-03", "2024-01-04")
    return Q.materialize_features(feats, scratch(t.spark, "features"))


@query("feature_materialize", _LATEST)
def _(t):
    return _latest(t)


@query("feature_lookup", f"WITH f AS ({_LATEST}) SELECT u.user_id, value, value IS NOT NULL AS found FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN f USING (user_id)")
def _(t):
    return Q.lookup_features(t.events.select("user_id").distinct(), _latest(t), "user_id").select("user_id", "value", "found")


@query("daily_backfill", f"""
WITH c AS (SELECT CAST(DATE '2024-01-25' + CAST(i AS INTEGER) AS DATE) AS day FROM range(0, 10) r(i)), a AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, sum(value) AS total FROM events GROUP BY 1)
SELECT day, CAST(n AS BIGINT) AS n, {R('total', 3)} AS total FROM c LEFT JOIN a USING (day)""")
def _(t):
    path = scratch(t.spark, "days")
    out = Q.backfill_days(t.spark, t.events, "ts", "2024-01-25", 10, [F.count(F.lit(1)).alias("n"), rnd(F.sum("value"), 3).alias("total")])
    Q.overwrite_days(out, path)
    return t.spark.read.parquet(path).select("day", "n", "total")
