"""Joins over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtab.functions import expr as X
from loomtab.operators import joins as J
from loomtab.plans.registry import R, query, rnd
from loomtab.sources import files as S


@query("inner_equi_join", f"SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n, {R('sum(l_quantity)', 2)} AS qty "
       "FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority")
def _(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("l_quantity"), 2).alias("qty"))


@query("left_join", "SELECT documents.doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def _(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")


_SPLIT = "TIMESTAMP '1998-07-01'"


def _facts(t):
    """Line items with their order, and whether the order is of the early period: both periods come out of one grouped pass."""
    f = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return f.withColumn("_early", F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp"))


@query("left_join_not_null", f"""
WITH f AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
h AS (SELECT l_suppkey, avg(l_quantity) AS avg_old FROM f WHERE o_orderdate < {_SPLIT} GROUP BY 1),
r AS (SELECT l_suppkey, avg(l_quantity) AS avg_new FROM f WHERE o_orderdate >= {_SPLIT} GROUP BY 1)
SELECT h.l_suppkey, {R('avg_old')} AS avg_old, {R('avg_new')} AS avg_new FROM h LEFT JOIN r ON h.l_suppkey = r.l_suppkey
WHERE avg_new IS NOT NULL""")
def _(t):
    early = F.col("_early")
    both = _facts(t).groupBy("l_suppkey").agg(F.avg(F.when(early, F.col("l_quantity"))).alias("avg_old"),
                                              F.avg(F.when(~early, F.col("l_quantity"))).alias("avg_new"), F.count_if(early).alias("_n"))
    return both.where("_n > 0 and avg_new is not null").select("l_suppkey", rnd("avg_old").alias("avg_old"), rnd("avg_new").alias("avg_new"))


def _spend(facts):
    """Orders and spend of each customer in both periods; NULL where there is none."""
    orders = facts.groupBy("o_custkey", "o_orderkey", "_early").agg(F.sum(F.col("l_quantity") * F.col("l_extendedprice")).alias("_spend"))
    out = {}
    for tag, inside in (("old", F.col("_early")), ("new", ~F.col("_early"))):
        out[f"{tag}_orders"] = F.nullif(F.count_if(inside), F.lit(0).cast("long"))
        out[f"{tag}_spend"] = F.sum(F.when(inside, F.col("_spend")))
    return orders.groupBy("o_custkey").agg(*[c.alias(n) for n, c in out.items()])


@query("left_join_null_safe_ratio", f"""
WITH f AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity > 0),
h AS (SELECT o_custkey, count(DISTINCT o_orderkey) AS old_orders, sum(l_quantity * l_extendedprice) AS old_spend
      FROM f WHERE o_orderdate < {_SPLIT} GROUP BY 1),
r AS (SELECT o_custkey, count(DISTINCT o_orderkey) AS new_orders, sum(l_quantity * l_extendedprice) AS new_spend
      FROM f WHERE o_orderdate >= {_SPLIT} GROUP BY 1)
SELECT h.o_custkey, new_orders, old_orders, {R('100.0 * new_orders / nullif(old_orders, 0)')} AS orders_pct,
       {R('new_spend', 2)} AS new_spend, {R('old_spend', 2)} AS old_spend,
       {R('100.0 * new_spend / nullif(old_spend, 0)')} AS spend_pct
FROM h LEFT JOIN r ON h.o_custkey = r.o_custkey ORDER BY spend_pct DESC, h.o_custkey""")
def _(t):
    j = _spend(_facts(t).where("l_quantity > 0")).where("old_orders > 0")
    return j.select("o_custkey", "new_orders", "old_orders",
                    rnd(X.percent_of("new_orders", "old_orders")).alias("orders_pct"),
                    rnd("new_spend", 2).alias("new_spend"), rnd("old_spend", 2).alias("old_spend"),
                    rnd(X.percent_of("new_spend", "old_spend")).alias("spend_pct")) \
        .orderBy(F.desc("spend_pct"), "o_custkey")


@query("broadcast_enrich", f"""
SELECT r_name, n_name, CAST(count(*) AS BIGINT) AS n, {R('sum(o_totalprice)', 2)} AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name""")
def _(t):
    # nation and region are a few hundred bytes; the planner broadcasts them from their file size.
    j = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    return j.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("o_totalprice"), 2).alias("total"))


@query("composite_time_key_join", f"""
WITH f AS (SELECT o_orderkey, o_totalprice, o_orderpriority, year(o_orderdate) AS y, week(o_orderdate) AS w FROM orders),
a AS (SELECT o_orderpriority, y, w, avg(o_totalprice) AS state_trend FROM f GROUP BY ALL),
b AS (SELECT y, w, avg(o_totalprice) AS trend FROM f GROUP BY ALL)
SELECT o_orderkey, {R('state_trend')} AS state_trend, {R('trend')} AS trend
FROM f JOIN a USING (o_orderpriority, y, w) JOIN b USING (y, w)""")
def _(t):
    p = X.date_parts("o_orderdate")
    f = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority", p["year"].alias("y"), p["week"].alias("w"))
    a = f.groupBy("o_orderpriority", "y", "w").agg(F.avg("o_totalprice").alias("state_trend"))
    b = f.groupBy("y", "w").agg(F.avg("o_totalprice").alias("trend"))
    return (f.join(a, ["o_orderpriority", "y", "w"]).join(b, ["y", "w"])
            .select("o_orderkey", rnd("state_trend").alias("state_trend"), rnd("trend").alias("trend")))


@query("renamed_key_join", f"""
WITH w AS (SELECT n_name AS file, CAST(o_orderdate AS DATE) AS d, max(o_totalprice) AS top
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT o_orderkey, n_name AS state_name, {R('top', 2)} AS top FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN w ON w.file = n_name AND w.d = CAST(o_orderdate AS DATE)""")
def _(t):
    f = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .select("o_orderkey", "o_totalprice", F.col("n_nationkey").alias("state"), F.to_date("o_orderdate").alias("date"),
                 F.col("n_name")))
    weather = f.groupBy(F.col("n_name").alias("file"), "date").agg(F.max("o_totalprice").alias("top"))
    names = t.nation.select(F.col("n_nationkey").alias("state"), F.col("n_name").alias("state_name"))
    weather = weather.join(names, weather.file == names.state_name)
    return (f.drop("n_name").join(weather, ["state", "date"])
            .select("o_orderkey", "state_name", rnd("top", 2).alias("top")))


@query("row_count_guard", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    c = t.customer.withColumnRenamed("c_nationkey", "n_nationkey")
    return J.checked_join(c, t.nation, ["n_nationkey"]).select("c_custkey", "n_name")


@query("pair_list_join", f"""
WITH p AS (SELECT vec_id AS p1, (vec_id * 7 + 3) % (SELECT count(*) FROM embeddings) AS p2 FROM embeddings)
SELECT p1, p2, {R("list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))", 6)} AS score
FROM p JOIN embeddings a ON a.vec_id = p1 JOIN embeddings b ON b.vec_id = p2""")
def _(t):
    n = t.embeddings.agg(F.count(F.lit(1))).scalar()
    pairs = t.embeddings.select(F.col("vec_id").alias("p1"), ((F.col("vec_id") * 7 + 3) % n).alias("p2"))
    a = t.embeddings.select(F.col("vec_id").alias("p1"), F.col("embedding").alias("a"))
    b = t.embeddings.select(F.col("vec_id").alias("p2"), F.col("embedding").alias("b"))
    return pairs.join(a, "p1").join(b, "p2").select("p1", "p2", rnd(X.dot("a", "b"), 6).alias("score"))


@query("semi_join", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def _(t):
    return t.documents.select("doc_id", "lang").join(t.labels.where("toxic = 1"), "doc_id", "left_semi")


@query("anti_join", "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def _(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left_anti")


@query("asof_join", f"""
WITH e AS (SELECT * FROM events WHERE event_type = 'purchase'),
     f AS (SELECT user_id AS u, ts AS feature_ts, value AS last_value, event_id AS feature_id FROM events WHERE event_type = 'signup')
SELECT event_id, user_id, CASE WHEN ts - feature_ts <= INTERVAL 1 DAY THEN last_value END AS last_value,
       CASE WHEN ts - feature_ts <= INTERVAL 1 DAY THEN feature_id END AS feature_id
FROM e ASOF LEFT JOIN f ON e.user_id = f.u AND e.ts >= f.feature_ts""")
def _(t):
    purchases = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    states = (t.events.where("event_type = 'signup'")
              .select("user_id", "ts", F.col("value").alias("last_value"), F.col("event_id").alias("feature_id")))
    out = J.asof_join(purchases, states, "user_id", "ts", "ts", ["last_value", "feature_id"], ttl_seconds=86_400)
    return out.select("event_id", "user_id", "last_value", "feature_id")


@query("asof_join_no_limit", """
WITH f AS (SELECT user_id AS u, ts AS fts, value AS last_value FROM events WHERE event_type = 'signup')
SELECT event_id, last_value FROM (SELECT * FROM events WHERE event_type = 'view') e
ASOF LEFT JOIN f ON e.user_id = f.u AND e.ts >= f.fts""")
def _(t):
    views = t.events.where("event_type = 'view'").select("event_id", "user_id", "ts")
    states = t.events.where("event_type = 'signup'").select("user_id", "ts", F.col("value").alias("last_value"))
    return J.asof_join(views, states, "user_id", "ts", "ts", ["last_value"]).select("event_id", "last_value")


@query("latest_published", """
SELECT o_custkey, arg_max(o_orderkey, {'d': o_orderdate, 'k': o_orderkey}) AS o_orderkey,
       arg_max(o_totalprice, {'d': o_orderdate, 'k': o_orderkey}) AS o_totalprice
FROM orders WHERE o_orderdate <= TIMESTAMP '1999-06-30' GROUP BY o_custkey""")
def _(t):
    out = J.latest_as_of(t.orders, "o_custkey", "o_orderdate", "1999-06-30", "o_orderkey", ["o_orderkey", "o_totalprice"])
    return out.select("o_custkey", "o_orderkey", "o_totalprice")


@query("range_join_region", """
WITH p AS (SELECT event_id, CAST(user_id % 60 AS DOUBLE) - 30 + value / 100 AS lat, CAST(event_id % 170 AS DOUBLE) - 85 AS lon FROM events),
r AS (SELECT n_name, n_nationkey * 2.0 - 30 AS south, n_nationkey * 2.0 - 22 AS north, n_nationkey * 6.0 - 80 AS west, n_nationkey * 6.0 - 60 AS east FROM nation)
SELECT event_id, n_name FROM p JOIN r ON lat BETWEEN south AND north AND lon BETWEEN west AND east""")
def _(t):
    points = t.events.select("event_id", ((F.col("user_id") % 60).cast("double") - 30 + F.col("value") / 100).alias("lat"),
                             ((F.col("event_id") % 170).cast("double") - 85).alias("lon"))
    k = F.col("n_nationkey")
    boxes = t.nation.select("n_name", (k * 2.0 - 30).alias("south"), (k * 2.0 - 22).alias("north"),
                            (k * 6.0 - 80).alias("west"), (k * 6.0 - 60).alias("east"))
    return J.grid_range_join(points, boxes, "lat", "lon", 10.0).select("event_id", "n_name")


@query("fallback_source", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 50")
def _(t):
    chosen = t.events.where("value > 1e12")
    rows = S.with_fallback(chosen, t.events.orderBy("event_id"), 50)
    return rows.select("event_id", "event_type")


@query("time_aligned_merge", f"""
WITH h AS (SELECT CAST(ts AS DATE) AS date, avg(value) AS value FROM events GROUP BY 1),
l AS (SELECT max(date) AS d, arg_max(value, date) AS v FROM h), m AS (SELECT avg(value) AS v FROM h)
SELECT CAST(d + CAST(i AS INTEGER) AS DATE) AS date, {R('l.v')} AS naive, {R('CASE WHEN i = 0 THEN l.v ELSE m.v END')} AS mean
FROM l, m, range(0, 8) AS r(i)""")
def _(t):
    hist = t.events.groupBy(F.to_date("ts").alias("date")).agg(F.avg("value").alias("value"))
    base = hist.agg(F.max("date").alias("d"), F.max_by("value", "date").alias("v"), F.avg("value").alias("m"))
    steps = base.withColumn("date", F.explode(F.sequence(F.date_add("d", 1), F.date_add("d", 7))))
    out = J.align_forecasts(hist, {"naive": steps.select("date", F.col("v").alias("value")),
                                   "mean": steps.select("date", F.col("m").alias("value"))})
    return out.select("date", rnd("naive").alias("naive"), rnd("mean").alias("mean"))


@query("newest_copy_wins", """
WITH a AS (SELECT o_orderkey, 'a' AS side, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END AS updated FROM orders WHERE o_orderkey % 3 <> 0),
     b AS (SELECT o_orderkey, 'b' AS side, o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER) - 1) AS updated FROM orders WHERE o_orderkey % 4 <> 0)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
       CASE WHEN a.o_orderkey IS NULL THEN 'b' WHEN b.o_orderkey IS NULL THEN 'a' WHEN a.updated IS NULL THEN 'b'
            WHEN b.updated > a.updated THEN 'b' ELSE 'a' END AS side
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""")
def _(t):
    k = F.col("o_orderkey")
    a = t.orders.where(k % 3 != 0).select("o_orderkey", F.lit("a").alias("side"),
                                          F.when(k % 5 != 0, F.col("o_orderdate")).alias("updated"))
    shift = F.make_dt_interval((k % 3).cast("int") - 1)
    b = t.orders.where(k % 4 != 0).select("o_orderkey", F.lit("b").alias("side"), (F.col("o_orderdate") + shift).alias("updated"))
    return J.newest_copy_wins(a, b, "o_orderkey", "updated").select("o_orderkey", "side")
