"""Projections, filters and row expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtab.functions import expr as X
from loomtab.operators import shape
from loomtab.plans.registry import R, query, rnd


@query("filter_project", f"SELECT c_custkey, c_name, {R('c_acctbal / (c_nationkey + 1)')} AS ratio FROM customer "
       "WHERE c_acctbal > 6000 ORDER BY ratio DESC, c_custkey")
def _(t):
    return (t.customer.where("c_acctbal > 6000")
            .select("c_custkey", "c_name", rnd(F.col("c_acctbal") / (F.col("c_nationkey") + 1)).alias("ratio"))
            .orderBy(F.desc("ratio"), "c_custkey"))


@query("bool_from_string", "SELECT l_orderkey, l_linenumber, CAST(l_discount > 0 AS INTEGER)::VARCHAR <> '0' AS discounted FROM lineitem")
def _(t):
    text = (F.col("l_discount") > 0).cast("int").cast("string")
    return t.lineitem.select("l_orderkey", "l_linenumber", X.flag_from_string(text).alias("discounted"))


@query("default_when_null", "SELECT p_partkey, coalesce(TRY_CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER), 1900) AS brand_no, "
       "CASE WHEN p_size > 40 THEN 1900 ELSE p_size END AS size_or FROM part")
def _(t):
    digits = F.nullif(F.regexp_extract("p_brand", r"(\d+)$", 1), F.lit(""))
    gone = F.when(F.col("p_size") <= 40, F.col("p_size"))
    return t.part.select("p_partkey", X.default_when_null(digits, "int", 1900).alias("brand_no"),
                         X.default_when_null(gone, "int", 1900).alias("size_or"))


@query("expand_date", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, "
       "CAST(week(o_orderdate) AS INTEGER) AS week, CAST(day(o_orderdate) AS INTEGER) AS day FROM orders")
def _(t):
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in X.date_parts("o_orderdate").items()])


@query("hour_dow", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS dow FROM events")
def _(t):
    return t.events.select("event_id", *[c.alias(n) for n, c in X.hour_and_weekday("ts").items()])


@query("date_from_parts", """
SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 15) AS mid_month,
       CAST(make_date(year(o_orderdate), 1, 1) + CAST((week(o_orderdate) - 1) * 7 AS INTEGER) AS DATE) AS week_start FROM orders""")
def _(t):
    p = X.date_parts("o_orderdate")
    return t.orders.select("o_orderkey", X.mid_month(p["year"], p["month"]).alias("mid_month"),
                           X.week_start(p["year"], p["week"]).alias("week_start"))


@query("clamped_elapsed", """
SELECT o_orderkey, l_linenumber, d720 AS open_days, CAST(trunc(d720 / 30.0) AS INTEGER) AS open_months,
       d175 AS promo_days, CAST(trunc(d175 / 7.0) AS INTEGER) AS promo_weeks
FROM (SELECT o_orderkey, l_linenumber, CAST(greatest(0, least(720, gap * 8 - 100)) AS INTEGER) AS d720,
             CAST(greatest(0, least(175, gap * 8 - 100)) AS INTEGER) AS d175
      FROM (SELECT o_orderkey, l_linenumber, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS gap
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey))""")
def _(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    gap = F.datediff("l_shipdate", "o_orderdate")
    j = j.withColumn("_end", F.date_add(F.to_date("o_orderdate"), gap * 8 - 100))
    d720, months = X.clamped_elapsed("_end", "o_orderdate", 720, 30, F.year("o_orderdate"))
    d175, weeks = X.clamped_elapsed("_end", "o_orderdate", 175, 7, F.year("o_orderdate"))
    return j.select("o_orderkey", "l_linenumber", d720.alias("open_days"), months.alias("open_months"),
                    d175.alias("promo_days"), weeks.alias("promo_weeks"))


@query("age_years", """
SELECT o_orderkey, CAST(floor(date_diff('day', CAST(o_orderdate AS DATE),
       (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) / 365.25) AS INTEGER) AS age FROM orders""")
def _(t):
    newest = t.orders.agg(F.to_date(F.max("o_orderdate"))).scalar()
    return t.orders.select("o_orderkey", X.age_years(newest, F.to_date("o_orderdate")).alias("age"))


@query("log_transform", f"SELECT o_orderkey, {R('ln(1 + o_totalprice)', 6)} AS log1p_price, {R('ln(o_totalprice)', 6)} AS log_price, "
       f"{R('exp(ln(o_totalprice))', 2)} AS back FROM orders")
def _(t):
    p = F.col("o_totalprice")
    return t.orders.select("o_orderkey", rnd(F.log1p(p), 6).alias("log1p_price"), rnd(F.ln(p), 6).alias("log_price"),
                           rnd(F.exp(F.ln(p)), 2).alias("back"))


_LAT = "CAST(user_id % 60 AS DOUBLE) - 30 + value / 100"
_LON = "CAST(event_id % 170 AS DOUBLE) - 85"


def _place(t):
    return t.events.withColumns({
        "lat": (F.col("user_id") % 60).cast("double") - 30 + F.col("value") / 100,
        "lon": (F.col("event_id") % 170).cast("double") - 85})


@query("haversine_miles", f"""
SELECT event_id, {R('''2 * 3959.0 * asin(sqrt(pow(sin((radians(10.0) - radians(lat)) / 2), 2)
       + cos(radians(lat)) * cos(radians(10.0)) * pow(sin((radians(20.0) - radians(lon)) / 2), 2)))''', 3)} AS miles
FROM (SELECT event_id, {_LAT} AS lat, {_LON} AS lon FROM events)""")
def _(t):
    return _place(t).select("event_id", rnd(X.haversine_miles("lat", "lon", F.lit(10.0), F.lit(20.0)), 3).alias("miles"))


@query("safe_ratio", f"""
WITH s AS (SELECT user_id, avg(value) AS m, coalesce(stddev_samp(value), 0) AS sd FROM events GROUP BY user_id)
SELECT event_id, {R('(value - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END', 5)} AS z,
       {R('value / CASE WHEN m = 0 THEN 1 ELSE m END', 5)} AS ratio,
       {R('100.0 * value / nullif(event_id % 3, 0)')} AS pct
FROM events JOIN s USING (user_id)""")
def _(t):
    s = t.events.groupBy("user_id").agg(F.avg("value").alias("m"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("sd"))
    z, ratio = X.z_and_ratio("value", "m", "sd")
    return t.events.join(s, "user_id").select("event_id", rnd(z, 5).alias("z"), rnd(ratio, 5).alias("ratio"),
                                              rnd(X.percent_of("value", F.col("event_id") % 3)).alias("pct"))


@query("regex_extract", """
SELECT p_partkey, regexp_extract(p_name || ' - ' || p_type, '(.*?) -', 1) AS head,
       CASE WHEN p_brand = 'Brand#11' THEN 'HB,NI' ELSE regexp_extract(p_brand, 'Brand#(.*)', 1) END AS code FROM part""")
def _(t):
    return t.part.select("p_partkey", F.regexp_extract(F.concat_ws(" - ", "p_name", "p_type"), "(.*?) -", 1).alias("head"),
                         F.when(F.col("p_brand") == "Brand#11", "HB,NI")
                         .otherwise(F.regexp_extract("p_brand", "Brand#(.*)", 1)).alias("code"))


@query("value_map", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END AS status,
       CASE WHEN year(o_orderdate) <= 1996 THEN 'old' ELSE 'new' END AS era,
       o_orderpriority IN ('1-URGENT', '2-HIGH') AS pressing FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", X.value_map("o_orderstatus", {"F": "filled", "O": "open"}).alias("status"),
                           F.when(F.year("o_orderdate") <= 1996, "old").otherwise("new").alias("era"),
                           F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("pressing"))


@query("date_range_filter", "SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-05-31'")
def _(t):
    return t.orders.where(F.col("o_orderdate").between(F.lit("1996-03-01").cast("timestamp"),
                                                       F.lit("1996-05-31").cast("timestamp"))).select("o_orderkey")


@query("lookback_filter", "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 7 DAYS")
def _(t):
    return t.events.where(X.since("ts", "2024-01-30 12:00:00", 7)).select("event_id", "event_type")


@query("oldest_month_slice", """
WITH b AS (SELECT min(o_orderdate) - to_days(CAST(day(min(o_orderdate)) - 1 AS INTEGER)) AS s FROM orders)
SELECT o_orderkey, o_totalprice FROM orders, b WHERE o_orderdate BETWEEN s AND s + INTERVAL 1 MONTH - INTERVAL 1 DAY""")
def _(t):
    return shape.oldest_month(t.orders, "o_orderdate").select("o_orderkey", "o_totalprice")


@query("term_match", "SELECT doc_id FROM documents WHERE regexp_matches(text, 'tion the|een', 'i') OR regexp_matches(source, 'tion the|een|src1$', 'i') "
       "OR regexp_matches(text, 'src1$', 'i')")
def _(t):
    found = X.term_match(["text", "source"], "tion the OR een") | F.col("source").rlike("(?i)src1$") | F.col("text").rlike("(?i)src1$")
    return t.documents.where(found).select("doc_id")


@query("bbox_filter", f"SELECT event_id FROM (SELECT event_id, {_LAT} AS lat, {_LON} AS lon FROM events) "
       "WHERE lat BETWEEN -28 AND 15 AND lon BETWEEN -60 AND 60")
def _(t):
    return _place(t).where(X.in_box("lat", "lon", -28, 15, -60, 60)).select("event_id")


@query("unit_scale_coerce", f"SELECT event_id, {R('TRY_CAST(CASE WHEN event_id % 9 = 0 THEN event_type ELSE CAST(value AS VARCHAR) END AS DOUBLE) / 10', 6)} AS v FROM events")
def _(t):
    text = F.when(F.col("event_id") % 9 == 0, F.col("event_type")).otherwise(F.col("value").cast("string"))
    return t.events.select("event_id", rnd(X.scaled_number(text), 6).alias("v"))


@query("currency_parse", "SELECT p_partkey, CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_retailprice END AS price FROM part")
def _(t):
    text = F.when(F.col("p_size") % 11 == 0, "on request").otherwise(
        F.concat(F.lit("$"), F.format_number("p_retailprice", 2)))
    return t.part.select("p_partkey", X.currency(text).alias("price"))


@query("column_rename_sanitize", "SELECT r_regionkey AS region_key, r_name AS region_name FROM region")
def _(t):
    odd = t.region.toDF("region key", "region-name")
    return odd.toDF(*X.sanitized_names(odd.columns))


@query("drop_all_null_columns", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(t):
    df = t.customer.select("c_custkey", "c_name", "c_acctbal", F.lit(None).cast("string").alias("empty"),
                           F.when(F.col("c_custkey") < 0, F.lit(1)).alias("never"))
    return shape.drop_all_null_columns(df)


@query("replace_token_null", "SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS price FROM orders WHERE o_orderkey % 5 <> 0")
def _(t):
    text = F.when(F.col("o_orderkey") % 5 == 0, "?").otherwise(F.col("o_totalprice").cast("string"))
    return (t.orders.select("o_orderkey", "o_orderstatus", X.token_to_null(text).cast("double").alias("price"))
            .dropna(subset=["price"]))


@query("binarize_target", "SELECT event_id, CAST(event_id % 5 > 0 AS INTEGER) AS target FROM events")
def _(t):
    return t.events.select("event_id", X.binarize(F.col("event_id") % 5).alias("target"))


_FUNNEL = """(CASE WHEN l_quantity BETWEEN 5 AND 30 THEN 1 + greatest(0, 0.5 * (1 - abs(l_quantity - 17.5) / 12.5)) ELSE 0 END
  + CASE WHEN l_extendedprice BETWEEN 1000 AND 40000 THEN 1 + greatest(0, 0.5 * (1 - abs(l_extendedprice - 20500) / 19500)) ELSE 0 END
  + 2 * l_discount + CAST(l_tax <= 0.05 AS INTEGER)) / 5"""


@query("case_funnel_flags", f"SELECT l_orderkey, l_linenumber, l_quantity BETWEEN 5 AND 30 AS l_quantity_ok, "
       f"l_extendedprice BETWEEN 1000 AND 40000 AS l_extendedprice_ok, "
       f"(l_quantity BETWEEN 5 AND 30) AND (l_extendedprice BETWEEN 1000 AND 40000) AS all_met, {R(_FUNNEL, 6)} AS score FROM lineitem")
def _(t):
    cols = X.profile_score({"l_quantity": (5, 30), "l_extendedprice": (1000, 40000)}, "l_discount", F.col("l_tax") <= 0.05)
    cols["score"] = rnd(cols["score"], 6)
    return t.lineitem.select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in cols.items()])


@query("rule_reward", f"""
WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN text || ' #### ' || CAST(turn AS VARCHAR) ELSE text || ' 7' END AS t FROM conversations)
SELECT conv_id, turn, {R('''CASE WHEN contains(t, '####') THEN 0.2 ELSE 0.0 END + CASE WHEN
  coalesce(CASE WHEN contains(t, '####') THEN nullif(regexp_extract(split_part(t, '####', -1), '-?[0-9]+'), '') END,
           list_extract(regexp_extract_all(t, '-?[0-9]+'), -1)) = CAST(conv_id % 4 AS VARCHAR) THEN 1.0 ELSE 0.0 END''')} AS reward FROM c""")
def _(t):
    text = F.when(F.col("turn") % 2 == 0, F.concat("text", F.lit(" #### "), F.col("turn").cast("string"))) \
        .otherwise(F.concat("text", F.lit(" 7")))
    return t.conversations.select("conv_id", "turn", rnd(X.marker_reward(text, F.col("conv_id") % 4)).alias("reward"))


@query("extreme_event_flag", """
SELECT event_id, CASE WHEN value > 33 AND 960 + event_id % 40 < 980 THEN least(5, CAST(floor((value - 33) / 10) AS INTEGER) + 1) ELSE 0 END AS category FROM events""")
def _(t):
    return t.events.select("event_id", X.storm_category("value", 960 + F.col("event_id") % 40).alias("category"))


@query("url_parts", r"""
SELECT page_id, left(regexp_replace(regexp_replace(regexp_extract(url, '^[a-z]+://([^?#]*)', 1), '[^a-zA-Z0-9]+', '_', 'g'), '^_|_$', '', 'g'), 80) AS slug FROM pages""")
def _(t):
    return t.pages.select("page_id", X.url_slug("url").alias("slug"))
