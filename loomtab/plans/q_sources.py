"""Scans and sinks over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtab.plans.registry import R, query, rnd
from loomtab.session import scratch
from loomtab.sources import files as S, lines as L
from loomtab.sources.tables import SCHEMAS

_ORDERS = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
           "CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders")
_EVENTS = "SELECT event_id, user_id, event_type, value, props FROM events"
_EVENTS_SCHEMA = "event_id long, user_id long, event_type string, value double, props string"


def _orders(t):
    return t.orders.withColumn("o_orderdate", F.to_date("o_orderdate"))


def _events(t):
    return t.events.select("event_id", "user_id", "event_type", "value", "props")


@query("csv_scan", _ORDERS)
def _(t):
    path = scratch(t.spark, "csv")
    _orders(t).write.option("header", "true").csv(path)
    return S.csv_scan(t.spark, path, SCHEMAS["orders"].replace("timestamp", "date"))


@query("csv_scan_semicolon_strings", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, "
       "CAST(p_size AS VARCHAR) AS p_size FROM part")
def _(t):
    path = scratch(t.spark, "csv")
    t.part.select("p_partkey", "p_name", "p_size").write.option("sep", ";").csv(path)
    return S.csv_scan_strings(t.spark, path, ["p_partkey", "p_name", "p_size"], sep=";", header=False)


@query("parquet_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(t):
    return S.parquet_scan(t.spark, t.file("lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"])


@query("json_map_scan", """
SELECT event_id, CAST(make_timestamp(epoch_us(date_trunc('milliseconds', ts))) AS DATE) AS date,
       value AS close FROM events""")
def _(t):
    # One {epoch_ms: value} object per event; odd ids carry an ISO time instead.
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    stamp = F.when(F.col("event_id") % 2 == 1, iso).otherwise(F.unix_millis("ts").cast("string"))
    packed = t.events.select("event_id", F.to_json(F.create_map(stamp, F.col("value"))).alias("series"))
    return S.json_map_rows(packed, "event_id", "series")


@query("jsonl_scan_sink", _EVENTS)
def _(t):
    path = scratch(t.spark, "jsonl")
    S.jsonl_sink(_events(t), path)
    return S.jsonl_scan(t.spark, path, _EVENTS_SCHEMA)


@query("jsonl_bad_records", """
SELECT 'bad' AS part, CAST(count(*) FILTER (event_id % 10 = 0) AS BIGINT) AS n FROM events
UNION ALL SELECT 'good', CAST(count(*) FILTER (event_id % 10 <> 0) AS BIGINT) FROM events""")
def _(t):
    path = scratch(t.spark, "lines")
    line = F.to_json(F.struct("event_id", "value"))
    damaged = F.when(F.col("event_id") % 10 == 0, F.expr("substring(to_json(struct(event_id, value)), 1, 9)"))
    t.events.select(F.coalesce(damaged, line).alias("value")).write.text(path)
    good, bad = S.jsonl_split_bad(t.spark, path, "event_id long, value double")
    return (good.agg(F.lit("good").alias("part"), F.count(F.lit(1)).alias("n"))
            .unionByName(bad.agg(F.lit("bad").alias("part"), F.count(F.lit(1)).alias("n"))))


@query("jsonl_compressed", _EVENTS)
def _(t):
    # Zstandard, gzip and plain shards side by side, read as one table.
    path, events = scratch(t.spark, "mixed"), _events(t)
    L.sharded_jsonl(events.where("event_id % 3 = 0"), f"{path}/zst", ["event_id"], 2000, 1 << 17, "zstd")
    S.jsonl_sink(events.where("event_id % 3 = 1"), f"{path}/gz", "gzip")
    S.jsonl_sink(events.where("event_id % 3 = 2"), f"{path}/plain", "none")
    return L.jsonl_any(t.spark, path, _EVENTS_SCHEMA)[0]


@query("sharded_write", "SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS within_limit FROM events")
def _(t):
    path = scratch(t.spark, "shards")
    S.shard_sink(_events(t), path, 700, "parquet")
    sizes = S.per_file_counts(t.spark, path)
    return sizes.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 700).alias("within_limit"))


@query("sharded_write_bytes", """WITH d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n FROM documents)
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(n) AS BIGINT) AS n_bytes, CAST(sum(doc_id * n) AS BIGINT) AS checked, true AS within_limits FROM d""")
def _(t):
    path = scratch(t.spark, "byte-shards")
    L.sharded_jsonl(t.documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), path, ["doc_id"], 400, 1 << 19)
    lines = L.line_scan(t.spark, path).select("file", "value", F.from_json("value", "doc_id long, text string").alias("r"))
    shards = lines.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value") + 1).alias("size"), F.sum(F.octet_length("r.text")).alias("n_bytes"),
                                       F.sum(F.col("r.doc_id") * F.octet_length("r.text")).alias("checked"))
    return shards.agg(F.sum("n").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"), F.sum("checked").alias("checked"),
                      F.bool_and((F.col("n") <= 400) & ((F.col("size") <= 1 << 19) | (F.col("n") == 1))).alias("within_limits"))


@query("batched_iteration", f"SELECT CAST(count(*) AS BIGINT) AS n_rows, {R('sum(l_extendedprice)', 2)} AS total, "
       f"{R('avg(l_extendedprice)')} AS mean FROM lineitem")
def _(t):
    parts = S.batch_sums(t.lineitem, "l_extendedprice")
    return parts.agg(F.sum("rows").alias("n_rows"), rnd(F.sum("total"), 2).alias("total"),
                     rnd(F.sum("total") / F.sum("rows")).alias("mean"))


@query("column_pruned_scan", "SELECT label, CAST(count(*) AS BIGINT) AS n FROM embeddings GROUP BY label")
def _(t):
    return t.embeddings.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("filtered_scan", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 50000")
def _(t):
    return t.lineitem.where("l_extendedprice > 50000").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("random_row_fetch", """
SELECT vec_id, label FROM embeddings
WHERE vec_id IN (SELECT (doc_id * 37 + 11) % (SELECT count(*) FROM documents) FROM documents)""")
def _(t):
    n = t.documents.agg(F.count(F.lit(1))).scalar()
    ids = t.documents.select(((F.col("doc_id") * 37 + 11) % n).alias("vec_id"))
    return S.fetch_rows(t.embeddings, ids, "vec_id", ["vec_id", "label"])


@query("shuffled_epoch", "SELECT label, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT vec_id) AS BIGINT) AS n_ids "
       "FROM embeddings GROUP BY label")
def _(t):
    path = scratch(t.spark, "epoch")
    S.shard_sink(S.seeded_shuffle(t.embeddings.select("vec_id", "label"), "vec_id", 7), path, 1000, "parquet")
    return (t.spark.read.schema("vec_id long, label int").parquet(path).groupBy("label")
            .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("vec_id").alias("n_ids")))


@query("chunked_append", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events")
def _(t):
    path = scratch(t.spark, "append")
    chunk = F.pmod(F.xxhash64("event_type"), F.lit(4))  # every type, NULL too, is in one of the chunks
    S.append_chunks((t.events.where(chunk == k) for k in range(4)), path)
    return t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


@query("per_fragment_scan", "SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem")
def _(t):
    return S.per_file_counts(t.spark, t.file("lineitem")).agg(F.sum("n").alias("n"))


@query("jdbc_scan", "SELECT * FROM orders WHERE o_totalprice BETWEEN 1000.0 AND 90000.0 ORDER BY o_orderkey LIMIT 100")
def _(t):
    # No JDBC driver ships here: the same statement runs over a file-backed view.
    t.orders.createOrReplaceTempView("loomtab_orders")
    return S.bounded_select(t.spark, "loomtab_orders", "o_totalprice", 1000.0, 90000.0, 100, "o_orderkey")


@query("sql_param_query", "SELECT event_id, event_type, value FROM events WHERE event_type = 'click' AND value >= 25.0")
def _(t):
    return S.sql_query(t.spark, "SELECT event_id, event_type, value FROM {ev} WHERE event_type = :kind "
                                "AND value >= :least", {"kind": "click", "least": 25.0},
                       "event_id long, event_type string, value double", ev=t.events)


@query("sql_param_positional", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 50000")
def _(t):
    return S.sql_query(t.spark, "SELECT o_orderkey, o_orderstatus FROM {o} WHERE o_orderstatus = ? "
                                "AND o_totalprice > ?", ["F", 50000], o=t.orders)


@query("sql_over_dataframe", f"SELECT {R('sum(l_quantity)', 2)} AS total FROM lineitem")
def _(t):
    frame = t.lineitem.select(F.col("l_quantity").alias("a"))
    return S.sql_query(t.spark, "SELECT sum(a) AS total FROM {mydf}", mydf=frame).select(rnd("total", 2).alias("total"))


@query("external_table_write", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(t):
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    path = scratch(t.spark, "external")
    return S.external_table(rows, f"loomtab_{path[-12:]}", path)


@query("batch_insert", "SELECT r_regionkey, r_name FROM region UNION ALL SELECT r_regionkey, r_name FROM region")
def _(t):
    path = scratch(t.spark, "staging")
    rows = t.region.collect()  # five rows by definition of the table
    columns = {"r_regionkey": [r[0] for r in rows], "r_name": [r[1] for r in rows]}
    for _i in range(2):
        S.batch_insert(t.spark, columns, SCHEMAS["region"], path)
    return t.spark.read.schema(SCHEMAS["region"]).parquet(path)


def _class_folders(t, name):
    path = scratch(t.spark, name)
    site = F.regexp_extract("url", r"/(en|de|fr|es)/", 1)
    t.pages.select(site.alias("class"), F.translate("html", "\n\r", "  ").alias("value")) \
        .write.partitionBy("class").option("maxRecordsPerFile", 100).text(path)
    return path


@query("binary_file_source", """
SELECT 'class=' || coalesce(nullif(regexp_extract(url, '/(en|de|fr|es)/', 1), ''), '__HIVE_DEFAULT_PARTITION__') AS class,
       CAST(sum(octet_length(encode(translate(html, chr(10) || chr(13), '  '))) + 1) AS BIGINT) AS total_bytes
FROM pages GROUP BY 1""")
def _(t):
    found = S.binary_files(t.spark, _class_folders(t, "binary"), "*.txt")
    return found.groupBy("class").agg(F.sum("length").alias("total_bytes"))


@query("text_file_source", """
SELECT lang, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(length(replace(text, chr(10), ' '))) AS BIGINT) AS n_chars
FROM documents GROUP BY lang""")
def _(t):
    path = scratch(t.spark, "texts")
    L.text_tree_sink(t.documents.select("lang", F.replace("text", F.lit("\n"), F.lit(" ")).alias("value")), path, "lang", "value", 50)
    docs = S.text_files(t.spark, path, glob="*.txt")
    n_lines = F.size(F.split("value", "\n")) - 1
    return (docs.select(F.regexp_extract("path", "lang=([a-z]+)", 1).alias("lang"), "value").groupBy("lang")
            .agg(F.sum(n_lines).cast("long").alias("n_lines"),
                 F.sum(F.length("value") - n_lines).cast("long").alias("n_chars")))


@query("series_text_parse", f"""
SELECT CAST(label AS VARCHAR) AS label, CAST(count(*) AS BIGINT) AS n,
       {R('sum(round(CAST(embedding[1] AS DOUBLE), 6))', 3)} AS t0_sum,
       {R('sum(round(CAST(embedding[64] AS DOUBLE), 6))', 3)} AS t63_sum FROM embeddings GROUP BY label""")
def _(t):
    path = scratch(t.spark, "series")
    numbers = F.array_join(F.transform("embedding", lambda v: F.round(v.cast("double"), 6).cast("string")), ",")
    t.embeddings.select(F.concat(numbers, F.lit(":"), F.col("label").cast("string")).alias("value")).write.text(path)
    wide = S.widen_series(S.parse_series_lines(t.spark.read.text(path)), 64)
    return wide.groupBy("label").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("t0"), 3).alias("t0_sum"),
                                     rnd(F.sum("t63"), 3).alias("t63_sum"))


@query("fixed_width_parse", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS country,
       round(c_acctbal / 1000, 3) AS lat FROM customer WHERE c_custkey % 7 <> 0""")
def _(t):
    # Lines of every seventh customer carry no number and are dropped by the parser.
    path = scratch(t.spark, "fixed")
    c = t.customer
    lat = F.when(F.col("c_custkey") % 7 == 0, F.lit("n/a")).otherwise(
        F.round(F.col("c_acctbal") / 1000, 3).cast("string"))
    c.select(F.concat(F.rpad(F.col("c_custkey").cast("string"), 13, " "), F.rpad("c_name", 30, " "),
                      F.rpad(F.col("c_nationkey").cast("string"), 14, " "), F.rpad(lat, 9, " ")).alias("value")) \
        .write.text(path)
    return S.parse_fixed_width(t.spark.read.text(path), {
        "id": (0, 12, "string"), "name": (13, 43, "string"), "country": (43, 46, "string"), "lat": (57, 65, "double")})


@query("fasta_parse", """
SELECT 'doc' || CAST(doc_id AS VARCHAR) AS record_id, CAST(length(md5(text)) AS BIGINT) AS len,
       md5(text) AS sequence FROM documents""")
def _(t):
    path = scratch(t.spark, "fasta")
    digest = F.md5("text")
    t.documents.select(F.concat(F.lit(">doc"), F.col("doc_id").cast("string"), F.lit("\n"),
                                F.substring(digest, 1, 20), F.lit("\n"), F.substring(digest, 21, 12)).alias("value")) \
        .write.text(path)
    return (S.fasta_scan(t.spark, path)
            .select("record_id", F.length("sequence").cast("long").alias("len"), "sequence"))


@query("manifest_join", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem "
       "WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '1%')")
def _(t):
    kept = t.orders.where(F.col("o_orderpriority").startswith("1"))
    return (t.lineitem.join(kept, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
            .select("l_orderkey", "l_linenumber", "l_quantity"))


@query("content_hash", "SELECT doc_id, sha256(text) AS sha FROM documents")
def _(t):
    return t.documents.select("doc_id", S.sha256("text").alias("sha"))


@query("content_hash_frame")
def _(t):
    return S.content_hash(t.orders)


@query("partitioned_artifact", f"""
SELECT event_type, CAST(count(*) AS BIGINT) AS n, {R('sum(value)')} AS total FROM events
WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06' GROUP BY event_type""")
def _(t):
    path = scratch(t.spark, "artifact")
    S.partitioned_sink(t.events.withColumn("day", F.to_date("ts")), path, ["event_type", "day"])
    table = t.spark.read.parquet(path)
    day = table.where((F.col("event_type") == "click") & (F.col("day") == F.lit("2024-01-05").cast("date")))
    return day.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("value")).alias("total"))
