"""Python function surface over the given tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from loomtab.operators import aggregates as A, udfs as U
from loomtab.plans.registry import R, query, rnd


@query("scalar_udf", f"SELECT event_id, {R('value * 2 + 1')} AS v FROM events")
def _(t):
    return t.events.select("event_id", rnd(U.series_udf(lambda s: s * 2 + 1, "double")("value")).alias("v"))


def _errors_so_far(frames):
    """Running count per user over sorted batches; the last user's count goes on in the next batch."""
    user, count = None, 0
    for f in frames:
        if not len(f):
            continue
        run = (f["event_type"] == "error").astype("int64").groupby(f["user_id"], sort=False, dropna=False).cumsum()
        run += (f["user_id"] == user).astype("int64") * count
        yield pd.DataFrame({"event_id": f["event_id"], "errors": run})
        user, count = f["user_id"].iloc[-1], int(run.iloc[-1])


@query("partition_function", """SELECT event_id, CAST(count(*) FILTER (event_type = 'error') OVER
 (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS errors FROM events""")
def _(t):
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    return U.sorted_partition_map(rows, ["user_id"], ["ts", "event_id"], _errors_so_far, "event_id long, errors long")


def _per_unit(x, scale):
    if x == 0:
        raise ZeroDivisionError("empty item")
    return scale / x


@query("map_over_items", f"SELECT p_partkey, {R('CASE WHEN p_size % 10 <> 0 THEN 100.0 / (p_size % 10) END', 6)} AS result, CASE WHEN p_size % 10 = 0 THEN 'ZeroDivisionError: empty item' END AS error FROM part")
def _(t):
    items = t.part.select("p_partkey", (F.col("p_size") % 10).alias("item"))
    out = U.map_items(items, "p_partkey", "item", _per_unit, "double", scale=100.0)
    return out.select("p_partkey", rnd("result", 6).alias("result"), "error")


class _Doubling:
    def submit(self, item):
        return item

    def wait(self, handle):
        if handle % 10 == 7:
            raise RuntimeError("failed")
        return 2 * handle


@query("submit_poll_batch", "SELECT CAST(event_id // 1000 AS BIGINT) AS batch, event_id, CAST(CASE WHEN event_id % 10 = 7 THEN -1 ELSE 2 * event_id END AS BIGINT) AS result, CASE WHEN event_id % 10 = 7 THEN 'failed' END AS error FROM events")
def _(t):
    return U.submit_and_wait(t.events.select("event_id"), "event_id", 1000, _Doubling)


@query("submit_poll_totals", "SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (event_id % 10 <> 7) AS BIGINT) AS succeeded, CAST(count(*) FILTER (event_id % 10 = 7) AS BIGINT) AS failed FROM events")
def _(t):
    return U.batch_totals(U.submit_and_wait(t.events.select("event_id"), "event_id", 1000, _Doubling))


def _spread(f: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"user_id": [f["user_id"].iloc[0]], "spread": [float(f["value"].max() - f["value"].min())]})


@query("grouped_map", f"SELECT user_id, {R('max(value) - min(value)')} AS spread FROM events GROUP BY 1")
def _(t):
    rows = t.events.select("user_id", "value")
    return A.grouped_map(rows, ["user_id"], _spread, "user_id long, spread double").withColumn("spread", rnd("spread"))


@query("table_function", "SELECT doc_id, CAST(i // 200 AS INTEGER) AS pos, substring(text, CAST(i + 1 AS BIGINT), 250) AS chunk FROM (SELECT doc_id, text, unnest(range(0, length(text), 200)) AS i FROM documents)")
def _(t):
    chunks = U.chunk_function(250, 50)
    return t.documents.lateralJoin(chunks(F.col("text").outer())).select("doc_id", "pos", "chunk")


@query("composed_step", f"""SELECT o_orderkey, c_name, n_name, {R('o_totalprice * 1.1')} AS amount FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F'""")
def _(t):
    return (t.orders.where("o_orderstatus = 'F'").withColumn("amount", rnd(F.col("o_totalprice") * 1.1))
            .join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("o_orderkey", "c_name", "n_name", "amount"))
