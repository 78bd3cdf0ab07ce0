"""The cut paths for hot groups must equal the plain windows."""

import math
import random

import pytest
from pyspark.sql import Window, functions as F

from support import same
from loomtab.operators import indicators as I, joins as J, ordered as O, splits as P, windows as W
from loomtab.session import HOT_ROWS


def _skewed(tables):
    """One user holds a third of the rows."""
    hot_user = F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id") % 40 + 2)
    return tables.events.withColumn("user_id", hot_user.cast("long"))


BY, ORDER = ["user_id"], ["ts", "event_id"]


def test_probe_finds_hot_groups(tables, hot):
    keys = {r[0] for r in O.hot_groups(_skewed(tables), BY).collect()}
    sizes = {r[0]: r[1] for r in _skewed(tables).groupBy("user_id").count().collect()}
    assert keys == {k for k, n in sizes.items() if n > 20} and 1 in keys


def test_running_by_group(tables, hot):
    e = _skewed(tables)
    w = Window.partitionBy(*BY).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    aggs = {"s": ("sum", F.col("value")), "lo": ("min", F.col("value")), "hi": ("max", F.col("value"))}
    plain = e.withColumns({"s": F.sum("value").over(w), "lo": F.min("value").over(w), "hi": F.max("value").over(w)})
    same(O.running(e, BY, ORDER, aggs), plain)


def test_running_global_and_reverse(tables, hot):
    e = tables.events.select("event_id", "ts", "value")
    for reverse in (False, True):
        order = [F.col(c).desc() if reverse else F.col(c) for c in ORDER]
        w = Window.partitionBy(F.lit(0)).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        same(O.running(e, [], ORDER, {"s": ("sum", F.col("value"))}, reverse), e.withColumn("s", F.sum("value").over(w)))


def test_row_index_and_null_group(tables, hot):
    e = _skewed(tables).withColumn("user_id", F.when(F.col("user_id") != 1, F.col("user_id")))
    w = Window.partitionBy(*BY).orderBy(*ORDER)
    same(O.row_index(e, BY, ORDER), e.withColumn("idx", F.row_number().over(w).cast("long") - 1))


def test_carry_last(tables, hot):
    e = _skewed(tables).withColumn("v", F.when(F.col("event_id") % 4 == 0, F.col("value")))
    w = Window.partitionBy(*BY).orderBy(*ORDER)
    same(O.carry_last(e, BY, ORDER, {"f": F.col("v")}), e.withColumn("f", F.last("v", True).over(w)))
    back = w.rowsBetween(0, Window.unboundedFollowing)
    same(O.carry_last(e, BY, ORDER, {"f": F.col("v")}, reverse=True), e.withColumn("f", F.first("v", True).over(back)))


def test_framed_with_small_chunks(tables, hot):
    e = _skewed(tables)

    def build(w):
        return {"m": F.avg("value").over(w.rowsBetween(-5, 2)), "p": F.lag("value", 3).over(w), "n": F.lead("value", 2).over(w)}
    plain = e.withColumns(build(Window.partitionBy(*BY).orderBy(*ORDER)))
    same(O.framed(e, BY, ORDER, 5, 2, build, chunk_rows=7), plain)


def test_decayed_mean_equals_recursion(spark, tables):
    bars = I.bars(tables.events, "event_type", "ts", "value", "hour")
    got = I.ema(bars, [10, 3]).select("symbol", "t", "close", "ema_10", "ema_3").toPandas().sort_values(["symbol", "t"])
    for span in (10, 3):
        want = got.groupby("symbol")["close"].transform(lambda s: s.ewm(span=span, adjust=True).mean())
        assert (abs(got[f"ema_{span}"] - want) < 1e-8).all()


def test_decayed_mean_hot(tables, hot, spark):
    bars = I.bars(tables.events, "event_type", "ts", "value", "hour")
    cut = I.macd(bars)
    rows = cut.collect()
    spark.conf.unset(HOT_ROWS)
    same(spark.createDataFrame(rows, cut.schema), I.macd(bars))


def test_quantiles(tables, hot):
    e = _skewed(tables)
    want = e.groupBy("user_id").agg(*[F.expr(f"percentile(value, {p})").alias(f"value_q{i}") for i, p in enumerate((0.01, 0.5, 0.9))])
    same(O.exact_quantiles(e, BY, ["value"], [0.01, 0.5, 0.9]), want)
    same(O.exact_quantiles(e, [], ["value"], [0.25]), e.agg(F.expr("percentile(value, 0.25)").alias("value_q0")))


def test_quantiles_of_large_groups_and_ties(spark):
    df = spark.range(150_000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 5 < 3, F.lit(7.0)).otherwise(F.xxhash64("id") % 1000 / 7).alias("v"),
                                    F.when(F.col("id") % 2 == 0, F.col("id")).alias("w"))
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    want = [F.expr(f"percentile({c}, {p})").alias(f"{c}_q{i}") for c in "vw" for i, p in enumerate(probs)]
    same(O.exact_quantiles(df, ["g"], ["v", "w"], probs), df.groupBy("g").agg(*want))
    same(O.exact_quantiles(df, [], ["v", "w"], probs), df.agg(*want))


def test_parts_are_exact_for_null_and_repeated_keys(spark):
    rows = [(None, i, "a") for i in range(10)] + [(5, 0, "a")] * 30 + [(i, i, "b") for i in range(60)]
    df = spark.createDataFrame(rows, "k long, v int, c string").repartition(4)
    assert P.sample_exact(df, "k", 10, 3).count() == 10 and P.sample_exact(df, "k", 35, 3).count() == 35
    parts = P.hash_parts(df, "k", 1, [lambda n: F.floor(n * 0.1), lambda n: F.floor(n * 0.4)]).groupBy("part").count()
    assert {r[0]: r[1] for r in parts.collect()} == {0: 10, 1: 30, 2: 60}
    split = {(r[0], r[1]): r[2] for r in P.stratified_split(df, "c", "k", 0.25, 2).groupBy("c", "split").count().collect()}
    assert split == {("a", "test"): 10, ("a", "train"): 30, ("b", "test"): 15, ("b", "train"): 45}
    again = P.hash_parts(df.repartition(7), "k", 1, [lambda n: F.floor(n * 0.1)])
    same(again, P.hash_parts(df, "k", 1, [lambda n: F.floor(n * 0.1)]))


def test_empty_quota_takes_nothing(spark, tables, hot):
    assert P.sample_exact(tables.events, "event_id", 0, 1).isEmpty()
    assert P.sample_exact(tables.events, "event_id", 10**9, 1).count() == tables.events.count()


def test_time_split_hot(tables, hot):
    got = P.time_split(tables.events, ORDER, 0.25)
    n = tables.events.count()
    assert got.where("split = 'train'").count() == int(n * 0.75)
    edge = got.groupBy("split").agg(F.min("ts"), F.max("ts")).collect()
    spans = {r[0]: (r[1], r[2]) for r in edge}
    assert spans["train"][1] <= spans["test"][0]


def test_asof_hot(tables, hot, spark):
    e = _skewed(tables)
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = e.where("event_type = 'signup'").select("user_id", "ts", F.col("value").alias("v"))
    got = J.asof_join(left, right, "user_id", "ts", "ts", ["v"], 86_400)
    rows = got.collect()
    spark.conf.unset(HOT_ROWS)
    same(spark.createDataFrame(rows, got.schema), J.asof_join(left, right, "user_id", "ts", "ts", ["v"], 86_400))


def test_asof_hand_case(spark):
    left = spark.createDataFrame([(1, 10), (1, 100), (2, 5), (3, 7)], "k int, s long").select("k", F.timestamp_seconds("s").alias("ts"))
    right = spark.createDataFrame([(1, 10, 1.0), (1, 60, 2.0), (2, 6, 3.0)], "k int, s long, v double").select("k", F.timestamp_seconds("s").alias("ts"), "v")
    got = {(r.k, r.ts.timestamp()): r.v for r in J.asof_join(left, right, "k", "ts", "ts", ["v"], 30).collect()}
    assert got == {(1, 10.0): 1.0, (1, 100.0): None, (2, 5.0): None, (3, 7.0): None}


def test_days_since_flag_hand_case(spark):
    rows = [(1, 1, False), (1, 3, True), (1, 6, False), (2, 2, False), (2, 4, False)]
    df = spark.createDataFrame(rows, "g int, d int, f boolean").withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))
    got = sorted((r.g, r.d, r.after_x, r.before_x) for r in W.days_since_flag(df, ["g"], ["date"], "date", F.col("f"), "x").collect())
    assert got == [(1, 1, 0, -2), (1, 3, 0, 0), (1, 6, 3, 0), (2, 2, 0, -2), (2, 4, 2, 0)]


def test_grouped_map_refuses_hot_groups(tables, hot):
    import pytest

    from loomtab.operators import aggregates as A
    with pytest.raises(ValueError):
        A.grouped_map(_skewed(tables), BY, lambda f: f, "event_id long")


@pytest.mark.parametrize("sketch", [None, 64, 256])
def test_quantiles_by_rounds(spark, monkeypatch, sketch):
    """NULL, NaN, ties, one-row and empty groups; small sketches need several rounds."""
    if sketch:
        for name, value in (("_SKETCH", sketch), ("_HELD", sketch * 9 // 10), ("_BRACKET", 2.296 / sketch ** 0.9021), ("_GRIDS", (8, sketch))):
            monkeypatch.setattr(O, name, value)
    r = random.Random(sketch or 0)
    rows = [(r.choice([None, 0, 0, 0, 0, 1, 2]), None if r.random() < 0.1 else r.gauss(0, 1), r.choice([1.0, 1.0, 1.0, 2.0, 2.5, 7.0]), 4.0) for _ in range(9000)]
    rows += [(7, 1.5, float("nan"), None), (8, None, None, None), (9, 1.0, 2.0, float("inf")), (9, 3.0, -2.0, 0.0)]
    df = spark.createDataFrame(rows, "g int, x double, t double, c double").repartition(5)
    probs = [0.0, 0.01, 0.5, 0.99, 1.0]
    for by in ([], ["g"]):
        got = {tuple(q[b] for b in by): q for q in O.exact_quantiles(df, by, ["x", "t", "c"], probs).collect()}
        groups = {}
        for g, *values in rows:
            groups.setdefault((g,) if by else (), []).append(values)
        assert set(got) == set(groups)
        for key, values in groups.items():
            for i, name in enumerate("xtc"):
                own = sorted(v[i] for v in values if v[i] is not None and v[i] == v[i])
                for j, p in enumerate(probs):
                    at = p * (len(own) - 1)
                    low, high = (own[math.floor(at)], own[math.ceil(at)]) if own else (None, None)
                    want = low if not own or low == high or at == math.floor(at) else low + (high - low) * (at - math.floor(at))
                    assert got[key][f"{name}_q{j}"] == (None if want is None else pytest.approx(want, rel=1e-12)), (key, name, p)
    assert O.exact_quantiles(df.limit(0), [], ["x"], [0.5]).collect()[0][0] is None


def test_quantiles_of_ten_million_equal_values(spark):
    df = spark.range(10_000_000, numPartitions=8).selectExpr("CASE WHEN id % 1000 = 0 THEN id ELSE 5 END AS v")
    plan = O.exact_quantiles(df, [], ["v"], [0.0005, 0.5, 0.99999])
    assert "collect_list" not in plan._jdf.queryExecution().toString()
    low, middle, high = plan.first()
    assert (low, middle) == (5.0, 5.0) and high == pytest.approx(9_899_000.01, rel=1e-9)
