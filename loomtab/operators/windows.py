"""Ordered features per group, built on the hot-safe primitives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomtab.operators.joins import with_group_stats
from loomtab.operators.ordered import attach, carry_last, framed, running


def rolling_stats(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], windows: Sequence[int]) -> DataFrame:
    """Mean, std (0 where undefined), min and max of the last ``w`` rows, this one included."""
    def build(w):
        out = {}
        for n in windows:
            f = w.rowsBetween(-(n - 1), 0)
            for c in cols:
                out[f"{c}_mean_{n}"] = F.avg(c).over(f)
                out[f"{c}_std_{n}"] = F.coalesce(F.stddev_samp(c).over(f), F.lit(0.0))
                out[f"{c}_min_{n}"] = F.min(c).over(f)
                out[f"{c}_max_{n}"] = F.max(c).over(f)
        return out
    return framed(df, by, order, max(windows) - 1, 0, build)


def lag_features(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], lags: Sequence[int]) -> DataFrame:
    return framed(df, by, order, max(lags), 0, lambda w: {f"{c}_lag_{n}": F.lag(c, n).over(w) for c in cols for n in lags})


def forward_fill(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], rest=0) -> DataFrame:
    """Last value inside the group, ``rest`` before the first one.

    Values never leak from one group into the next.
    """
    names = {f"_f_{c}": F.col(c) for c in cols}
    out = carry_last(df, by, order, names)
    return out.withColumns({c: F.coalesce(f"_f_{c}", F.lit(rest)) for c in cols}).drop(*names)


def fill_both_ways(df: DataFrame, by: Sequence[str], order: Sequence[str], col: str) -> DataFrame:
    """Forward, then backward in time, then the column mean."""
    mean = df.agg(F.avg(col)).scalar()
    out = carry_last(df, by, order, {"_fwd": F.col(col)})
    out = carry_last(out, by, order, {"_bwd": F.col(col)}, reverse=True)
    return out.withColumn(col, F.coalesce("_fwd", "_bwd", mean)).drop("_fwd", "_bwd")


def days_since_flag(df: DataFrame, by: Sequence[str], order: Sequence[str], date: str, flag: Column, name: str) -> DataFrame:
    """``after_*``: days since the last flagged date, counted from the first row before any
    flag; ``before_*``: the same looking ahead, so at most 0."""
    mark = F.when(flag, F.col(date))
    out = running(df, by, order, {"_hit": ("max", mark), "_first": ("min", F.col(date))})
    out = out.withColumn(f"after_{name}", F.datediff(date, F.coalesce("_hit", "_first"))).drop("_hit", "_first")
    out = running(out, by, order, {"_hit": ("min", mark), "_last": ("max", F.col(date))}, reverse=True)
    return out.withColumn(f"before_{name}", F.datediff(date, F.coalesce("_hit", "_last"))).drop("_hit", "_last")


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """First ``k`` rows per group, also where one group holds most rows.

    For a small ``k`` the engine applies the rank filter before the shuffle too
    (group limit). Beyond its threshold the rows are first ranked per input
    partition, so a task never sorts a whole hot group.
    """
    def ranked(frame, keys):
        w = Window.partitionBy(*keys).orderBy(*order)
        return frame.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")

    if k > 1000:
        df = ranked(df.withColumn("_part", F.spark_partition_id()), [*by, "_part"]).drop("_part")
    return ranked(df, by)


def even_share(df: DataFrame, by: str, total: int) -> int:
    """``total // number of groups``; an error when that is zero."""
    groups = df.agg(F.countDistinct(by)).first()[0]
    if total < groups:
        raise ValueError(f"limit {total} is below the number of groups {groups}")
    return total // max(groups, 1)


def zscore(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / sample std; unchanged where the std is 0."""
    stats = df.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    s = F.col("_s")
    scaled = {c: F.when(s[f"s_{c}"] > 0, (F.col(c) - s[f"m_{c}"]) / s[f"s_{c}"]).otherwise(F.col(c)) for c in cols}
    return attach(df, stats).withColumns(scaled).drop("_s")


def group_normalized(df: DataFrame, by: Sequence[str], col: str, name: str = "score") -> DataFrame:
    """(x - group mean) / (population std + 1e-4)."""
    out = with_group_stats(df, by, F.avg(col).alias("_m"), F.stddev_pop(col).alias("_s"))
    return out.withColumn(name, (F.col(col) - F.col("_m")) / (F.col("_s") + 1e-4)).drop("_m", "_s")


def time_bucket_trend(df: DataFrame, ts: str, cols: Sequence[str], every: str, keep: int = 60) -> DataFrame:
    """Mean, sum and count per bucket (D, h, 6h, W), empty buckets present, the last ``keep`` buckets."""
    step = {"D": "1 day", "h": "1 hour", "6h": "6 hours", "W": "7 days"}[every]
    shift = "4 days" if every == "W" else "0 seconds"  # weeks start on Monday
    bucket = F.window(ts, step, startTime=shift).start
    agg = df.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{c}_{n}") for c in cols for n, f in (("mean", F.avg), ("sum", F.sum))])
    span = agg.agg(F.explode(F.sequence(F.min("bucket"), F.max("bucket"), F.expr(f"interval {step}"))).alias("bucket"))
    full = span.join(agg, "bucket", "left").fillna(0, subset=["n", *[f"{c}_sum" for c in cols]])
    return full.orderBy(F.desc("bucket")).limit(keep)


def ecdf(df: DataFrame, col: str, name: str = "ecdf") -> DataFrame:
    """Share of rows at or below each value, from counts per distinct value."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    upto = running(counts, [], [col], {"_upto": ("sum", F.col("_n"))})
    total = counts.agg(F.sum("_n")).scalar()
    return df.join(upto.select(col, (F.col("_upto") / total).alias(name)), col)


def top_two_margin(probabilities: str) -> Column:
    ranked = F.sort_array(probabilities, asc=False)
    return F.get(ranked, F.lit(0)) - F.get(ranked, F.lit(1))


def version_chain(log: DataFrame, path: str, order: Sequence[str], content: str) -> DataFrame:
    """Write log with the hash before and after each write."""
    return framed(log.withColumn("new_sha", F.sha2(content, 256)), [path], order, 1, 0,
                  lambda w: {"old_sha": F.lag("new_sha").over(w)})


def lookback_values(series: DataFrame, date: str, value: str, as_of: str, days: int) -> DataFrame:
    """Every calendar day of the lookback, newest first; days without a row say so."""
    spark = series.sparkSession
    cal = spark.range(days + 1).select(F.date_sub(F.lit(as_of).cast("date"), F.col("id").cast("int")).alias(date))
    text = F.coalesce(F.col(value).cast("string"), F.lit("N/A: not a trading day"))
    return cal.join(series, date, "left").select(date, text.alias(value)).orderBy(F.desc(date))
