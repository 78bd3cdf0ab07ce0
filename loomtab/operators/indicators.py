"""Price indicators per symbol over bars (symbol, t, open/high/low/close, volume)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loomtab.operators.ordered import decayed_mean, framed, row_index


def bars(df: DataFrame, symbol: str, ts: str, value: str, unit: str) -> DataFrame:
    """High, low, close and volume per symbol and time unit."""
    return df.groupBy(F.col(symbol).alias("symbol"), F.date_trunc(unit, ts).alias("t")).agg(
        F.max(value).alias("high"), F.min(value).alias("low"), F.max_by(value, ts).alias("close"),
        F.count(F.lit(1)).alias("volume"))


KEY, ORDER = ["symbol"], ["t"]
AT = "_at"


def numbered(df: DataFrame) -> DataFrame:
    """Bars with their place in their symbol: a chain of indicators numbers them once."""
    return row_index(df, KEY, ORDER, AT)


def sma(df: DataFrame, windows: Sequence[int]) -> DataFrame:
    return framed(df, KEY, ORDER, max(windows), 0,
                  lambda w: {f"sma_{n}": F.avg("close").over(w.rowsBetween(-(n - 1), 0)) for n in windows})


def ema(df: DataFrame, spans: Sequence[int], col: str = "close") -> DataFrame:
    return decayed_mean(df, KEY, ORDER, {f"ema_{n}": (F.col(col), 2.0 / (n + 1)) for n in spans})


def macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    out = decayed_mean(numbered(df), KEY, ORDER, {f"ema_{n}": (F.col("close"), 2.0 / (n + 1)) for n in (fast, slow)}, AT)
    out = out.withColumn("macd", F.col(f"ema_{fast}") - F.col(f"ema_{slow}")).drop(f"ema_{fast}", f"ema_{slow}")
    out = decayed_mean(out, KEY, ORDER, {"macd_signal": (F.col("macd"), 2.0 / (signal + 1))}, AT)
    return out.withColumn("macd_hist", F.col("macd") - F.col("macd_signal")).drop(AT)


def rsi(df: DataFrame, n: int = 14) -> DataFrame:
    """0 to 100; the first bar counts as no change."""
    out = framed(numbered(df), KEY, ORDER, 1, 0, lambda w: {"_d": F.coalesce(F.col("close") - F.lag("close").over(w), F.lit(0.0))}, index=AT)
    out = decayed_mean(out, KEY, ORDER, {"_up": (F.greatest("_d", F.lit(0.0)), 1.0 / n),
                                         "_down": (F.greatest(-F.col("_d"), F.lit(0.0)), 1.0 / n)}, AT)
    both = F.col("_up") + F.col("_down")
    return out.withColumn("rsi", F.when(both > 0, 100 * F.col("_up") / both)).drop("_d", "_up", "_down", AT)


def bollinger(df: DataFrame, n: int = 20, width: float = 2.0) -> DataFrame:
    def build(w):
        f = w.rowsBetween(-(n - 1), 0)
        mid, std = F.avg("close").over(f), F.stddev_samp("close").over(f)
        return {"boll": mid, "boll_ub": mid + width * std, "boll_lb": mid - width * std}
    return framed(df, KEY, ORDER, n, 0, build)


def true_range(high: Column, low: Column, prior: Column) -> Column:
    return F.greatest(high - low, F.abs(high - prior), F.abs(low - prior))


def atr(df: DataFrame, n: int = 14) -> DataFrame:
    out = framed(numbered(df), KEY, ORDER, 1, 0,
                 lambda w: {"tr": true_range(F.col("high"), F.col("low"), F.lag("close").over(w))}, index=AT)
    return decayed_mean(out, KEY, ORDER, {"atr": (F.col("tr"), 1.0 / n)}, AT).drop(AT)


def _typical() -> Column:
    return (F.col("high") + F.col("low") + F.col("close")) / 3


def vwma(df: DataFrame, n: int = 14) -> DataFrame:
    def build(w):
        f = w.rowsBetween(-(n - 1), 0)
        return {"vwma": F.sum(_typical() * F.col("volume")).over(f) / F.sum("volume").over(f)}
    return framed(df, KEY, ORDER, n, 0, build)


def mfi(df: DataFrame, n: int = 14) -> DataFrame:
    """Money flow index 0 to 100; 50 where no money moved."""
    out = numbered(df.withColumn("_tp", _typical()))
    out = framed(out, KEY, ORDER, 1, 0, lambda w: {"_move": F.col("_tp") - F.lag("_tp").over(w)}, index=AT)
    flow = F.col("_tp") * F.col("volume")

    def build(w):
        f = w.rowsBetween(-(n - 1), 0)
        up = F.sum(F.when(F.col("_move") > 0, flow).otherwise(0.0)).over(f)
        down = F.sum(F.when(F.col("_move") < 0, flow).otherwise(0.0)).over(f)
        return {"mfi": F.when(up + down > 0, 100 * up / (up + down)).otherwise(50.0)}
    return framed(out, KEY, ORDER, n, 0, build, index=AT).drop("_tp", "_move", AT)
