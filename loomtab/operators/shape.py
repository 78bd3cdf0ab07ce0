"""Row and column shaping that needs a look at the whole frame first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def oldest_month(df: DataFrame, ts: str) -> DataFrame:
    """Rows from the first of the oldest row's month to one month minus a day later.

    Both edges keep the time of day of the oldest row, so the month is cut there.
    """
    first = df.agg(F.min(ts)).scalar()
    start = first - F.make_dt_interval(F.dayofmonth(first) - 1)
    end = start + F.expr("INTERVAL 1 MONTH") - F.expr("INTERVAL 1 DAY")
    return df.where(F.col(ts).between(start, end))


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Remove columns with no value at all; one counting pass over the frame."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c]])
