"""Name -> (Spark query, equivalent SQL) registry used by the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loomtab.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its SQL twin."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # all times are UTC
            return fn(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


# Both engines sum floating values in their own order, so results are compared
# after rounding; the small shift keeps exact ties from landing on either side.
_SHIFT = 1e-9


def rnd(col: Column | str, places: int = 4) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col + F.lit(_SHIFT), places)


def R(expr: str, places: int = 4) -> str:
    return f"round(({expr}) + 1e-9, {places})"
