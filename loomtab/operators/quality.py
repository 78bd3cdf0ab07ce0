"""Table contracts, rule suites, drift, freshness and feature tables."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from loomtab.operators.aggregates import melt
from loomtab.operators.ordered import attach, exact_quantiles, running


# ---- rules -----------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """A named row test. ``test()`` is true for good rows; NULL passes unless ``required``.

    The test is made on use, so contracts can be declared before a session exists.
    """
    name: str
    test: Callable[[], Column]
    required: bool = False

    def broken(self) -> Column:
        return F.coalesce(~self.test(), F.lit(self.required))


def at_least(col: str, low) -> Rule:
    return Rule(f"{col} >= {low}", lambda: F.col(col) >= F.lit(low))


def at_most(col: str, high) -> Rule:
    return Rule(f"{col} <= {high}", lambda: F.col(col) <= F.lit(high))


def in_range(col: str, low, high) -> Rule:
    return Rule(f"{col} in [{low}, {high}]", lambda: F.col(col).between(low, high))


def one_of(col: str, values: Sequence) -> Rule:
    return Rule(f"{col} in {sorted(values)}", lambda: F.col(col).isin(list(values)))


def not_null(col: str) -> Rule:
    return Rule(f"{col} not null", lambda: F.col(col).isNotNull(), True)


def equals(name: str, left: str, right: str, tolerance: float = 1e-6) -> Rule:
    """Two SQL expressions over the row agree within a tolerance."""
    return Rule(name, lambda: F.abs(F.expr(left) - F.expr(right)) <= tolerance)


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, n_rows, n_bad, ok): every rule in one aggregate pass."""
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(r.broken()).alias(f"r{i}") for i, r in enumerate(rules)])
    cells = [F.struct(F.lit(r.name).alias("rule"), F.col("_n").alias("n_rows"), F.col(f"r{i}").alias("n_bad"),
                      (F.col(f"r{i}") == 0).alias("ok")) for i, r in enumerate(rules)]
    return wide.select(F.inline(F.array(*cells)))


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class Contract:
    """Columns (name -> type), which of them may be NULL, and row rules; ``extend`` inherits."""
    columns: dict[str, str]
    nullable: frozenset[str] = frozenset()
    rules: tuple[Rule, ...] = field(default=())

    def extend(self, columns: dict[str, str] | None = None, nullable: Sequence[str] = (), rules: Sequence[Rule] = ()) -> Contract:
        return Contract({**self.columns, **(columns or {})}, self.nullable | frozenset(nullable), self.rules + tuple(rules))

    def schema_problems(self, schema: T.StructType) -> list[str]:
        found = {f.name: f.dataType.simpleString() for f in schema.fields}
        out = [f"missing column {c}" for c in self.columns if c not in found]
        for c, kind in self.columns.items():
            want = T.StructType.fromDDL(f"`{c}` {kind}").fields[0].dataType.simpleString()
            if c in found and found[c] != want:
                out.append(f"column {c} is {found[c]}, expected {want}")
        return out

    def report(self, df: DataFrame) -> DataFrame:
        required = [not_null(c) for c in self.columns if c not in self.nullable and c in df.columns]
        return check_rules(df, [*required, *self.rules])


def enforce(df: DataFrame, contract: Contract, on_error: str = "raise") -> DataFrame:
    """The frame itself if it holds; ``warn`` reports and keeps it, ``raise`` stops."""
    if on_error not in ("raise", "warn"):
        raise ValueError(f"unknown mode {on_error!r}")
    problems = contract.schema_problems(df.schema)
    if not problems:
        problems = [f"{r['rule']}: {r['n_bad']} of {r['n_rows']} rows" for r in contract.report(df).where("not ok").collect()]
    if problems and on_error == "raise":
        raise ContractError("; ".join(problems))
    for p in problems:
        warnings.warn(p, stacklevel=2)
    return df


def suite_rules(text: str) -> list[Rule]:
    """Rules out of a JSON list such as ``[{"kind": "in_range", "column": "x", "low": 0, "high": 9}]``."""
    build: dict[str, Callable[..., Rule]] = {
        "not_null": not_null, "at_least": lambda column, low: at_least(column, low),
        "at_most": lambda column, high: at_most(column, high),
        "in_range": lambda column, low, high: in_range(column, low, high),
        "one_of": lambda column, values: one_of(column, values)}
    out = []
    for item in json.loads(text):
        kind = item.pop("kind")
        if kind not in build:
            raise ValueError(f"unknown rule kind {kind!r}")
        out.append(not_null(item["column"]) if kind == "not_null" else build[kind](**item))
    return out


def run_suite(df: DataFrame, text: str, where: Column | None = None) -> DataFrame:
    """A rule suite over a table, file or SQL result, on some of its partitions only if asked."""
    return check_rules(df if where is None else df.where(where), suite_rules(text))


def metric_constraints(df: DataFrame, limits: dict[str, dict[str, float]]) -> DataFrame:
    """(column, constraint, value, ok) for min_above, max_below, mean_low, mean_high, null_pct_below."""
    stats = {"min_above": F.min, "max_below": F.max, "mean_low": F.avg, "mean_high": F.avg,
             "null_pct_below": lambda c: F.avg(F.col(c).isNull().cast("double")) * 100}
    flat = [(c, kind, bound) for c, kinds in limits.items() for kind, bound in kinds.items()]
    wide = df.agg(*[stats[kind](c).cast("double").alias(f"m{i}") for i, (c, kind, _) in enumerate(flat)])
    cells = []
    for i, (c, kind, bound) in enumerate(flat):
        v = F.col(f"m{i}")
        ok = {"min_above": v > bound, "max_below": v < bound, "mean_low": v >= bound, "mean_high": v <= bound, "null_pct_below": v < bound}[kind]
        cells.append(F.struct(F.lit(c).alias("column"), F.lit(kind).alias("constraint"), v.alias("value"), F.coalesce(ok, F.lit(False)).alias("ok")))
    return wide.select(F.inline(F.array(*cells)))


# ---- drift and freshness -----------------------------------------------------

def psi(reference: DataFrame, new: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """(column, psi) over the reference's quantile bins."""
    q = exact_quantiles(reference, [], cols, [i / bins for i in range(1, bins)])

    def bin_of(c):
        above = [(F.col(c) > F.col("_e")[f"{c}_q{i}"]).cast("int") for i in range(bins - 1)]
        return F.when(F.col(c).isNotNull(), sum(above, F.lit(0)))

    def counted(df, tag):
        cells = [F.struct(F.lit(c).alias("column"), bin_of(c).alias("b")) for c in cols]
        return attach(df.select(*cols), q, "_e").select(F.inline(F.array(*cells))).where("b is not null").withColumn("side", F.lit(tag))

    both = counted(reference, "r").unionByName(counted(new, "n")).groupBy("column", "b").agg(
        F.count_if(F.col("side") == "r").alias("r"), F.count_if(F.col("side") == "n").alias("n"))
    tot = both.groupBy("column").agg(F.sum("r").alias("tr"), F.sum("n").alias("tn"))
    a = F.greatest(F.col("n") / F.col("tn"), F.lit(1e-4))
    e = F.greatest(F.col("r") / F.col("tr"), F.lit(1e-4))
    return both.join(tot, "column").groupBy("column").agg(F.sum((a - e) * F.ln(a / e)).alias("psi"))


def ks_statistic(reference: DataFrame, new: DataFrame, col: str) -> DataFrame:
    """Largest gap between the two distribution functions, from counts per distinct value."""
    both = (reference.select(F.col(col).alias("v"), F.lit(1).alias("r"), F.lit(0).alias("n"))
            .unionByName(new.select(F.col(col).alias("v"), F.lit(0).alias("r"), F.lit(1).alias("n")))
            .where("v is not null").groupBy("v").agg(F.sum("r").alias("r"), F.sum("n").alias("n")))
    cum = running(both, [], ["v"], {"cr": ("sum", F.col("r")), "cn": ("sum", F.col("n"))})
    tot = both.agg(F.sum("r").alias("r"), F.sum("n").alias("n"))
    return attach(cum, tot).agg(F.max(F.abs(F.col("cr") / F.col("_s.r") - F.col("cn") / F.col("_s.n"))).alias("ks"))


def drift_report(reference: DataFrame, new: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mean_shift in reference std, psi, ks)."""
    about = reference.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    ref = F.col("_s")
    means = attach(new.agg(*[F.avg(c).alias(c) for c in cols]), about)
    shift = melt(means, [], {c: {"mean_shift": (F.col(c) - ref[f"m_{c}"]) / F.nullif(ref[f"s_{c}"], F.lit(0.0)),
                                 "ks": ks_statistic(reference, new, c).scalar()} for c in cols})
    return shift.join(psi(reference, new, cols), "column")


def drift_if_broken(reference: DataFrame, new: DataFrame, limits: dict[str, dict[str, float]]) -> DataFrame | None:
    """The drift report when a constraint fails on the new data, else None."""
    if metric_constraints(new, limits).where("not ok").isEmpty():
        return None
    return drift_report(reference, new, list(limits))


def freshness(df: DataFrame, ts: str, as_of: str, warn_hours: float, error_hours: float) -> DataFrame:
    """(newest, age_hours, status): pass, warn or error against a given time."""
    newest = df.agg(F.max(ts).alias("newest"))
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("newest")) / 3.6e9
    status = F.when(F.col("newest").isNull() | (F.col("age_hours") > error_hours), "error") \
        .when(F.col("age_hours") > warn_hours, "warn").otherwise("pass")
    return newest.withColumn("age_hours", age).withColumn("status", status)


# ---- feature tables ----------------------------------------------------------

def latest_features(df: DataFrame, key: str, ts: str, columns: Sequence[str], start: str, end: str) -> DataFrame:
    """Newest feature row per key inside [start, end]."""
    inside = F.col(ts).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    return (df.where(inside).groupBy(key).agg(F.max(F.struct(ts, *columns)).alias("_r")).select(key, "_r.*"))


def materialize_features(features: DataFrame, path: str) -> DataFrame:
    features.write.mode("overwrite").parquet(path)
    return features.sparkSession.read.schema(features.schema).parquet(path)


def lookup_features(entities: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Feature row per entity with a ``found`` flag."""
    return entities.join(table.withColumn("found", F.lit(True)), key, "left").fillna(False, subset=["found"])


def backfill_days(spark: SparkSession, df: DataFrame, ts: str, start: str, days: int, aggs: Sequence[Column]) -> DataFrame:
    """A per-day job for ``days`` days as one grouped query; days without rows are present."""
    cal = spark.range(days).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("day"))
    lo = F.lit(start).cast("timestamp")
    hi = F.date_add(F.lit(start).cast("date"), days).cast("timestamp")
    inside = df.where((F.col(ts) >= lo) & (F.col(ts) < hi))
    return cal.join(inside.groupBy(F.to_date(ts).alias("day")).agg(*aggs), "day", "left")


def overwrite_days(df: DataFrame, path: str) -> None:
    """Replace only the days present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
