"""Aggregates, profiles and reports. Each is one pass with map-side partial
aggregation unless the text says otherwise."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from loomtab.operators.ordered import attach, exact_quantiles, hot_groups, keyed_join
from loomtab.sources.tables import numeric_columns


def safe_corr(a, b) -> Column:
    """Pearson correlation over rows where both are present; NULL instead of NaN."""
    c = F.corr(a, b)
    return F.when(~F.isnan(c), c)


def melt(df: DataFrame, keep: Sequence[str], rows: dict[str, dict[str, Column]], label: str = "column") -> DataFrame:
    """One output row per entry of ``rows``: (keep..., label, its expressions)."""
    cells = [F.struct(F.lit(name).alias(label), *[c.alias(n) for n, c in cols.items()]) for name, cols in rows.items()]
    return df.select(*keep, F.explode(F.array(*cells)).alias("_cell")).select(*keep, "_cell.*")


def column_stats(df: DataFrame, col: str) -> DataFrame:
    """count, mean, median, min, max, population std rounded to 2; zeros when empty."""
    basic = df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.min(col).alias("min"),
                   F.max(col).alias("max"), F.stddev_pop(col).alias("std"))
    median = exact_quantiles(df.select(col), [], [col], [0.5])
    zero = F.lit(0.0)
    return basic.select(
        "count", *[F.round(F.coalesce(F.col(c).cast("double"), zero), 2).alias(c) for c in ("mean", "min", "max", "std")],
        F.round(F.coalesce(median.select(f"{col}_q0").scalar(), zero), 2).alias("median"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("pct", F.col("n") * 100.0 / total))


def class_conditional_stats(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """(target, column, mean, std, min, max, median, n)."""
    wide = df.groupBy(target).agg(*[f(c).alias(f"{c}_{n}") for c in cols for n, f in (
        ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max), ("n", F.count))])
    wide = keyed_join(wide, exact_quantiles(df, [target], cols, [0.5]), [target])
    return melt(wide, [target], {c: {
        **{n: F.col(f"{c}_{n}").cast("double") for n in ("mean", "std", "min", "max")},
        "median": F.col(f"{c}_q0"), "n": F.col(f"{c}_n")} for c in cols})


def group_feature_means(df: DataFrame, by: str, cols: Sequence[str] | None = None) -> DataFrame:
    cols = cols or numeric_columns(df, (by,))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in cols])


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every ordered pair, pairwise null handling, 4 digits."""
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[safe_corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)],
                  *[F.count(c).alias(f"n_{c}") for c in cols])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in ((a, b), (b, a)):
            cells.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.round(F.col(f"c{i}"), 4).alias("corr")))
    cells += [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"),
                       F.when(F.col(f"n_{c}") > 1, F.lit(1.0)).alias("corr")) for c in cols]
    return wide.select(F.inline(F.array(*cells)))


def target_correlations(df: DataFrame, target: str, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, corr) sorted by absolute value; undefined ones dropped."""
    wide = df.groupBy(*by).agg(*[safe_corr(c, target).alias(c) for c in cols])
    out = melt(wide, list(by), {c: {"corr": F.col(c)} for c in cols}).where("corr is not null")
    return out.orderBy(*by, F.desc(F.abs("corr")), "column")


def outlier_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, p1, p99, mean, std, outlier_share): share beyond 3 sample std. Two passes."""
    stats = df.agg(*[f(c).alias(f"{c}_{n}") for c in cols for n, f in (("mean", F.avg), ("std", F.stddev_samp))])
    s = F.col("_s")
    beyond = {c: F.avg((F.abs(F.col(c) - s[f"{c}_mean"]) > 3 * s[f"{c}_std"]).cast("double")) for c in cols}
    shares = attach(df.select(*cols), stats).agg(*[e.alias(f"{c}_share") for c, e in beyond.items()])
    wide = attach(attach(shares, stats), exact_quantiles(df, [], cols, [0.01, 0.99]), "_q")
    q = F.col("_q")
    return melt(wide, [], {c: {
        "p1": q[f"{c}_q0"], "p99": q[f"{c}_q1"], "mean": s[f"{c}_mean"], "std": s[f"{c}_std"],
        "outlier_share": F.col(f"{c}_share")} for c in cols})


def missing_pct(df: DataFrame) -> DataFrame:
    """(column, missing_pct) plus the rate over all cells as column ``*``."""
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    overall = sum((F.col(c) for c in df.columns), F.lit(0.0)) / len(df.columns)
    return melt(wide, [], {**{c: {"missing_pct": F.col(c) * 100} for c in df.columns}, "*": {"missing_pct": overall * 100}})


def dataset_profile(df: DataFrame, target: str) -> DataFrame:
    """(metric, column, value): shape, class shares, imbalance and numeric statistics."""
    numeric = numeric_columns(df, (target,))
    named = (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[f(c).cast("double").alias(f"{n}|{c}") for c in numeric for n, f in named],
                  *[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(f"missing_pct|{c}") for c in df.columns])

    def cell(metric, column, value):
        return F.struct(F.lit(metric).alias("metric"), F.lit(column).alias("column"), value.cast("double").alias("value"))

    cells = [cell("rows", "*", F.col("_rows")), cell("columns", "*", F.lit(len(df.columns)))]
    cells += [cell(*c.split("|"), F.col(f"`{c}`")) for c in wide.columns if "|" in c]
    general = wide.select(F.inline(F.array(*cells)))
    classes = value_counts(df.where(F.col(target).isNotNull()), target)
    shares = classes.select(F.lit("class_pct").alias("metric"), F.col(target).cast("string").alias("column"),
                            F.col("pct").alias("value"))
    balance = classes.agg(F.count(F.lit(1)).alias("k"), F.min("pct").alias("least")).select(F.inline(F.array(
        cell("n_classes", target, F.col("k")), cell("is_imbalanced", target, (F.col("least") < 20).cast("int")))))
    return general.unionByName(shares).unionByName(balance)


def infer_task_type(df: DataFrame, target: str) -> DataFrame:
    """classification for text, few values (at most 20) or a distinct share below 0.05; else regression."""
    is_text = isinstance(df.schema[target].dataType, T.StringType)
    stats = df.agg(F.countDistinct(target).alias("n_unique"), F.count(target).alias("n"))
    few = (F.col("n_unique") <= 20) | (F.col("n_unique") / F.col("n") < 0.05)
    return stats.select("n_unique", F.when(F.lit(is_text) | few, "classification").otherwise("regression").alias("task"))


def quality_score(df: DataFrame, target: str | None = None) -> DataFrame:
    """One row: score in [0, 1] and the recommendations behind its deductions."""
    cells = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    prof = df.agg(F.count(F.lit(1)).alias("n"), (F.sum(cells) / (F.count(F.lit(1)) * len(df.columns))).alias("missing"))
    ratio = F.lit(None).cast("double")
    if target:
        counts = df.where(F.col(target).isNotNull()).groupBy(target).count()
        ratio = counts.agg(F.when(F.count(F.lit(1)) >= 2, F.max("count") / F.greatest(F.min("count"), F.lit(1)))).scalar()
    prof = prof.withColumn("imbalance", ratio)
    n, miss, imb = F.col("n"), F.col("missing"), F.col("imbalance")

    def tiers(*steps):
        out = F.when(F.lit(False), F.lit(0.0))
        for cond, loss, _ in steps:
            out = out.when(cond, F.lit(loss))
        return out.otherwise(0.0)

    def advice(*steps):
        out = F.when(F.lit(False), F.lit(None).cast("string"))
        for cond, _, text in steps:
            out = out.when(cond, F.lit(text))
        return out

    size = [(n < 100, 0.4, "very small: collect or augment data"), (n < 1000, 0.2, "small: cross-validate and regularise")]
    holes = [(miss > 0.5, 0.3, "very high missingness: impute or drop features"),
             (miss > 0.1, 0.1, "moderate missingness: impute")]
    skew = [(imb > 10, 0.2, "severe class imbalance: weight or resample"),
            (imb > 3, 0.05, "moderate class imbalance: stratify and weight metrics")]
    score = F.lit(1.0) - tiers(*size) - tiers(*holes) - tiers(*skew)
    score = F.when(n > 50000, F.least(score + 0.05, F.lit(1.0))).otherwise(score)
    notes = F.filter(F.array(advice(*size), advice(*holes), advice(*skew)), lambda x: x.isNotNull())
    return prof.select("n", "missing", "imbalance", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 4).alias("score"),
                       F.array_join(notes, "; ").alias("recommendations"))


def funnel_counts(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """(stage, n): each stage also needs every stage before it. One pass."""
    passed, aggs, cond = [], [], F.lit(True)
    for name, test in stages.items():
        cond = cond & F.coalesce(test, F.lit(False))
        aggs.append(F.count_if(cond).alias(name))
        passed.append(name)
    return melt(df.agg(*aggs), [], {n: {"n": F.col(n)} for n in passed}, label="stage")


def class_weights(df: DataFrame, target: str, boost: dict | None = None) -> DataFrame:
    """(target, n, weight): 1/(n+1e-6), boosted classes multiplied, scaled to sum to the class count."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    factor = F.lit(1.0)
    for value, by in (boost or {}).items():
        factor = F.when(F.col(target) == F.lit(value), F.lit(float(by))).otherwise(factor)
    raw = counts.withColumn("raw", factor / (F.col("n") + 1e-6))
    total = raw.agg((F.sum("raw") / F.count(F.lit(1)))).scalar()
    return raw.select(target, "n", (F.col("raw") / total).alias("weight"))


def positive_weight(df: DataFrame, target: str) -> DataFrame:
    return df.agg((F.count_if(F.col(target) == 0) / F.nullif(F.count_if(F.col(target) == 1), F.lit(0))).alias("pos_weight"))


def top_bottom(df: DataFrame, metric: str, n: int, tie: str) -> DataFrame:
    top = df.orderBy(F.desc(metric), tie).limit(n).withColumn("side", F.lit("top"))
    return top.unionByName(df.orderBy(metric, tie).limit(n).withColumn("side", F.lit("bottom")))


def metric_by_config(runs: Sequence[DataFrame], config: Sequence[str], metric: str) -> DataFrame:
    """Runs stacked by name, incomplete and repeated rows dropped, mean and max per config."""
    stacked = runs[0]
    for r in runs[1:]:
        stacked = stacked.unionByName(r, allowMissingColumns=True)
    clean = stacked.dropna(subset=[*config, metric]).dropDuplicates()
    return clean.groupBy(*config).agg(F.avg(metric).alias(f"mean_{metric}"), F.max(metric).alias(f"max_{metric}"))


def template_mean(df: DataFrame, template: str, media: str, vector: str, dims: int) -> DataFrame:
    """Mean vector inside (template, media), summed over media, scaled to length 1.

    Dimensions are aggregate columns, so nothing is exploded or collected.
    """
    names = [f"d{i}" for i in range(dims)]
    inner = df.groupBy(template, media).agg(*[F.avg(F.get(vector, F.lit(i)).cast("double")).alias(n) for i, n in enumerate(names)])
    outer = inner.groupBy(template).agg(*[F.sum(n).alias(n) for n in names])
    length = F.sqrt(sum((F.col(n) * F.col(n) for n in names), F.lit(0.0)))
    return outer.select(template, F.transform(F.array(*names), lambda v: v / length).alias(vector))


# ---- custom reductions -----------------------------------------------------

def grouped_reduce(df: DataFrame, key: str, partial: Callable[[pd.DataFrame], dict], merge: Callable[[dict, dict], dict],
                   state_schema: str, done: DataFrame | None = None) -> DataFrame:
    """Custom reduction per key from mergeable states (dicts of scalars).

    Every task folds its rows to one state per key before the shuffle, so a hot
    key sends one small row per task. Keys already in ``done`` are skipped.
    """
    if done is not None:
        df = df.join(done.select(key).distinct(), key, "left_anti")
    kind = df.schema[key].dataType.simpleString()
    names = [f.name for f in T.StructType.fromDDL(state_schema).fields]
    schema = f"`{key}` {kind}, {state_schema}"

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for frame in frames:
            for k, rows in frame.groupby(key, sort=False, dropna=False):
                state = partial(rows)
                held[k] = merge(held[k], state) if k in held else state
            if len(held) > 100_000:
                yield pd.DataFrame([{key: k, **s} for k, s in held.items()])
                held = {}
        if held:
            yield pd.DataFrame([{key: k, **s} for k, s in held.items()])

    def finish(k: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        states = frame[names].to_dict("records")
        total = states[0]
        for s in states[1:]:
            total = merge(total, s)
        return pd.DataFrame([{key: k[0], **total}])

    return df.mapInPandas(fold, schema).groupBy(key).applyInPandas(finish, schema)


def grouped_map(df: DataFrame, by: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A function of a whole group, for groups that fit a task.

    Sizes are checked first; a hot group stops the call and points to
    ``grouped_reduce`` or ``framed`` rather than loading it into one worker.
    """
    if hot_groups(df, by) is not None:
        raise ValueError("a group exceeds the one-task bound: use grouped_reduce or framed")
    return df.groupBy(*by).applyInPandas(fn, schema)
