"""Repeatable samples, splits and resampling.

Rows are ordered by a seeded hash of a unique key, so a split is the same for
every run and partitioning. A quota of that order is found from a histogram of
hash prefixes: only the rows of the one bucket at the border are ranked, and
the data itself is filtered against the border, not sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from loomtab.operators.ordered import attach, keyed_join, row_index, running

Quota = Callable[[Column], Column]


def seeded_key(key: Column | str, seed: int | str) -> Column:
    """Hash of a key and the seed; NULL is a key of its own."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("\0")), F.lit(str(seed))))


def hash_parts(df: DataFrame, key: str, seed: int, quotas: Sequence[Quota], by: Sequence[str] = (),
               name: str = "part") -> DataFrame:
    """Number the rows of each group by cumulative quota in hash order.

    ``quotas`` map the group's row count to the upper end of part 0, 1, ...;
    rows beyond the last quota get ``len(quotas)``. Rows with equal keys, NULL
    keys among them, follow the hash of the whole row; rows equal in all columns
    are interchangeable. Parts are exact at every size: a histogram of hash
    prefixes finds the bucket in which a quota ends, its rows alone are ranked.
    """
    by = list(by)
    hashed = df.withColumns({"_h": seeded_key(key, seed), "_t": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])}) \
        .withColumn("_b", F.substring("_h", 1, 4))
    borders = _hash_borders(hashed.select(*by, "_b"), by, quotas)
    if by:
        joined = keyed_join(hashed, borders, by, "left")
    else:
        joined = attach(hashed, borders, "_cuts")
        joined = joined.withColumns({c: F.col("_cuts")[c] for c in borders.columns}).drop("_cuts")
    at_border = F.array_contains(F.array(*[F.coalesce(f"_b{i}", F.lit("")) for i in range(len(quotas))]), F.col("_b"))
    ranked = joined.where(at_border).withColumn("_r", F.row_number().over(Window.partitionBy(*by, "_b").orderBy("_h", "_t")))
    every = joined.where(~at_border).withColumn("_r", F.lit(0)).unionByName(ranked)
    beyond = [F.coalesce((F.col("_b") > F.col(f"_b{i}")) | ((F.col("_b") == F.col(f"_b{i}")) & (F.col("_r") > F.col(f"_need{i}"))), F.lit(True))
              for i in range(len(quotas))]
    return every.withColumn(name, sum((c.cast("int") for c in beyond), F.lit(0))).select(*df.columns, name)


def _hash_borders(base: DataFrame, by: list[str], quotas: Sequence[Quota]) -> DataFrame:
    """(by..., _b0, _need0, ...): the bucket in which each quota ends and how many of its rows are inside; NULL for an empty quota."""
    hist = base.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    ends = hist.withColumn("_end", F.sum("_c").over(w))  # at most 65536 rows per group
    totals = hist.groupBy(*by).agg(F.sum("_c").alias("_n"))
    ends = keyed_join(ends, totals, by) if by else ends.withColumn("_n", totals.select("_n").scalar())
    found = []
    for i, quota in enumerate(quotas):
        q = F.least(quota(F.col("_n")).cast("long"), F.col("_n"))
        here = (F.col("_end") >= q) & (F.col("_end") - F.col("_c") < q)
        found += [F.max(F.when(here, F.col("_b"))).alias(f"_b{i}"), F.max(F.when(here, q - (F.col("_end") - F.col("_c")))).alias(f"_need{i}")]
    return ends.groupBy(*by).agg(*found)


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Rows whose seeded hash lies in the first ``fraction`` of all hashes: the same for every run and partitioning."""
    bound = format(int(fraction * 16**8), "08x")
    return df if fraction >= 1 else df.where(seeded_key(key, seed) < bound)


def sample_exact(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` uniform rows (all rows when there are fewer)."""
    return hash_parts(df, key, seed, [lambda _: F.lit(n)]).where("part = 0").drop("part")


def stratified_cap(df: DataFrame, cls: str, key: str, cap: int, seed: int) -> DataFrame:
    """Cut to about ``cap`` rows with the class shares kept."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return hash_parts(df, key, seed, [lambda n: F.floor(n * F.least(F.lit(1.0), F.lit(cap) / total))], [cls]).where("part = 0").drop("part")


def balanced_sample(df: DataFrame, cls: str, key: str, per_class: int, seed: int) -> DataFrame:
    return hash_parts(df, key, seed, [lambda _: F.lit(per_class)], [cls]).where("part = 0").drop("part")


def stratified_split(df: DataFrame, cls: str, key: str, test: float, seed: int) -> DataFrame:
    """Adds ``split``: ``floor(n * test)`` rows of each class are test."""
    out = hash_parts(df, key, seed, [lambda n: F.floor(n * F.lit(test))], [cls])
    return out.withColumn("split", F.when(F.col("part") == 0, "test").otherwise("train")).drop("part")


def three_way_split(df: DataFrame, key: str, seed: int, test: float = 0.1, validation: float = 0.3) -> DataFrame:
    """Test first, then validation as its share of the rest."""
    def first(n):
        return F.floor(n * F.lit(test))

    def second(n):
        return first(n) + F.floor((n - first(n)) * F.lit(validation / (1 - test)))

    names = F.array(F.lit("test"), F.lit("validation"), F.lit("train"))
    return hash_parts(df, key, seed, [first, second]).withColumn("split", F.get(names, F.col("part"))).drop("part")


def half_split(df: DataFrame, key: str, seed: int) -> DataFrame:
    return hash_parts(df, key, seed, [lambda n: F.floor(n / 2)], name="half")


def entity_bucket(key: Column | str, buckets: int) -> Column:
    """Bucket of an entity id; all rows of the entity share it."""
    key = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 7), 16, 10).cast("long") % buckets


def group_mod_split(df: DataFrame, entity: str, buckets: int = 4) -> DataFrame:
    return df.withColumn("split", F.when(entity_bucket(entity, buckets) == 0, "validation").otherwise("train"))


def time_split(df: DataFrame, order: Sequence[str], test: float) -> DataFrame:
    """Adds ``split``: the first ``int(n * (1 - test))`` rows in time order are train.

    Only the order columns are ranked; the row at the border is read and the
    table is filtered against it.
    """
    keys = df.select(*order)
    n = df.count()
    cut = int(n * (1 - test))
    if cut == 0:
        return df.withColumn("split", F.lit("test"))
    edge = row_index(keys, [], order, "_i").where(F.col("_i") == cut - 1).select(F.struct(*order)).scalar()
    return df.withColumn("split", F.when(F.struct(*order) <= edge, "train").otherwise("test"))


def date_shift_validation(train: DataFrame, test: DataFrame, date: str, days: int = 365) -> DataFrame:
    """Training rows inside the test date range moved back by ``days``: > min and <= max."""
    span = test.agg(F.date_sub(F.to_date(F.min(date)), days).alias("lo"), F.date_sub(F.to_date(F.max(date)), days).alias("hi"))
    d = F.to_date(date)
    return train.where((d > span.select("lo").scalar()) & (d <= span.select("hi").scalar()))


def k_fold(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """Contiguous folds of near-equal size."""
    n = df.agg(F.count(F.lit(1))).scalar()
    return row_index(df, [], order, "_i").withColumn("fold", F.floor(F.col("_i") * k / n).cast("int")).drop("_i")


def mix_ratio(a: DataFrame, b: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """All of ``a`` plus ``(1 - share) * |a|`` sampled rows of ``b``, in seeded order."""
    extra = int(a.count() * (1 - share))
    both = a.withColumn("origin", F.lit("a")).unionByName(sample_exact(b, key, extra, seed).withColumn("origin", F.lit("b")))
    return both.orderBy(seeded_key(F.concat("origin", F.col(key).cast("string")), seed))


def length_cap(df: DataFrame, text: str, order: Sequence[str], total: int, each: int) -> DataFrame:
    """Documents cut to ``each`` characters, kept while the text before them is below ``total``."""
    cut = df.withColumn(text, F.substring(text, 1, each))
    lengths = running(cut.select(*order, F.length(text).cast("long").alias("_len")), [], order, {"_end": ("sum", F.col("_len"))})
    keep = lengths.where(F.col("_end") - F.col("_len") < total).select(*order)
    return cut.join(keep, list(order), "left_semi")


# ---- class balance ---------------------------------------------------------

def _class_sizes(df: DataFrame, target: str) -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(target) == 0), F.count_if(F.col(target) == 1)).first()
    return row[0], row[1]


def _draw(n: int, pool: int, seed: int, spark) -> DataFrame:
    """``n`` rows (draw, _i): a uniform position in the pool, repeatable."""
    return spark.range(n).select(F.col("id").alias("draw"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(pool)).alias("_i"))


def oversample(df: DataFrame, target: str, key: str, ratio: float, seed: int) -> DataFrame:
    """Minority rows (target 1) repeated with replacement to ``min(int(n_major * ratio), n_major)``."""
    major, minor = _class_sizes(df, target)
    extra = min(int(major * ratio), major) - minor
    if extra <= 0 or minor == 0:
        return df
    pool = row_index(df.where(F.col(target) == 1), [], [key], "_i")
    drawn = _draw(extra, minor, seed, df.sparkSession).join(pool, "_i").drop("_i", "draw")
    return df.unionByName(drawn)


def undersample(df: DataFrame, target: str, key: str, ratio: float, seed: int) -> DataFrame:
    """Majority rows (target 0) cut to ``int(n_minor / ratio)``."""
    _, minor = _class_sizes(df, target)
    kept = sample_exact(df.where(F.col(target) == 0), key, int(minor / ratio), seed)
    return df.where(F.col(target) == 1).unionByName(kept)


def smote(df: DataFrame, target: str, key: str, features: Sequence[str], k: int, ratio: float, seed: int) -> DataFrame:
    """New minority rows between a row and one of its k nearest minority neighbours.

    ``x + u * (neighbour - x)`` on the feature columns, other columns copied;
    unchanged when the minority has fewer than k + 1 rows. Neighbours are exact.
    """
    from loomtab.operators.neighbors import nearest

    major, minor = _class_sizes(df, target)
    extra = min(int(major * ratio), major) - minor
    if extra <= 0 or minor < k + 1:
        return df
    pool = row_index(df.where(F.col(target) == 1), [], [key], "_i")
    near = nearest(pool.select(key, F.array(*[F.col(c).cast("double") for c in features]).alias("_v")), key, "_v", k)
    draws = _draw(extra, minor, seed, df.sparkSession).withColumns({
        "rank": (F.pmod(F.xxhash64("draw", F.lit(seed + 1)), F.lit(k)) + 1).cast("int"),
        "_u": F.pmod(F.xxhash64("draw", F.lit(seed + 2)), F.lit(1_000_003)) / 1_000_003.0})
    other = pool.select(F.col(key).alias("neighbor"), *[F.col(c).alias(f"_n_{c}") for c in features])
    made = draws.join(pool, "_i").join(near.select(key, "rank", "neighbor"), [key, "rank"]).join(other, "neighbor")
    made = made.withColumns({c: F.col(c) + F.col("_u") * (F.col(f"_n_{c}") - F.col(c)) for c in features})
    kinds = {f.name: f.dataType for f in df.schema.fields}
    widened = {c: T.DoubleType() for c in features if not isinstance(kinds[c], (T.DoubleType, T.FloatType))}
    base = df.withColumns({c: F.col(c).cast(d) for c, d in widened.items()}) if widened else df
    return base.withColumn("synthetic", F.lit(False)).unionByName(made.select(*df.columns).withColumn("synthetic", F.lit(True)))
