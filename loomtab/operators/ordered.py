"""Ordered computation that survives a group, or no group at all, holding most rows.

A plain window puts each group into one task. Groups beyond the hot-row bound,
and windows with no group, are instead cut into range slices of the order key:
each slice is computed on its own, the per-slice totals (one row per slice) are
accumulated, and the carry is joined back. Results equal the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from loomtab.session import HOT_ROWS, HOT_ROWS_DEFAULT, materialize, setting, written

_AGG = {"sum": F.sum, "min": F.min, "max": F.max}


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on ``keys`` where NULL keys match each other; keeps left's keys once."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, cond, how).drop(*[f"_r_{k}" for k in keys])


def attach(df: DataFrame, one_row: DataFrame, name: str = "_s") -> DataFrame:
    """The columns of a one-row frame as a struct beside every row.

    A scalar subquery runs once and is read as a value: no join. It is attached
    as one column because each further mention of a subquery is planned again.
    """
    return df.withColumn(name, one_row.select(F.struct(*one_row.columns)).scalar())


def hot_groups(df: DataFrame, by: Sequence[str], limit: int | None = None) -> DataFrame | None:
    """Keys of groups with more than ``limit`` rows, or None when there are none.

    Groups are counted, never estimated. The count combines map-side, and at most
    rows/limit keys come out of it.
    """
    if limit is None:
        limit = setting(df.sparkSession, HOT_ROWS, HOT_ROWS_DEFAULT)
    found = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).drop("_n")
    keys = found.collect()
    return df.sparkSession.createDataFrame(keys, found.schema) if keys else None


def split_hot(df: DataFrame, by: Sequence[str], limit: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary groups, rows of hot groups or None)."""
    keys = hot_groups(df, by, limit)
    if keys is None:
        return df, None
    return keyed_join(df, keys, by, "left_anti"), keyed_join(df, keys, by, "left_semi")


def _sorted(order: Sequence[str], reverse: bool) -> list[Column]:
    return [F.col(c).desc() if reverse else F.col(c).asc() for c in order]


def _range_slices(df: DataFrame, by: Sequence[str], order: Sequence[str], reverse: bool) -> DataFrame:
    """Tag rows with the number of their range slice of (by, order).

    The tag is fixed by the checkpoint, so a recomputed task cannot move a
    border between the two reads below.
    """
    keys = [F.col(c).asc() for c in by] + _sorted(order, reverse)
    return materialize(df.repartitionByRange(*keys).withColumn("_slice", F.spark_partition_id()))


def running_by_slices(df: DataFrame, by: Sequence[str], order: Sequence[str], aggs: dict[str, tuple[str, Column]], reverse: bool = False) -> DataFrame:
    """As ``running``, with every group cut into slices: for wide rows, of which far fewer than the hot-row bound are too much for a task."""
    cut = _range_slices(df.withColumns({f"_in_{n}": c for n, (_, c) in aggs.items()}), by, order, reverse)
    unit = [*by, "_slice"]
    inner = (Window.partitionBy(*unit).orderBy(*_sorted(order, reverse))
             .rowsBetween(Window.unboundedPreceding, 0))
    outer = (Window.partitionBy(*(by or [F.lit(0)])).orderBy("_slice")
             .rowsBetween(Window.unboundedPreceding, -1))
    totals = cut.groupBy(*unit).agg(*[_AGG[f](f"_in_{n}").alias(f"_t_{n}") for n, (f, _) in aggs.items()])
    carry = totals.select(*unit, *[_AGG[f](f"_t_{n}").over(outer).alias(f"_c_{n}") for n, (f, _) in aggs.items()])
    rows = cut.withColumns({n: _AGG[f](f"_in_{n}").over(inner) for n, (f, _) in aggs.items()})
    out = keyed_join(rows, carry, unit, "left")
    merged = {}
    for n, (f, _) in aggs.items():
        local, before = F.col(n), F.col(f"_c_{n}")
        if f == "sum":
            merged[n] = F.when(before.isNull(), local).otherwise(before + F.coalesce(local, F.lit(0)))
        else:
            pick = F.greatest if f == "max" else F.least
            merged[n] = pick(local, before)
    return out.withColumns(merged).select(*df.columns, *aggs)


def running(df: DataFrame, by: Sequence[str], order: Sequence[str],
            aggs: dict[str, tuple[str, Column]], reverse: bool = False) -> DataFrame:
    """Running sum/min/max from the first row of the group up to this row.

    ``order`` must be a total order inside the group. ``by=[]`` means one
    global order.
    """
    by = list(by)
    cold, hot = split_hot(df, by) if by else (None, df)
    parts = []
    if cold is not None:
        w = (Window.partitionBy(*(by or [F.lit(0)])).orderBy(*_sorted(order, reverse))
             .rowsBetween(Window.unboundedPreceding, 0))
        parts.append(cold.withColumns({n: _AGG[f](c).over(w) for n, (f, c) in aggs.items()}))
    if hot is not None:
        parts.append(running_by_slices(hot, by, order, aggs, reverse))
    return reduce(DataFrame.unionByName, parts)


def row_index(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "idx",
              reverse: bool = False) -> DataFrame:
    """0-based position of each row in its group."""
    out = running(df, by, order, {name: ("sum", F.lit(1).cast("long"))}, reverse)
    return out.withColumn(name, F.col(name) - 1)


def carry_last(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: dict[str, Column],
               reverse: bool = False) -> DataFrame:
    """Latest non-null value at or before this row (at or after, with ``reverse``)."""
    fn = "min" if reverse else "max"
    packed = {
        f"_p_{n}": (fn, F.when(c.isNotNull(), F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                                                       c.alias("_v"))))
        for n, c in cols.items()
    }
    out = running(df, by, order, packed, reverse)
    return out.select(*df.columns, *[F.col(f"_p_{n}")["_v"].alias(n) for n in cols])


def framed(df: DataFrame, by: Sequence[str], order: Sequence[str], before: int, after: int,
           build: Callable[[WindowSpec], dict[str, Column]], chunk_rows: int = 250_000, index: str | None = None) -> DataFrame:
    """Window expressions that look at most ``before`` rows back and ``after`` ahead.

    Hot groups are cut into row-count chunks; each chunk also receives the few
    neighbour rows its frames reach, which are dropped after the window. With the rows' ``index`` in their
    group (as ``row_index`` numbers them) every group is cut by it, and nothing is counted again.
    """
    by = list(by)
    size = max(chunk_rows, before, after, 1)
    if index is not None:
        return _chunked(df, by, order, before, after, build, size, index)
    cold, hot = split_hot(df, by)
    out = cold.withColumns(build(Window.partitionBy(*by).orderBy(*order)))
    if hot is None:
        return out
    return out.unionByName(_chunked(row_index(hot, by, order, "_idx"), by, order, before, after, build, size, "_idx").drop("_idx"))


def _chunked(df, by, order, before, after, build, size, index):
    pos = F.col(index) % size
    own = F.floor(F.col(index) / size)
    copies = F.filter(
        F.array(
            F.struct(own.alias("chunk"), F.lit(True).alias("own")),
            F.when(pos >= size - before, F.struct((own + 1).alias("chunk"), F.lit(False).alias("own"))),
            F.when((pos < after) & (own > 0), F.struct((own - 1).alias("chunk"), F.lit(False).alias("own"))),
        ),
        lambda c: c.isNotNull(),
    )
    spread = df.withColumn("_c", F.explode(copies)).withColumns({"_chunk": F.col("_c.chunk"), "_own": F.col("_c.own")})
    w = Window.partitionBy(*by, "_chunk").orderBy(*order)
    return spread.withColumns(build(w)).where("_own").drop("_c", "_chunk", "_own")


def decayed_mean(df: DataFrame, by: Sequence[str], order: Sequence[str],
                 cols: dict[str, tuple[Column, float]], index: str | None = None) -> DataFrame:
    """Exponentially weighted means ``{name: (value, alpha)}``, weights (1-alpha)^age.

    The weight of rows older than one block is below 2**-60, so a block of rows
    plus the total of the block before it gives the recursive value to double
    precision with no recursion and no whole group in one task. ``index`` names
    a column with the rows' place in their group, if there is one.
    """
    blocks = {n: max(2, math.ceil(60 * math.log(2) / -math.log(1.0 - a))) for n, (_, a) in cols.items()}
    block = max(blocks.values())
    # Weights inside a block are scaled by keep**-position and must stay finite.
    if max(-math.log(1.0 - a) for _, a in cols.values()) * block > 500:
        for name, spec in cols.items():
            df = decayed_mean(df, by, order, {name: spec}, index)
        return df
    unit, at = [*by, "_b"], index or "_i"
    pos = (F.col(at) % block).cast("double")
    w = Window.partitionBy(*unit).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    keep = {n: F.lit(1.0 - a) for n, (_, a) in cols.items()}
    rows = df if index else row_index(df, by, order, "_i")
    rows = rows.withColumn("_b", F.floor(F.col(at) / block))
    rows = rows.withColumns({f"_y_{n}": v * F.pow(keep[n], -pos) for n, (v, _) in cols.items()})
    tail = (rows.groupBy(*unit)
            .agg(*[(F.sum(f"_y_{n}") * F.pow(keep[n], F.lit(block - 1.0))).alias(f"_p_{n}") for n in cols])
            .withColumn("_b", F.col("_b") + 1))
    rows = rows.withColumns({f"_s_{n}": F.sum(f"_y_{n}").over(w) * F.pow(keep[n], pos) for n in cols})
    out = keyed_join(rows, tail, unit, "left")
    means = {}
    for n, (_, alpha) in cols.items():
        total = F.col(f"_s_{n}") + F.pow(keep[n], pos + 1) * F.coalesce(f"_p_{n}", F.lit(0.0))
        means[n] = total * alpha / (1 - F.pow(keep[n], F.col(at) + 1))
    return out.withColumns(means).select(*df.columns, *cols)


# Size of a quantile sketch. One of fewer values than this share of it holds them all, and its ranks are exact.
_SKETCH = 4096
_HELD = _SKETCH * 9 // 10
# Ranks this far from the wanted one enclose it nearly always; where they do not, the counts tell and another round follows.
_BRACKET = 2.296 / _SKETCH ** 0.9021


# Shares of the ranks at which a sketch is read, finer than the values it holds: a constant for few values and one for many.
_GRIDS = (128, 4096)


def _spelled(sketch: str, n: str) -> str:
    """Values of a sketch of ``n`` values at the middles of equal shares of its ranks; NULL for none."""
    few, many = (f"kll_sketch_get_quantile_double({sketch}, cast(split('{','.join(f'{(k + 0.5) / g:.6g}' for k in range(g))}', ',') as array<double>))" for g in _GRIDS)
    return f"CASE WHEN {n} > 0 AND {n} < {_GRIDS[0]} THEN {few} WHEN {n} > 0 THEN {many} END"


def _ranked(values: str, share: str) -> str:
    return f"get({values}, cast(least(greatest(floor(({share}) * size({values})), 0), size({values}) - 1) as int))"


def exact_quantiles(df: DataFrame, by: Sequence[str], cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles per group: columns ``{col}_q{i}`` for each prob. NULL and NaN are left out.

    Mergeable sketches of bounded size give each wanted rank an interval. A round counts exactly what lies below, at the
    ends of and inside each interval and sketches the inside; an interval that still holds more values than a sketch keeps
    is narrowed by that sketch for the next round, which shrinks it some hundredfold. Ends are counted apart, so a value
    that repeats without bound is found by its count. Only groups that are not done are read again. No values are gathered:
    whatever the rows, a group's state is its intervals and its sketches, and groups are never sorted or held in one task.
    """
    by, given = list(by), range(len(cols))
    keys = [f"`{b}`" for b in by]
    rows = df.select(*by, *[F.expr(f"nullif(cast(`{c}` as double), double('NaN')) AS _v{i}") for i, c in enumerate(cols)])
    entries = [(i, f"{i}_{j}", f"({float(p)!r}D * (_n{i} - 1))") for i in given for j, p in enumerate(probs)]
    first = rows.groupBy(*by).agg(*[F.expr(e) for i in given for e in (f"count(_v{i}) AS _n{i}", f"kll_sketch_agg_double(_v{i}, {_SKETCH}) AS _s{i}")])
    first = first.selectExpr(*keys, *[f"_n{i}" for i in given], *[f"{_spelled(f'_s{i}', f'_n{i}')} AS _q{i}" for i in given])
    known = []
    for i, tag, at in entries:
        below, above = f"floor({at}) / _n{i} - {_BRACKET}", f"(ceil({at}) + 1) / _n{i} + {_BRACKET}"
        known += [f"CASE WHEN _n{i} <= {_HELD} THEN {_ranked(f'_q{i}', f'({side}({at}) + 0.5) / _n{i}')} END AS _{name}{tag}" for name, side in (("u", "floor"), ("w", "ceil"))]
        known += [f"CASE WHEN _n{i} > {_HELD} AND {below} > 0 THEN {_ranked(f'_q{i}', below)} END AS _l{tag}",
                  f"CASE WHEN _n{i} > {_HELD} AND {above} < 1 THEN {_ranked(f'_q{i}', above)} END AS _h{tag}"]
    state = written(first.selectExpr(*keys, *[f"_n{i}" for i in given], *known), "quantiles")
    unfinished = " OR ".join(f"(_n{i} > 0 AND (_u{tag} IS NULL OR _w{tag} IS NULL))" for i, tag, _ in entries)
    done = []
    while state.selectExpr(f"count_if({unfinished})").first()[0]:
        done.append(state.where(f"NOT ({unfinished})"))
        state = written(_narrowed(rows, by, state.where(unfinished), entries, len(cols)), "quantiles")
    done.append(state)
    out = [f"CASE WHEN floor({at}) = ceil({at}) THEN _u{tag} ELSE _u{tag} + (_w{tag} - _u{tag}) * ({at} - floor({at})) END AS `{cols[i]}_q{tag.split('_')[1]}`"
           for i, tag, at in entries]
    return reduce(DataFrame.unionByName, done).selectExpr(*keys, *out)


def _narrowed(rows: DataFrame, by: list[str], state: DataFrame, entries: list[tuple[int, str, str]], n: int) -> DataFrame:
    """One round over the rows of groups that are not done: values found, narrower intervals for the others."""
    tracked = [f"_{x}{tag}" for _, tag, _ in entries for x in "uwlh"] + [f"_n{i}" for i in range(n)]
    rows, place = (keyed_join(rows, state, by), "") if by else (attach(rows, state.select(*tracked)), "_s.")
    counts = [f"any_value({place}{c}) AS {c}" for c in tracked]
    for i, tag, _ in entries:
        v, low, high = f"_v{i}", f"{place}_l{tag}", f"{place}_h{tag}"
        # An interval without a lower or an upper end is open there.
        inside = f"({v} IS NOT NULL AND coalesce({v} > {low}, true) AND coalesce({v} < {high}, true))"
        counts += [f"count_if({v} < {low}) AS _b{tag}", f"count_if({v} = {low}) AS _a{tag}", f"count_if({inside}) AS _m{tag}", f"count_if({v} = {high}) AS _e{tag}",
                   f"kll_sketch_agg_double(CASE WHEN {inside} THEN {v} END, {_SKETCH}) AS _s{tag}"]
    counted = rows.groupBy(*by).agg(*map(F.expr, counts))
    keys = [f"`{b}`" for b in by]
    carried = [*keys, *tracked]
    counted = counted.selectExpr(*carried, *[e for _, tag, _ in entries for e in (
        f"_b{tag} AS _below{tag}", f"_b{tag} + _a{tag} AS _start{tag}", f"_b{tag} + _a{tag} + _m{tag} AS _stop{tag}", f"_m{tag}",
        f"_b{tag} + _a{tag} + _m{tag} + CASE WHEN _l{tag} = _h{tag} THEN 0 ELSE _e{tag} END AS _top{tag}", f"{_spelled(f'_s{tag}', f'_m{tag}')} AS _q{tag}")])
    made = []
    for _, tag, at in entries:
        low, high, inside, read, below, start, stop, top = (f"{x}{tag}" for x in ("_l", "_h", "_m", "_q", "_below", "_start", "_stop", "_top"))
        for name, place in (("u", f"floor({at})"), ("w", f"ceil({at})")):
            exact = f"CASE WHEN {inside} <= {_HELD} THEN {_ranked(read, f'({place} - {start} + 0.5) / {inside}')} END"
            found = f"CASE WHEN {place} < {below} THEN NULL WHEN {place} < {start} THEN {low} WHEN {place} < {stop} THEN {exact} WHEN {place} < {top} THEN {high} END"
            made.append(f"coalesce(_{name}{tag}, {found}) AS _{name}{tag}")
        first, last, margin = f"floor({at})", f"ceil({at})", f"{_BRACKET} * {inside}"
        from_low = f"CASE WHEN {first} - {start} < {margin} THEN {low} ELSE {_ranked(read, f'({first} - {start}) / {inside} - {_BRACKET}')} END"
        to_high = f"CASE WHEN {stop} - {last} - 1 < {margin} THEN {high} ELSE {_ranked(read, f'({last} - {start} + 1) / {inside} + {_BRACKET}')} END"
        made += [f"CASE WHEN {first} < {below} THEN NULL WHEN {first} < {start} THEN {low} WHEN {first} < {stop} THEN {from_low} ELSE {high} END AS _l{tag}",
                 f"CASE WHEN {last} < {start} THEN {low} WHEN {last} < {stop} THEN {to_high} WHEN {last} < {top} THEN {high} END AS _h{tag}"]
    return counted.selectExpr(*keys, *[f"_n{i}" for i in range(n)], *made)
