"""Set operations and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loomtab.operators.ordered import row_index
from loomtab.operators.windows import top_per_group


def first_per_key(df: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    """First row per key in the given order (``dropDuplicates`` would keep any row)."""
    return top_per_group(df, keys, [F.col(c).asc() for c in position], 1)


def distinct_entries(col: Column | str, entry_schema: str) -> Column:
    """Equal objects inside a JSON list removed, first order kept."""
    col = F.col(col) if isinstance(col, str) else col
    return F.array_distinct(F.from_json(col, f"array<{entry_schema}>"))


def contiguous_ids(declared: DataFrame, used: DataFrame, key: str, name: str) -> DataFrame:
    """(key, new_id, name): declared and used ids sorted and numbered from 0; stub names for undeclared ones."""
    every = declared.select(key).unionByName(used.select(key)).where(F.col(key).isNotNull()).distinct()
    named = row_index(every, [], [key], "new_id").join(declared.select(key, name).dropDuplicates([key]), key, "left")
    return named.withColumn(name, F.coalesce(name, F.concat(F.lit("class_"), F.col(key).cast("string"))))
