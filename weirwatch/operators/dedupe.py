"""One row per key, by load order.

A key may repeat in a large part of the rows, so the winner is an aggregate:
each task keeps one row per key before anything is shuffled. Rows with a null
key never collide and are all kept.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _has_keys(keys: list[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def _winners(df: DataFrame, keys: list[str], order: str | Column, last: bool) -> DataFrame:
    order = F.col(order) if isinstance(order, str) else order
    pick = F.max if last else F.min
    # Compared by the order first; the row itself breaks ties in it.
    ordered = F.struct(order.alias("o"), F.struct(*[c for c in df.columns if c not in keys]).alias("row"))
    kept = (
        df.where(_has_keys(keys))
        .groupBy(*keys)
        .agg(pick(ordered).alias("_best"))
        .select(*keys, "_best.row.*")
    )
    keyless = df.where(~_has_keys(keys))
    return kept.select(*df.columns).unionByName(keyless)


def last_write_wins(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    return _winners(df, keys, order, last=True)


def first_write_wins(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    return _winners(df, keys, order, last=False)


def merge_rows(existing: DataFrame, incoming: DataFrame, keys: list[str], keep: str) -> DataFrame:
    """Rows of a table after an upsert of already distinct incoming rows.

    ``last``: incoming rows replace existing ones of the same key. ``first``:
    existing rows stay. Null keys match nothing, so such rows always add up.
    """
    if keep == "last":
        stay = existing.join(incoming.select(*keys).distinct(), keys, "left_anti")
        return stay.unionByName(incoming.select(*existing.columns))
    if keep == "first":
        new = incoming.join(existing.select(*keys).distinct(), keys, "left_anti")
        return existing.unionByName(new.select(*existing.columns))
    raise ValueError(f"unknown keep: {keep}")
