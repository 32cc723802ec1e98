"""Keep-first and keep-last by key.

Both are aggregations rather than ranked windows: the survivor of a key is found
with partial aggregation before the shuffle, so a key with very many copies is
reduced where it is read and never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _survivor(df: DataFrame, keys: Sequence[str], order: Sequence[Column], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    # The payload follows the order columns in the struct: ties on the order are
    # broken by value, which keeps the result the same on every run.
    ranked = F.struct(
        F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("order"),
        F.struct(*rest).alias("row"),
    )
    best = df.groupBy(*keys).agg(pick(ranked).alias("best"))
    return best.select(*[c if c in keys else F.col(f"best.row.{c}").alias(c) for c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return _survivor(df, keys, order, F.min)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return _survivor(df, keys, order, F.max)
