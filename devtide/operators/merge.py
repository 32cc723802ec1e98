"""Upsert of one DataFrame into another, with a guard per matched row."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Setter = Callable[[Column, Column], Column]


def take_new(*columns: str) -> dict[str, Setter]:
    """Setters that overwrite the named columns with the incoming values."""
    return {c: (lambda old, new, c=c: new[c]) for c in columns}


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, Setter],
    guard: Setter | None = None,
) -> DataFrame:
    """Rows of ``target`` updated and extended by ``source``.

    A row only in the target stays, a row only in the source is inserted. On a
    match the columns in ``update`` are set from (old row, new row) where the
    guard holds; every other column keeps its old value. ``source`` has the
    columns of ``target`` and at most one row per key.
    """
    old_side = target.select(*keys, F.struct(*target.columns).alias("old"))
    new_side = source.select(*keys, F.struct(*target.columns).alias("new"))
    both = old_side.join(new_side, list(keys), "full")
    old, new = F.col("old"), F.col("new")
    applies = F.coalesce(guard(old, new), F.lit(False)) if guard else F.lit(True)
    out = []
    for name in target.columns:
        matched = old[name]
        if name in update:
            matched = F.when(applies, update[name](old, new)).otherwise(old[name])
        value = (
            F.when(old.isNull(), new[name]).when(new.isNull(), old[name]).otherwise(matched)
        )
        out.append(value.alias(name))
    return both.select(*out)
