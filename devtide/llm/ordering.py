"""Numbers along an order, without a task that sees a whole group.

Rows are sorted by ranges over all tasks; each numbers the rows it has, and what the tasks before
it hold of the same group is added afterwards. One line a task reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

_KEY, _PART, _AT = "__key", "__part", "__at"


def numbered(df: DataFrame, order: list[Column], name: str, key: str | None = None) -> DataFrame:
    """``df`` with ``name``: the place (from 0) of a row in ``order`` among those of its ``key``
    (a long column without nulls; None: among all rows). ``order`` is to tell rows apart but for
    equal ones. The result is stored."""
    kept = [c for c in df.columns if c != name]
    rows = df.select(*kept, (F.col(key) if key else F.lit(0)).cast("long").alias(_KEY))
    sort = [F.col(_KEY), *order]
    ranged = rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(_KEY)).to_numpy()
            places = np.arange(len(keys))
            fresh = np.ones(len(keys), bool)
            fresh[1:] = keys[1:] != keys[:-1]
            if len(keys):
                fresh[0] = keys[0] != last
                start = np.maximum.accumulate(np.where(fresh, places, -1))
                # A run that began in an earlier batch goes on from there.
                places = np.where(start < 0, places + count, places - start)
                last, count = keys[-1], int(places[-1]) + 1
            parts = pa.array(np.full(len(keys), part, np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, parts, pa.array(places.astype(np.int64))], [*batch.schema.names, _PART, _AT]
            )

    counted = shared.stored(shared.arrow_map(ranged, work, f"{schema}, {_PART} long, {_AT} long"), "numbered")
    ends = counted.groupBy(_PART).agg(
        F.min(_KEY).alias("first"), F.max(F.struct(_KEY, _AT)).alias("last")
    )
    offsets, before, held = [], None, 0
    for row in sorted(ends.collect()):
        held = held if row["first"] == before else 0
        if held:
            offsets.append((row[_PART], row["first"], held))
        before, size = row["last"][0], row["last"][1] + 1
        held = held + size if row["first"] == before else size
    places = F.col(_AT)
    if offsets:
        spark = df.sparkSession
        shift = spark.createDataFrame(offsets, f"{_PART} long, {_KEY} long, __before long")
        # One row a task at most.
        counted = counted.join(F.broadcast(shift), [_PART, _KEY], "left")
        places = places + F.coalesce("__before", F.lit(0))
    return counted.select(*kept, places.alias(name))
