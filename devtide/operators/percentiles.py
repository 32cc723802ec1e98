"""Exact interpolated percentiles of groups that do not fit in one task.

The built-in exact percentile keeps every distinct value of a group in one
aggregation buffer, so one very large group ends up in one task. Here equal
values are counted first, and the ranks that are needed are then located digit
by digit: each level looks only at a histogram whose length is bounded by the
digit width, never by the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranks(total: Column, probabilities: Mapping[str, float]) -> Column:
    """The two neighbouring zero-based ranks of every probability."""
    wanted = []
    for name, p in probabilities.items():
        spot = F.lit(p) * (total - 1)
        for side, rank in (("low", F.floor(spot)), ("high", F.ceil(spot))):
            wanted.append(
                F.struct(
                    F.lit(name).alias("name"), F.lit(side).alias("side"), rank.alias("rank")
                )
            )
    return F.array(*wanted)


def _running(partition: Sequence[str]) -> Column:
    window = Window.partitionBy(*partition).orderBy("_digit")
    return F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def value_counts(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    shifts: Sequence[int],
    sums: Sequence[str] | None = None,
) -> DataFrame:
    """Occurrences ``n`` of every value per group, with the prefixes of the value.

    ``shifts`` are the bit positions at which a value is cut into digits, most
    significant first: ``(34, 17)`` makes three digits. NULL keys and values are
    dropped here, once, so that every later use reads the same shuffle.

    With ``sums`` these columns are added up in the same shuffle, and rows without a value
    stay, as one value of their own; ``exact_percentiles`` passes over them.
    """
    prefixes = [f"_p{i}" for i in range(len(shifts))]
    cut = {p: F.shiftright(value, shift) for p, shift in zip(prefixes, shifts, strict=True)}
    columns = [*keys, value, *prefixes]
    known = " AND ".join(f"{c} IS NOT NULL" for c in (columns if sums is None else keys))
    added = [F.sum(c).alias(c) for c in sums or ()]
    return (
        rows.withColumns(cut).filter(known).groupBy(*columns).agg(F.count("*").alias("n"), *added)
    )


def exact_percentiles(
    counts: DataFrame, keys: Sequence[str], value: str, probabilities: Mapping[str, float]
) -> DataFrame:
    """Percentiles of a bigint column per group, linearly interpolated, as doubles.

    ``counts`` comes from ``value_counts``.
    """
    keys = list(keys)
    counts = counts.filter(F.col(value).isNotNull())
    digits = [c for c in counts.columns if c.startswith("_p")] + [value]
    histogram = counts.groupBy(*keys, F.col(digits[0]).alias("_digit")).agg(F.sum("n").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(*keys))
    ranked = histogram.withColumns({"_cum": _running(keys), "_total": total})
    start = F.col("_cum") - F.col("_n")
    here = F.filter(
        _ranks(F.col("_total"), probabilities),
        lambda t: (t["rank"] >= start) & (t["rank"] < F.col("_cum")),
    )
    picks = ranked.select(
        *keys, "_total", "_digit", start.alias("_start"), F.explode(here).alias("_t")
    ).select(
        *keys,
        F.col("_digit").alias(digits[0]),
        F.col("_t.name").alias("_name"),
        F.col("_t.side").alias("_side"),
        (F.col("_t.rank") - F.col("_start")).alias("_rank"),
        "_total",
    )
    target = [*keys, "_name", "_side"]
    for prefix, digit in zip(digits, digits[1:], strict=False):
        histogram = (
            counts.join(picks, [*keys, prefix])
            .groupBy(*target, F.col(digit).alias("_digit"))
            .agg(
                F.sum("n").alias("_n"),
                F.first("_rank").alias("_rank"),
                F.first("_total").alias("_total"),
            )
        )
        start = F.col("_cum") - F.col("_n")
        picks = (
            histogram.withColumn("_cum", _running(target))
            .filter((F.col("_rank") >= start) & (F.col("_rank") < F.col("_cum")))
            .select(
                *target,
                F.col("_digit").alias(digit),
                (F.col("_rank") - start).alias("_rank"),
                "_total",
            )
        )
    found = []
    for name, p in probabilities.items():
        spot = F.lit(p) * (F.max("_total") - 1)
        low, high = (
            F.max(F.when((F.col("_name") == name) & (F.col("_side") == side), F.col(value)))
            for side in ("low", "high")
        )
        found += [
            low.cast("double").alias(f"_{name}_low"),
            high.cast("double").alias(f"_{name}_high"),
            (spot - F.floor(spot)).alias(f"_{name}_part"),
        ]
    wide = picks.groupBy(*keys).agg(*found)
    between = {
        n: F.col(f"_{n}_low") + F.col(f"_{n}_part") * (F.col(f"_{n}_high") - F.col(f"_{n}_low"))
        for n in probabilities
    }
    return wide.select(*keys, *[column.alias(n) for n, column in between.items()])
