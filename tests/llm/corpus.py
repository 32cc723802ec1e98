"""Small corpora for the tests: words that a seed draws, and the cases every operator must bear."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

SYLLABLES = {
    "aa": "ka lo mi tu ren sol va di".split(),
    "bb": "sch ung ein ver keit ach zu pf".split(),
}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = r"[^\x20\x09-\x0D]+"


def words(rng: random.Random, n: int, lang: str = "aa") -> list[str]:
    return ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n)]


def text(rng: random.Random, n: int, lang: str = "aa") -> str:
    return " ".join(words(rng, n, lang))


def lowered(value: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), value or "")


def edge_rows() -> list[tuple]:
    """Nulls in any column, empty and blank texts, a very long text, equal rows, odd signs."""
    long = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))
    return [
        (1, None, "aa", "s", 0),
        (2, "", "aa", "s", 0),
        (3, " \t\n\x0b ", None, "s", 5),
        (4, long, "aa", "s", len(long)),
        (5, "lo ka mi tu ren sol", "aa", None, None),
        (5, "lo ka mi tu ren sol", "aa", None, None),
        (None, "lo ka mi tu ren sol", "aa", "s", 19),
        (6, "é中😀  \x00 Ünï", None, None, 9),
        (7, "x", "bb", "s", 1),
        (8, "!!! ... ???", "bb", "s", 11),
    ]


def documents(spark: SparkSession, rows: list[tuple], clashing: bool = False) -> DataFrame:
    """``rows`` as documents; with ``clashing``, more columns named like those of the results."""
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        for name in ("score", "ids", "node", "spans", "labels", "component", "key", "decoded"):
            df = df.selectExpr("*", f"'{name}' as {name}")
    return df


def save(df: DataFrame, folder: str, table: str = "documents") -> str:
    df.write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
    return str(folder)
