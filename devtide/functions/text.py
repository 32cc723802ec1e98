"""String rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADLINE_LENGTH = 250

# Fixed value: every character that ends a line.
LINE_END = r"\n\x{0b}\f\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}"


def headline(message: Column) -> Column:
    """First line of a message, cut to 250 characters; NULL for an empty message."""
    first = F.regexp_extract(message, f"^[^{LINE_END}]*", 0)
    return F.when(message != "", F.substring(first, 1, HEADLINE_LENGTH))


def safe_run_id(run_id: Column) -> Column:
    return F.regexp_replace(run_id, r"[^A-Za-z0-9_.-]", "_")


def repository_slug(full_name: Column) -> Column:
    return F.replace(full_name, F.lit("/"), F.lit("__"))
