"""Every operator as a query over the given tables, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle
from .analytics import QUERIES
from .binding import AS_OF, BoundStar
from .operator_oracle import OPERATORS
from .operator_queries import QUERIES_BY_OPERATOR

Runner = Callable[[SparkSession, str], DataFrame]


def _analytics(name: str) -> Runner:
    return lambda spark, sf_dir: QUERIES[name](BoundStar(spark, sf_dir), AS_OF)


def queries() -> dict[str, Runner]:
    return {name: _analytics(name) for name in QUERIES} | QUERIES_BY_OPERATOR


def oracle_sql() -> dict[str, str]:
    return oracle.ANALYTICS | OPERATORS
