"""The generated calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The range the calendar covers unless told otherwise.
CALENDAR_START, CALENDAR_END = date(2008, 1, 1), date(2035, 12, 31)


def calendar_days(
    spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END
) -> DataFrame:
    """One row per day with its calendar attributes; weeks are ISO weeks."""
    span = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    d = F.col("full_date")
    return (
        spark.range(1)
        .select(F.explode(span).alias("full_date"))
        .select(
            (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_key"),
            d,
            F.year(d).alias("year"),
            F.quarter(d).alias("quarter"),
            F.month(d).alias("month"),
            F.date_format(d, "MMMM").alias("month_name"),
            F.extract(F.lit("YEAROFWEEK"), d).alias("iso_year"),
            F.weekofyear(d).alias("iso_week"),
            F.trunc(d, "week").alias("week_start_date"),
            (F.weekday(d) + 1).alias("day_of_week"),
            F.date_format(d, "EEEE").alias("day_name"),
            (F.weekday(d) >= 5).alias("is_weekend"),
        )
    )
