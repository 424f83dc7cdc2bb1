"""Day, week and month buckets and gap-free calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def week_ending_monday(day: Column) -> Column:
    """The Monday that closes the week of ``day``; a Monday closes its own week."""
    return F.next_day(F.date_sub(day, 1), "MON")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def spine(df: DataFrame, column: str, step: str = "1 day") -> DataFrame:
    """Every bucket from the smallest to the largest value of a date column."""
    edges = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    return edges.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr(f"interval {step}"))).alias(column)
    )
