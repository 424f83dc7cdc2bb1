"""Mergeable summaries per day: value quantiles and sets of customers for any period, without the lines.

A sketch mart holds, per day, a KLL sketch of a value and a theta sketch of the customers seen. A period's answer merges the sketches
of its days; the work and the size depend on the number of days and on the sketches' fixed sizes, not on the lines. Quantiles have a
rank error of at most ``RANK_ERROR`` of the period's values; distinct counts are exact up to 2**SET_BITS customers and
within ``SET_ERROR`` of the true number beyond (three standard errors).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KLL_SIZE = 400
RANK_ERROR = 0.02
SET_BITS = 12
SET_ERROR = 3 / (1 << (SET_BITS // 2))


def daily_value_sketches(rows: DataFrame, day: str, value: str, keys: Iterable[str] = ()) -> DataFrame:
    """(keys, day, values): one KLL sketch per day and key; null values are left out."""
    present = rows.where(F.col(value).isNotNull())
    return present.groupBy(*keys, F.col(day).alias("day")).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_SIZE)).alias("values"))


def daily_customer_sketches(rows: DataFrame, day: str, customer: str = "customer_id", keys: Iterable[str] = ()) -> DataFrame:
    """(keys, day, customers): one theta sketch per day and key; null customers are left out."""
    present = rows.where(F.col(customer).isNotNull())
    return present.groupBy(*keys, F.col(day).alias("day")).agg(F.theta_sketch_agg(customer, SET_BITS).alias("customers"))


def period_quantiles(sketches: DataFrame, period: Column, levels: dict[str, float], keys: Iterable[str] = ()) -> DataFrame:
    """(keys, period, value_count, one column per level) from daily value sketches."""
    merged = sketches.groupBy(*keys, period.alias("period")).agg(F.kll_merge_agg_double("values").alias("values"))
    return merged.select(
        *keys, "period", F.kll_sketch_get_n_double("values").alias("value_count"),
        *[F.kll_sketch_get_quantile_double("values", F.lit(float(level))).alias(name) for name, level in levels.items()],
    )


def period_customers(sketches: DataFrame, period: Column, keys: Iterable[str] = ()) -> DataFrame:
    """(keys, period, customers, active_customers): the union of the days' customers and its size."""
    merged = sketches.groupBy(*keys, period.alias("period")).agg(F.theta_union_agg("customers", SET_BITS).alias("customers"))
    return merged.withColumn("active_customers", F.theta_sketch_estimate("customers"))


def retained_customers(periods: DataFrame) -> DataFrame:
    """(period, next_period, retained): customers of a period that are active in the next one as well.

    ``periods`` has one row per period, which bounds the window; the overlap comes from the sketches alone.
    """
    order = Window.partitionBy(F.lit(0)).orderBy("period")
    following = periods.select("period", "customers", F.lead("period").over(order).alias("next_period"), F.lead("customers").over(order).alias("next"))
    both = following.where(F.col("next").isNotNull())
    return both.select("period", "next_period", F.theta_sketch_estimate(F.theta_intersection("customers", "next")).alias("retained"))


def rank_error(rows: DataFrame, period: Column, value: str, quantiles: DataFrame, levels: dict[str, float]) -> DataFrame:
    """(period, rank_error): how far the share of values up to each estimate is from its level, at worst, over all rows.

    A value that occurs often covers a range of ranks; its error is that of the nearest end.
    """
    joined = rows.select(period.alias("period"), F.col(value).cast("double").alias("value")).where(F.col("value").isNotNull()).join(quantiles, "period")
    total = F.count(F.lit(1))
    errors = []
    for name, level in levels.items():
        below, upto = F.count(F.when(F.col("value") < F.col(name), 1)) / total, F.count(F.when(F.col("value") <= F.col(name), 1)) / total
        errors.append(F.greatest(below - level, level - upto, F.lit(0.0)))
    worst = F.greatest(*errors) if len(errors) > 1 else errors[0]
    return joined.groupBy("period").agg(worst.alias("rank_error"))
