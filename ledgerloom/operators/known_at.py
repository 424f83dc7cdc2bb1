"""Customer attributes as they were known on a day.

A customer's country is the one most of its lines name, the one seen last on a tie. It changes as lines come in. The change table holds each
leading country with the days it led, from running counts per country: a country's count and last position never
fall, so the leader after a day is the running maximum over all (count, last position, country) up to it. Nothing but one row per customer, day
and country is ever ordered. Looking up many customers and days is one join on the customer with a range of days.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import money
from ..schema import FEATURE_COLUMNS
from .core import core_rows
from .features import validate_features


def country_changes(clean: DataFrame) -> DataFrame:
    """(customer_id, primary_country, known_from, known_to): the leading country from a day on, up to but not on another; null for ever.

    Lines without a date cannot be placed and lines without a country count for the empty one, as in the customer dimension.
    """
    rows = core_rows(clean).where(F.col("customer_id").isNotNull() & F.col("invoice_date").isNotNull())
    days = rows.groupBy("customer_id", F.to_date("invoice_date").alias("day"), "country").agg(
        F.count(F.lit(1)).alias("n"), F.max("source_order").alias("last_order")
    )
    so_far = Window.partitionBy("customer_id", "country").orderBy("day")
    totals = days.select(
        "customer_id", "day", F.struct(F.sum("n").over(so_far).alias("n"), F.max("last_order").over(so_far).alias("last_order"), "country").alias("rank")
    )
    known = totals.withColumn("rank", F.when(F.col("rank.country").isNotNull(), F.col("rank")))
    daily = known.groupBy("customer_id", "day").agg(F.max("rank").alias("rank"))
    by_day = Window.partitionBy("customer_id").orderBy("day")
    leading = daily.select("customer_id", "day", F.coalesce(F.max("rank").over(by_day)["country"], F.lit("")).alias("primary_country"))
    before = F.lag("primary_country").over(by_day)
    changes = leading.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("_before") != F.col("primary_country")))
    return changes.select(
        "customer_id", "primary_country", F.col("day").alias("known_from"), F.lead("day").over(by_day).alias("known_to")
    )


def attributes_at(changes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (customer_id, as_of, ...) with the country known on each day; customers not known by then are left out."""
    held = (F.col("known_from") <= F.col("as_of")) & (F.col("known_to").isNull() | (F.col("as_of") < F.col("known_to")))
    return wanted.join(changes, "customer_id").where(held).drop("known_from", "known_to")


def features_at(mart_customer_daily: DataFrame, changes: DataFrame, days: Iterable[date], *, checked: bool = True) -> DataFrame:
    """Customer features for several reference days in one pass, with nothing that was not known on the day.

    One row per day and customer known by then. The customer-day mart is read once: each of its rows counts for the days from its own on.
    """
    asked = F.explode(F.array(*[F.lit(d) for d in sorted(set(days))])).alias("as_of")
    customers = changes.select("customer_id").distinct().select("customer_id", asked)
    described = attributes_at(changes, customers)
    activity = mart_customer_daily.select("*", asked).where(F.col("calendar_day") <= F.col("as_of"))
    bought = F.when(F.col("order_frequency") > 0, F.col("calendar_day"))
    lifetime = activity.groupBy("customer_id", "as_of").agg(
        F.min(bought).alias("first_day"), F.max(bought).alias("last_day"), F.sum("order_frequency").alias("orders"),
        F.sum("gross_spend").alias("gross"), F.sum("net_spend").alias("net"),
    )
    orders = F.coalesce("orders", F.lit(0))
    features = described.join(lifetime, ["customer_id", "as_of"], "left").select(
        "customer_id", "primary_country", F.col("as_of").alias("reference_date"),
        F.datediff("as_of", "last_day").alias("recency_days"), orders.alias("frequency"),
        money(F.coalesce("net", F.lit(0))).alias("monetary"),
        F.when(orders > 0, money(F.round(money(F.col("gross")) / orders, 2))).alias("average_order_value"),
        F.datediff("as_of", "first_day").alias("tenure_days"),
    ).select(*FEATURE_COLUMNS)
    if checked:
        for day in sorted(set(days)):
            validate_features(features.where(F.col("reference_date") == F.lit(day)))
    return features
