"""Ten exploratory summaries over the marts and the core."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import attach_row, count_if, money, ratio
from ..functions.ranks import exact_quantiles
from ..schema import DEFAULT_SOURCE_SYSTEM
from .marts import is_sale, namespace


def mean(name: str, condition=None):
    """Average as exact sum over count of the non-null values, null when there are none."""
    value = F.col(name) if condition is None else F.when(condition, F.col(name))
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def sales_distribution(mart_daily_sales: DataFrame) -> DataFrame:
    """Spread of net sales over mart rows (day x country x class)."""
    edges = mart_daily_sales.agg(
        F.count(F.lit(1)).alias("day_count"),
        F.min("net_sales").alias("min_net_sales"),
        F.max("net_sales").alias("max_net_sales"),
    )
    levels = {"median_net_sales": 0.5, "p95_net_sales": 0.95}
    quantiles = exact_quantiles(mart_daily_sales, "net_sales", levels)
    return attach_row(edges, quantiles)


def customer_transaction_behavior(snapshot: DataFrame) -> DataFrame:
    active = F.col("frequency") > 0
    return snapshot.agg(
        F.count(F.lit(1)).alias("customer_count"),
        mean("frequency").alias("average_frequency"),
        mean("recency_days", active).alias("average_recency"),
        mean("tenure_days", active).alias("average_tenure"),
    )


def order_frequency(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("frequency").agg(F.count(F.lit(1)).alias("customer_count")).orderBy("frequency")


def spending_distribution(snapshot: DataFrame) -> DataFrame:
    levels = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    quantiles = exact_quantiles(snapshot, "monetary", levels)
    top = snapshot.agg(F.max("monetary").alias("max_monetary"))
    return attach_row(top, quantiles)


def product_popularity(
    lines: DataFrame, products: DataFrame, *, limit: int = 100, source_system: str = DEFAULT_SOURCE_SYSTEM
) -> DataFrame:
    """Best-selling codes by valid units; codes never sold come last."""
    sold = (
        namespace(lines, source_system)
        .groupBy("stock_code")
        .agg(
            F.sum(F.when(is_sale(), F.col("quantity"))).alias("units_sold"),
            money(F.sum(F.when(is_sale(), F.col("line_total")))).alias("gross_sales"),
        )
    )
    names = namespace(products, source_system).select("stock_code", "primary_description")
    return (
        sold.join(names, "stock_code")
        .select("stock_code", "primary_description", "units_sold", "gross_sales")
        .orderBy(F.col("units_sold").desc_nulls_last(), "stock_code")
        .limit(limit)
    )


def country_distribution(mart_daily_sales: DataFrame) -> DataFrame:
    return (
        mart_daily_sales.groupBy("country")
        .agg(money(F.sum("net_sales")).alias("net_sales"))
        .orderBy(F.desc("net_sales"), "country")
    )


def returns_and_cancellations(mart_daily_sales: DataFrame) -> DataFrame:
    return mart_daily_sales.agg(
        money(F.sum("return_value")).alias("return_value"),
        F.sum("units_returned").alias("units_returned"),
        count_if(F.col("return_value") < 0).alias("groups_with_returns"),
    )


def missing_customer_id(lines: DataFrame, *, source_system: str = DEFAULT_SOURCE_SYSTEM) -> DataFrame:
    guest = F.col("customer_id").isNull()
    return namespace(lines, source_system).agg(
        F.count(F.lit(1)).alias("line_count"),
        count_if(guest).alias("missing_customer_lines"),
        money(F.sum(F.when(guest, F.col("line_total")))).alias("missing_customer_ledger"),
    )


def temporal_transaction_patterns(mart_daily_sales: DataFrame) -> DataFrame:
    return (
        mart_daily_sales.groupBy("calendar_day")
        .agg(
            money(F.sum("net_sales")).alias("net_sales"),
            F.sum("distinct_invoices").alias("invoice_count"),
        )
        .orderBy("calendar_day")
    )


def sparsity_and_long_tail(snapshot: DataFrame, *, top: int = 100) -> DataFrame:
    """Positive spenders, the largest one, and the share of the ``top`` largest."""
    positive = snapshot.where(F.col("monetary") > 0)
    leaders = positive.orderBy(F.desc("monetary"), "customer_id").limit(top)
    leading = leaders.agg(F.sum("monetary")).scalar()
    totals = positive.agg(
        F.count(F.lit(1)).alias("positive_customers"),
        count_if(F.col("frequency") == 0).alias("zero_frequency_customers"),
        F.max("monetary").alias("top_customer_monetary"),
        F.sum("monetary").alias("_population"),
    )
    share = F.when(F.col("_population") != 0, ratio(leading, F.col("_population")))
    return totals.withColumn("top_100_share", share).drop("_population")


def run_eda(
    mart_daily_sales: DataFrame,
    snapshot: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    *,
    source_system: str = DEFAULT_SOURCE_SYSTEM,
) -> dict[str, DataFrame]:
    return {
        "sales_distribution": sales_distribution(mart_daily_sales),
        "customer_transaction_behavior": customer_transaction_behavior(snapshot),
        "order_frequency": order_frequency(snapshot),
        "spending_distribution": spending_distribution(snapshot),
        "product_popularity": product_popularity(lines, products, source_system=source_system),
        "country_distribution": country_distribution(mart_daily_sales),
        "returns_and_cancellations": returns_and_cancellations(mart_daily_sales),
        "missing_customer_id": missing_customer_id(lines, source_system=source_system),
        "temporal_transaction_patterns": temporal_transaction_patterns(mart_daily_sales),
        "sparsity_and_long_tail": sparsity_and_long_tail(snapshot),
    }
