"""The three marts over the relational core.

Lines are reduced to one row per invoice (and class or customer) before they meet the invoice
headers.  Because a header has exactly one day and country, distinct-invoice counts become
plain sums, and a very large invoice is collapsed by the map-side combine before any join.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import count_if, money, sum_if
from ..schema import DEFAULT_SOURCE_SYSTEM


def is_sale() -> Column:
    return F.col("is_valid_sale")


def is_merchandise_return() -> Column:
    return F.col("is_cancellation") & ~F.col("is_non_product")


def namespace(df: DataFrame, source_system: str) -> DataFrame:
    return df.where(F.col("source_system") == source_system)


def eligible_lines(lines: DataFrame, source_system: str = DEFAULT_SOURCE_SYSTEM) -> DataFrame:
    """Valid sales and merchandise returns of one namespace."""
    return namespace(lines, source_system).where(
        ~F.col("is_inventory_adjustment") & (is_sale() | is_merchandise_return())
    )


def header_days(invoices: DataFrame, source_system: str) -> DataFrame:
    return namespace(invoices, source_system).select(
        "invoice_number", F.to_date("invoice_date").alias("calendar_day"), "country"
    )


def eligible_ledger(
    lines: DataFrame, invoices: DataFrame, source_system: str = DEFAULT_SOURCE_SYSTEM
) -> DataFrame:
    """Eligible lines with their header's day and country (the header date, not the line's)."""
    return eligible_lines(lines, source_system).drop("invoice_date").join(
        header_days(invoices, source_system), "invoice_number"
    )


def _per_invoice(rows: DataFrame, *keys: str) -> DataFrame:
    """Measures of eligible lines per invoice; each line is a sale or a return, never both."""
    total, quantity = F.col("line_total"), F.col("quantity")
    return rows.groupBy("invoice_number", *keys).agg(
        sum_if(total, is_sale()).alias("sale_value"),
        sum_if(total, is_merchandise_return()).alias("return_value"),
        count_if(is_sale()).alias("sale_lines"),
        sum_if(quantity, is_sale()).alias("units_sold"),
        (-sum_if(quantity, is_merchandise_return())).alias("units_returned"),
    )


def daily_sales(
    lines: DataFrame,
    invoices: DataFrame,
    products: DataFrame,
    *,
    source_system: str = DEFAULT_SOURCE_SYSTEM,
) -> DataFrame:
    """Sales, returns and units per day, country and merchandise class."""
    classes = namespace(products, source_system).select("stock_code", "is_physical_merchandise")
    parts = _per_invoice(
        eligible_lines(lines, source_system).join(classes, "stock_code"), "is_physical_merchandise"
    )
    return (
        parts.join(header_days(invoices, source_system), "invoice_number")
        .groupBy("calendar_day", "country", "is_physical_merchandise")
        .agg(
            money(F.sum("sale_value")).alias("gross_sales"),
            money(F.sum("sale_value")).alias("valid_sales_revenue"),
            money(F.sum("return_value")).alias("return_value"),
            money(F.sum("sale_value") + F.sum("return_value")).alias("net_sales"),
            count_if(F.col("sale_lines") > 0).alias("distinct_invoices"),
            F.sum("units_sold").alias("units_sold"),
            F.sum("units_returned").alias("units_returned"),
        )
    )


def customer_daily(
    lines: DataFrame, invoices: DataFrame, *, source_system: str = DEFAULT_SOURCE_SYSTEM
) -> DataFrame:
    """Orders and spend per identified customer and day."""
    known = eligible_lines(lines, source_system).where(F.col("customer_id").isNotNull())
    return (
        _per_invoice(known, "customer_id")
        .join(header_days(invoices, source_system), "invoice_number")
        .groupBy("customer_id", "calendar_day")
        .agg(
            count_if(F.col("sale_lines") > 0).alias("order_frequency"),
            money(F.sum("sale_value")).alias("gross_spend"),
            money(F.sum("return_value")).alias("return_value"),
            money(F.sum("sale_value") + F.sum("return_value")).alias("net_spend"),
            F.sum("sale_lines").alias("valid_transaction_count"),
        )
    )


def customer_lifetime(daily: DataFrame) -> DataFrame:
    """Per-customer totals of the customer-day mart; an invoice has one day, so orders add up."""
    bought = F.when(F.col("order_frequency") > 0, F.col("calendar_day"))
    return daily.groupBy("customer_id").agg(
        F.min(bought).alias("first_purchase_date"),
        F.max(bought).alias("last_purchase_date"),
        F.sum("order_frequency").alias("orders"),
        F.sum("gross_spend").alias("gross"),
        F.sum("net_spend").alias("net"),
    )


def describe_customers(customers: DataFrame, lifetime: DataFrame, as_of: date) -> DataFrame:
    """All customers with recency, frequency, value and tenure measured at ``as_of``."""
    anchor = F.lit(as_of)
    orders = F.coalesce("orders", F.lit(0))
    return customers.join(lifetime, "customer_id", "left").select(
        "customer_id",
        "primary_country",
        F.datediff(anchor, "last_purchase_date").alias("recency_days"),
        orders.alias("frequency"),
        money(F.coalesce("net", F.lit(0))).alias("monetary"),
        F.when(orders > 0, money(F.round(money(F.col("gross")) / orders, 2))).alias("average_order_value"),
        F.datediff(anchor, "first_purchase_date").alias("tenure_days"),
        "first_purchase_date",
        "last_purchase_date",
    )


def customer_snapshot(
    customers: DataFrame,
    lines: DataFrame,
    invoices: DataFrame,
    *,
    reference_date: date,
    source_system: str = DEFAULT_SOURCE_SYSTEM,
    daily: DataFrame | None = None,
) -> DataFrame:
    """One row per customer of the namespace, buyers or not; ``daily`` is the customer-day mart of the same lines, if there is one."""
    if daily is None:
        daily = customer_daily(lines, invoices, source_system=source_system)
    return describe_customers(namespace(customers, source_system), customer_lifetime(daily), reference_date)
