"""Contract metrics over invoice lines, and the ledger classification reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import spine, week_ending_monday
from ..functions.expressions import attach_row, count_if, money, ratio, sum_if
from ..functions.ranks import column_limits
from .marts import header_days, is_merchandise_return, is_sale


def _window(lines: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Lines whose own date lies in the closed day range."""
    day = F.to_date("invoice_date")
    if start is not None:
        lines = lines.where(day >= F.lit(start))
    if end is not None:
        lines = lines.where(day <= F.lit(end))
    return lines


def gross_sales(lines, start=None, end=None, by=()) -> DataFrame:
    value = money(sum_if(F.col("line_total"), is_sale())).alias("gross_merchandise_sales")
    return _window(lines, start, end).groupBy(*by).agg(value)


def return_value(lines, start=None, end=None, by=()) -> DataFrame:
    value = money(sum_if(F.col("line_total"), is_merchandise_return())).alias("merchandise_return_value")
    return _window(lines, start, end).groupBy(*by).agg(value)


def net_revenue(lines, start=None, end=None, by=()) -> DataFrame:
    value = sum_if(F.col("line_total"), is_sale() | is_merchandise_return())
    return _window(lines, start, end).groupBy(*by).agg(money(value).alias("net_merchandise_revenue"))


def valid_orders(lines, start=None, end=None, by=()) -> DataFrame:
    sold = _window(lines, start, end).where(is_sale())
    return sold.groupBy(*by).agg(F.countDistinct("invoice_number").alias("valid_order_count"))


def average_order_value(lines, start=None, end=None, by=()) -> DataFrame:
    sold = _window(lines, start, end).where(is_sale())
    return sold.groupBy(*by).agg(
        F.try_divide(
            F.sum("line_total").cast("double"), F.countDistinct("invoice_number").cast("double")
        ).alias("average_order_value")
    )


def customer_population(customers: DataFrame) -> DataFrame:
    return customers.agg(F.countDistinct("customer_id").alias("total_customer_count"))


def active_customers(lines, start=None, end=None) -> DataFrame:
    sold = _window(lines, start, end).where(is_sale())
    return sold.agg(F.countDistinct("customer_id").alias("active_customers"))


def repeat_purchase_rate(lines, start=None, end=None) -> DataFrame:
    """Share of buyers with two or more valid orders (non-buyers are not counted)."""
    orders = (
        _window(lines, start, end)
        .where(is_sale() & F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.countDistinct("invoice_number").alias("orders"))
    )
    return orders.agg(
        F.count(F.lit(1)).alias("buyers"),
        count_if(F.col("orders") >= 2).alias("repeat_buyers"),
    ).withColumn("repeat_purchase_rate", ratio(F.col("repeat_buyers"), F.col("buyers")))


def _special_service(code: Column) -> Column:
    return code.startswith("GIFT") | code.startswith("TEST") | (code == "CRUK")


def reconciliation_tree(lines: DataFrame) -> DataFrame:
    """Ledger value by side and category with subtotals and the grand total (null = all)."""
    cancelled, fee = F.col("is_cancellation"), F.col("is_non_product")
    bad_debt = F.col("is_bad_debt_adjustment")
    category = (
        F.when(bad_debt & (F.col("line_total") >= 0), "bad_debt_credit")
        .when(bad_debt, "bad_debt_write_off")
        .when(F.col("is_inventory_adjustment"), "inventory_shrinkage")
        .when(cancelled & ~fee, "merchandise_returns")
        .when(cancelled, "service_and_fee_reversals")
        .when(is_sale(), "merchandise_sales")
        .when(fee & _special_service(F.col("stock_code")), "vouchers_and_special_services")
        .when(fee, "services_and_freight")
        .when(F.col("is_price_zero"), "zero_price_items")
        .otherwise("other")
    )
    deductions = [
        "bad_debt_write_off", "inventory_shrinkage", "merchandise_returns", "service_and_fee_reversals",
    ]
    side = F.when(F.col("category").isin(deductions), "deductions").otherwise("gross_lines")
    return (
        lines.withColumn("category", category)
        .withColumn("side", side)
        .rollup("side", "category")
        .agg(F.count(F.lit(1)).alias("line_count"), money(F.sum("line_total")).alias("amount"))
    )


def transaction_taxonomy(lines: DataFrame) -> DataFrame:
    """Mutually exclusive transaction classes with line count and value."""
    kind = (
        F.when(is_sale(), "VALID_SALE")
        .when(F.col("is_cancellation"), "CANCELLATION")
        .when(F.col("is_bad_debt_adjustment"), "BAD_DEBT_ADJUSTMENT")
        .when(F.col("is_negative_quantity"), "NEGATIVE_QTY_NON_C")
        .when(F.col("is_non_product"), "NON_PRODUCT_SERVICE")
        .when(F.col("is_price_zero") & (F.col("quantity") > 0), "ZERO_PRICE_POSITIVE")
        .otherwise("OTHER")
    )
    return lines.groupBy(kind.alias("transaction_class")).agg(
        F.count(F.lit(1)).alias("line_count"), money(F.sum("line_total")).alias("amount")
    )


def flag_extremes(clean: DataFrame, level: float = 0.999) -> DataFrame:
    """Mark quantities and prices beyond the given quantile of the whole ledger."""
    limits = column_limits(clean, {"_size_limit": F.abs("Quantity"), "_price_limit": F.col("Price")}, level)
    return attach_row(clean, limits).withColumns(
        {
            "is_extreme_quantity": F.abs("Quantity") > F.col("_size_limit"),
            "is_extreme_price": F.col("Price") > F.col("_price_limit"),
        }
    ).drop("_size_limit", "_price_limit")


def demand_target(lines: DataFrame, frequency: str = "Daily") -> DataFrame:
    """Valid units per stock code and day, or week ending Monday."""
    day = F.to_date("invoice_date")
    bucket = week_ending_monday(day) if frequency == "Weekly" else day
    return (
        lines.where(is_sale())
        .groupBy("stock_code", bucket.alias("bucket"))
        .agg(F.sum("quantity").alias("units"))
    )


def date_dimension(lines: DataFrame) -> DataFrame:
    """One row per calendar day between the first and last line."""
    days = lines.select(F.to_date("invoice_date").alias("calendar_day"))
    return spine(days, "calendar_day").select(
        "calendar_day",
        F.year("calendar_day").alias("year"),
        F.quarter("calendar_day").alias("quarter"),
        F.month("calendar_day").alias("month"),
        F.dayofmonth("calendar_day").alias("day_of_month"),
        (F.weekday("calendar_day") + 1).alias("iso_weekday"),
    )


def daily_returns_and_fees(lines: DataFrame, invoices: DataFrame, source_system: str) -> DataFrame:
    """Returned orders and service-fee revenue per header day and country."""
    parts = (
        lines.where((F.col("source_system") == source_system) & ~F.col("is_inventory_adjustment"))
        .groupBy("invoice_number")
        .agg(
            F.bool_or(is_merchandise_return()).alias("returned"),
            sum_if(F.col("line_total"), F.col("is_non_product")).alias("fees"),
        )
    )
    return (
        parts.join(header_days(invoices, source_system), "invoice_number")
        .groupBy("calendar_day", "country")
        .agg(
            count_if(F.col("returned")).alias("returned_orders_count"),
            money(F.sum("fees")).alias("service_fee_revenue"),
        )
    )


def customer_daily_items(lines: DataFrame, invoices: DataFrame, source_system: str) -> DataFrame:
    """Valid units bought per customer and header day."""
    bought = (
        lines.where((F.col("source_system") == source_system) & is_sale() & F.col("customer_id").isNotNull())
        .groupBy("invoice_number", "customer_id")
        .agg(F.sum("quantity").alias("items"))
    )
    return (
        bought.join(header_days(invoices, source_system), "invoice_number")
        .groupBy("customer_id", "calendar_day")
        .agg(F.sum("items").alias("daily_items_count"))
    )


def lifetime_return_rate(mart_customer_daily: DataFrame) -> DataFrame:
    """Returned value over gross spend per customer, 0 without gross spend."""
    return (
        mart_customer_daily.groupBy("customer_id")
        .agg(
            F.sum("gross_spend").alias("lifetime_gross_spend"),
            F.sum("return_value").alias("lifetime_returned_value"),
        )
        .withColumn(
            "lifetime_return_rate",
            ratio(F.abs("lifetime_returned_value"), F.col("lifetime_gross_spend")),
        )
    )


def varying_entities(clean: DataFrame) -> DataFrame:
    """Customers, codes and invoices with more than one country, description or timestamp."""

    def varying(entity: str, attribute: str, label: str) -> DataFrame:
        return (
            clean.where(F.col(f"`{entity}`").isNotNull())
            .groupBy(F.col(f"`{entity}`").alias("entity"))
            .agg(F.countDistinct(attribute).alias("n"))
            .agg(F.count(F.lit(1)).alias("entities"), count_if(F.col("n") > 1).alias("varying"))
            .select(F.lit(label).alias("what"), "entities", "varying")
        )

    return (
        varying("Customer ID", "Country", "multi_country_customers")
        .unionByName(varying("StockCode", "Description", "multi_description_codes"))
        .unionByName(varying("Invoice", "InvoiceDate", "multi_timestamp_invoices"))
    )
