"""Mart contracts: unique grain, money identities and reconciliation to the core lines."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.expressions import any_of, count_if, differs, sum_if
from ..marts import eligible_lines, header_days, is_merchandise_return, is_sale, namespace
from .frames import extra_rows
from .results import item_violations


def _unmatched(mart: DataFrame, wanted: DataFrame, grain: list[str], measures: list[str]) -> DataFrame:
    """Grain rows present on one side only, or with any differing measure."""
    left = mart.select(*grain, *[F.col(m).alias(f"{m}|mart") for m in measures], F.lit(1).alias("in_mart"))
    right = wanted.select(*grain, *[F.col(m).alias(f"{m}|core") for m in measures], F.lit(1).alias("in_core"))
    wrong = any_of(differs(F.col(f"`{m}|mart`"), F.col(f"`{m}|core`")) for m in measures)
    return left.join(right, grain, "full_outer").agg(
        count_if(F.col("in_mart").isNull() | F.col("in_core").isNull() | wrong).alias("n")
    )


def _invoice_days(lines: DataFrame, invoices: DataFrame, source_system: str, *keys: str) -> DataFrame:
    """Eligible lines summed per invoice and ``keys``, then placed on the day and country of their header."""
    total, quantity = F.col("line_total"), F.col("quantity")
    sums = lines.groupBy("invoice_number", *keys).agg(
        sum_if(total, is_sale()).alias("sales"),
        sum_if(total, is_merchandise_return()).alias("returns"),
        F.sum(total).alias("net"),
        count_if(is_sale()).alias("sale_lines"),
        sum_if(quantity, is_sale()).alias("sold"),
        sum_if(quantity, is_merchandise_return()).alias("returned"),
    )
    return sums.join(header_days(invoices, source_system), "invoice_number")


def _results(name: str, **counts: DataFrame) -> DataFrame:
    out = None
    for item, frame in counts.items():
        result = item_violations(frame.select(F.col("n").alias(item)), name)
        out = result if out is None else out.unionByName(result)
    return out


def daily_sales_contract(mart, lines, invoices, products, source_system: str) -> DataFrame:
    grain = ["calendar_day", "country", "is_physical_merchandise"]
    classes = namespace(products, source_system).select("stock_code", "is_physical_merchandise")
    eligible = eligible_lines(lines, source_system).join(classes, "stock_code")
    wanted = _invoice_days(eligible, invoices, source_system, "is_physical_merchandise").groupBy(*grain).agg(
        F.sum("sales").alias("gross_sales"),
        F.sum("returns").alias("return_value"),
        F.sum("net").alias("net_sales"),
        count_if(F.col("sale_lines") > 0).alias("distinct_invoices"),
        F.sum("sold").alias("units_sold"),
        (-F.sum("returned")).alias("units_returned"),
    )
    identity = differs(F.col("net_sales"), F.col("gross_sales") + F.col("return_value")) | differs(
        F.col("gross_sales"), F.col("valid_sales_revenue")
    )
    measures = ["gross_sales", "return_value", "net_sales", "distinct_invoices", "units_sold", "units_returned"]
    return _results(
        "marts.mart_daily_sales",
        repeated_grain=extra_rows(mart, grain),
        broken_identity=mart.agg(count_if(identity).alias("n")),
        differs_from_core=_unmatched(mart, wanted, grain, measures),
    )


def customer_daily_contract(mart, lines, invoices, source_system: str) -> DataFrame:
    grain = ["customer_id", "calendar_day"]
    named = eligible_lines(lines, source_system).where(F.col("customer_id").isNotNull())
    wanted = _invoice_days(named, invoices, source_system, "customer_id").groupBy(*grain).agg(
        count_if(F.col("sale_lines") > 0).alias("order_frequency"),
        F.sum("sales").alias("gross_spend"),
        F.sum("returns").alias("return_value"),
        F.sum("net").alias("net_spend"),
        F.sum("sale_lines").alias("valid_transaction_count"),
    )
    identity = differs(F.col("net_spend"), F.col("gross_spend") + F.col("return_value"))
    measures = ["order_frequency", "gross_spend", "return_value", "net_spend", "valid_transaction_count"]
    return _results(
        "marts.mart_customer_daily",
        repeated_grain=extra_rows(mart, grain),
        null_customers=mart.agg(count_if(F.col("customer_id").isNull()).alias("n")),
        broken_identity=mart.agg(count_if(identity).alias("n")),
        differs_from_core=_unmatched(mart, wanted, grain, measures),
    )


def customer_snapshot_contract(mart, customers, lines, invoices, source_system: str, reference_date: date) -> DataFrame:
    """Covers every customer once, buyers or not, with measures recomputed from the lines."""
    named = eligible_lines(lines, source_system).where(F.col("customer_id").isNotNull())
    day = F.when(F.col("sale_lines") > 0, F.col("calendar_day"))
    activity = _invoice_days(named, invoices, source_system, "customer_id").groupBy("customer_id").agg(
        count_if(F.col("sale_lines") > 0).alias("frequency"),
        F.sum("net").alias("monetary"),
        F.min(day).alias("first_purchase_date"),
        F.max(day).alias("last_purchase_date"),
    )
    wanted = namespace(customers, source_system).select("customer_id").join(activity, "customer_id", "left").withColumns(
        {
            "frequency": F.coalesce("frequency", F.lit(0)),
            "monetary": F.coalesce("monetary", F.lit(0)).cast("decimal(24,2)"),
            "recency_days": F.datediff(F.lit(reference_date), "last_purchase_date"),
            "tenure_days": F.datediff(F.lit(reference_date), "first_purchase_date"),
        }
    )
    inactive = (F.col("frequency") == 0) & any_of(
        F.col(c).isNotNull() for c in ("recency_days", "tenure_days", "average_order_value", "first_purchase_date")
    )
    measures = ["frequency", "monetary", "first_purchase_date", "last_purchase_date", "recency_days", "tenure_days"]
    return _results(
        "marts.mart_customer_snapshot",
        repeated_grain=extra_rows(mart, ["customer_id"]),
        inactive_with_dates=mart.agg(count_if(inactive).alias("n")),
        differs_from_core=_unmatched(mart, wanted, ["customer_id"], measures),
    )
