"""Generic checks on any DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...functions.expressions import any_of, count_if, differs, truth
from ..cleaning import is_non_product_code
from .results import compared, item_violations


def required_columns(frame: DataFrame, required: list[str]) -> DataFrame:
    """Number of required columns that do not exist; the reason names them."""
    missing = sorted(set(required) - set(frame.columns))
    row = frame.limit(1).agg(F.lit(len(missing)).alias("n"))
    result = row.select(*compared(F.lit("completeness.required_columns"), F.lit("missing"), F.lit(0), F.col("n")))
    return result.withColumn("reason", F.lit(", ".join(missing) or None).cast("string"))


def _guarded(frame: DataFrame, needed: list[str], check) -> DataFrame:
    return required_columns(frame, needed) if set(needed) - set(frame.columns) else check()


def extra_rows(frame: DataFrame, grain: list[str]) -> DataFrame:
    """One row: rows beyond the first of each key combination."""
    copies = frame.groupBy(*grain).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return copies.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("n"))


def extra_numbers(frame: DataFrame, keys: list[str], number: str) -> DataFrame:
    """``extra_rows`` of (keys, a whole number): 64 neighbouring numbers are bits of one word, so numbers that lie together meet before the shuffle."""
    bit = F.expr(f"shiftleft(1L, cast({number} & 63 as int))")
    words = frame.groupBy(*keys, F.shiftright(number, 6).alias("_word")).agg(F.count(F.lit(1)).alias("_rows"), F.bit_or(bit).alias("_bits"))
    # Rows without a number have no bit and are one key.
    extra = F.col("_rows") - F.coalesce(F.bit_count("_bits"), F.lit(1))
    return words.agg(F.coalesce(F.sum(extra), F.lit(0)).alias("n"))


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """One row: child rows without a parent.

    Child keys are counted before the join, so a key shared by very many rows is one row there.
    """
    counted = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.join(parent.select(*keys), keys, "left_anti").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")
    )


def missing_values(frame: DataFrame, required: list[str]) -> DataFrame:
    def check():
        counted = frame.agg(count_if(any_of(F.col(c).isNull() for c in required)).alias("rows_with_null"))
        return item_violations(counted, "completeness.missing_values")

    return _guarded(frame, required, check)


def unique_grain(frame: DataFrame, grain: list[str]) -> DataFrame:
    def check():
        return item_violations(extra_rows(frame, grain).select(F.col("n").alias("extra_rows")), "uniqueness.grain")

    return _guarded(frame, grain, check)


def foreign_keys(child: DataFrame, parent: DataFrame, keys: list[str], *, nullable_key: str | None = None) -> DataFrame:
    def check():
        eligible = child if nullable_key is None else child.where(F.col(nullable_key).isNotNull())
        return item_violations(
            orphans(eligible, parent, keys).select(F.col("n").alias("orphans")), "integrity.foreign_keys"
        )

    return _guarded(child, keys, lambda: _guarded(parent, keys, check))


def expected_flags(prices_are_rounded: bool) -> dict[str, Column]:
    """What each flag must be, given the other line columns.

    A stored price of 0.00 may have been a small price before rounding, so with rounded prices
    the three price flags are taken as they are on such lines.
    """
    invoice, price, quantity = F.upper("invoice_number"), F.col("unit_price"), F.col("quantity")

    def price_flag(name, rule):
        return F.when(price == 0, F.col(name)).otherwise(rule) if prices_are_rounded else rule

    flags = {
        "is_cancellation": truth(invoice.startswith("C")),
        "is_bad_debt_adjustment": truth(invoice.startswith("A")),
        "is_negative_quantity": truth(quantity < 0),
        "has_customer_id": F.col("customer_id").isNotNull(),
        "has_description": F.col("description").isNotNull(),
        "has_valid_price": price_flag("has_valid_price", truth(price > 0)),
        "is_price_zero": price_flag("is_price_zero", truth(price == 0)),
        "is_price_negative": price_flag("is_price_negative", truth(price < 0)),
        "is_non_product": is_non_product_code(F.col("stock_code")),
    }
    cancelled = flags["is_cancellation"]
    flags["is_return"] = cancelled
    flags["is_inventory_adjustment"] = (
        flags["is_negative_quantity"] & ~cancelled & flags["is_price_zero"] & ~flags["has_customer_id"]
    )
    flags["is_valid_sale"] = (
        ~cancelled & ~flags["is_bad_debt_adjustment"] & truth(quantity > 0)
        & flags["has_valid_price"] & ~flags["is_non_product"]
    )
    return flags


def line_business_rules(lines: DataFrame, *, prices_are_rounded: bool = True) -> DataFrame:
    """Violations per flag and of the rule that exactly one price flag is set: one pass."""
    rules = expected_flags(prices_are_rounded)
    needed = [*rules, "invoice_number", "stock_code", "customer_id", "description", "quantity", "unit_price"]

    def check():
        price_flags = [F.col(c).cast("int") for c in ("has_valid_price", "is_price_zero", "is_price_negative")]
        set_flags = price_flags[0] + price_flags[1] + price_flags[2]
        counted = lines.agg(
            *[count_if(differs(F.col(flag), wanted)).alias(flag) for flag, wanted in rules.items()],
            count_if(differs(set_flags, F.lit(1))).alias("price_flag_partition"),
        )
        return item_violations(counted, "business.line_flags")

    return _guarded(lines, needed, check)


def monetary_total(frame: DataFrame, column: str) -> DataFrame:
    """Exact decimal total of a money column; float columns are refused."""
    if not isinstance(frame.schema[column].dataType, (T.DecimalType, T.IntegralType)):
        raise TypeError("money must be decimal")
    return frame.agg(F.coalesce(F.sum(column), F.lit(0)).alias("total"))
