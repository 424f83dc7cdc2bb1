"""The checks of the four core tables within one namespace.

Rules that read the same table run as one aggregate; every other check reduces its large side
before it joins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...functions.expressions import any_of, count_if, differs, sum_if
from ...schema import CORE_SCHEMAS, GRAINS, MONEY_PRECISION
from ...session import scratch_table
from ..cleaning import is_non_product_code
from ..core import invoice_kind
from ..marts import is_merchandise_return, is_sale, namespace
from .frames import extra_numbers, extra_rows, orphans
from .results import compared, fixed, union_results, violations

Core = dict[str, DataFrame]


def _null_required(table: str) -> Column:
    return any_of(F.col(f.name).isNull() for f in CORE_SCHEMAS[table] if not f.nullable)


def line_rules() -> dict[str, Column]:
    """Violation predicate of every rule that needs only the line itself."""
    quantity, price = F.col("quantity"), F.col("unit_price")
    priced, free, negative = F.col("has_valid_price"), F.col("is_price_zero"), F.col("is_price_negative")
    cancelled = F.col("is_cancellation")
    key = F.concat_ws(":", "source_system", "source_sheet", F.col("source_row_number").cast("string"))
    invoice = F.upper("invoice_number")
    return {
        "completeness.invoice_lines": _null_required("invoice_lines"),
        "business.source_line_key": (F.col("source_row_number") <= 0) | differs(F.col("source_line_key"), key),
        "business.identifiers": any_of(F.col(c) == "" for c in ("invoice_number", "stock_code", "source_sheet")),
        "business.customer_presence": differs(F.col("has_customer_id"), F.col("customer_id").isNotNull()),
        "business.description_presence": differs(F.col("has_description"), F.col("description").isNotNull()),
        "business.cancellation": differs(cancelled, invoice.startswith("C")),
        "business.bad_debt": differs(F.col("is_bad_debt_adjustment"), invoice.startswith("A")),
        "business.return": differs(F.col("is_return"), cancelled),
        "business.negative_quantity": differs(F.col("is_negative_quantity"), quantity < 0),
        "business.price_flags": (priced.cast("int") + free.cast("int") + negative.cast("int") != 1)
        | ((price > 0) & ~priced)
        | ((price < 0) & ~negative)
        | ((price != 0) & free),
        "business.inventory_adjustment": differs(
            F.col("is_inventory_adjustment"),
            (quantity < 0) & ~cancelled & free & F.col("customer_id").isNull(),
        ),
        "business.valid_sale": differs(
            is_sale(),
            ~cancelled & ~F.col("is_bad_debt_adjustment") & (quantity > 0) & priced & ~F.col("is_non_product"),
        ),
        "business.non_product": differs(F.col("is_non_product"), is_non_product_code(F.col("stock_code"))),
        "financial.line_arithmetic": differs(
            F.col("line_total"), F.round(quantity.cast("decimal(10,0)") * price, 2).cast("decimal(14,2)")
        ),
    }


def check_line_rules(core: Core, names: Iterable[str]) -> DataFrame:
    rules = line_rules()
    keys = {f"r{i}": name for i, name in enumerate(names)}
    counted = core["invoice_lines"].agg(*[count_if(rules[name]).alias(key) for key, name in keys.items()])
    return violations(counted, keys)


def _one(counted: DataFrame, name: str) -> DataFrame:
    return violations(counted, {"n": name})


def _completeness(table: str):
    def check(core: Core) -> DataFrame:
        return _one(core[table].agg(count_if(_null_required(table)).alias("n")), f"completeness.{table}")

    return check


def _uniqueness(name: str, table: str, grain: list[str]):
    return lambda core: _one(extra_rows(core[table], grain), name)


def _uniqueness_of_numbers(name: str, table: str, keys: list[str], number: str):
    return lambda core: _one(extra_numbers(core[table], keys, number), name)


def _integrity(child: str, parent: str, key: str):
    def check(core: Core) -> DataFrame:
        referring = core[child].where(F.col(key).isNotNull())
        return _one(orphans(referring, core[parent], ["source_system", key]), f"integrity.{child}.{parent}")

    return check


_INVOICE = ["source_system", "invoice_number"]
_CUSTOMER = ["source_system", "customer_id"]
_PRODUCT = ["source_system", "stock_code"]


def invoice_parts(core: Core) -> DataFrame:
    """Lines summed per invoice and customer: what every check of invoices and customers needs of them."""
    if "invoice_parts" in core:
        return core["invoice_parts"]
    return core["invoice_lines"].groupBy(*_INVOICE, "customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("quantity").alias("quantity"),
        F.sum("line_total").alias("amount"),
        F.min("invoice_date").alias("first_date"),
        F.bool_or("is_cancellation").alias("cancelled"),
        F.bool_or("is_bad_debt_adjustment").alias("bad_debt"),
        F.bool_or("is_inventory_adjustment").alias("inventory"),
        F.bool_or(is_sale()).alias("ordered"),
        sum_if(F.col("line_total"), is_sale() | is_merchandise_return()).alias("spend"),
    )


def product_parts(core: Core) -> DataFrame:
    """Lines counted per stock code."""
    if "product_parts" in core:
        return core["product_parts"]
    return core["invoice_lines"].groupBy(*_PRODUCT).agg(F.count(F.lit(1)).alias("n"))


def with_shared_parts(core: Core) -> Core:
    """The core with both summaries written once, for runs of many checks."""
    return {
        **core,
        "invoice_parts": scratch_table(invoice_parts(core), "invoice-parts"),
        "product_parts": scratch_table(product_parts(core), "product-parts"),
    }


def _orphan_lines(parts: Callable[[Core], DataFrame], parent: str, keys: list[str]):
    """Lines whose key the parent table lacks, from their sums per key."""

    def check(core: Core) -> DataFrame:
        counted = parts(core).where(F.col(keys[1]).isNotNull()).groupBy(*keys).agg(F.sum("n").alias("n"))
        lost = counted.join(core[parent].select(*keys), keys, "left_anti")
        return _one(lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), f"integrity.invoice_lines.{parent}")

    return check


def _line_header_customer(core: Core) -> DataFrame:
    named = invoice_parts(core).where(F.col("customer_id").isNotNull()).select(*_INVOICE, "customer_id", "n")
    headers = core["invoices"].select(*_INVOICE, F.col("customer_id").alias("header_customer"))
    wrong = named.join(headers, _INVOICE).where(differs(F.col("customer_id"), F.col("header_customer")))
    return _one(wrong.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), "integrity.line_header_customer")


def _invoice_sums(core: Core) -> DataFrame:
    kind = invoice_kind(F.bool_or("cancelled"), F.bool_or("bad_debt"), F.bool_or("inventory"))
    return invoice_parts(core).groupBy(*_INVOICE).agg(
        F.sum("n").alias("n"), F.sum("quantity").alias("quantity"), F.sum("amount").alias("amount"),
        F.min("first_date").alias("first_date"), kind.alias("kind"),
    )


def _invoice_ledger(core: Core) -> DataFrame:
    pairs = {
        "total_line_count": "n",
        "total_quantity": "quantity",
        "total_invoice_amount": "amount",
        "invoice_date": "first_date",
    }
    joined = core["invoices"].join(_invoice_sums(core), _INVOICE, "left")
    wrong = any_of(differs(F.col(stored), F.col(found)) for stored, found in pairs.items())
    return _one(joined.agg(count_if(wrong).alias("n")), "financial.invoice_ledger")


def _invoice_type(core: Core) -> DataFrame:
    joined = core["invoices"].join(_invoice_sums(core), _INVOICE, "left")
    return _one(
        joined.agg(count_if(differs(F.col("invoice_type"), F.col("kind"))).alias("n")), "business.invoice_type"
    )


def customer_totals(lines: DataFrame) -> DataFrame:
    """Valid orders and net merchandise spend per customer, straight from the lines."""
    return _customer_sums({"invoice_lines": lines})


def _customer_sums(core: Core) -> DataFrame:
    named = invoice_parts(core).where(F.col("customer_id").isNotNull())
    return named.groupBy(*_CUSTOMER).agg(count_if(F.col("ordered")).alias("orders"), F.sum("spend").alias("spend"))


def _customer_merchandise(core: Core) -> DataFrame:
    joined = core["customers"].join(_customer_sums(core), _CUSTOMER, "left")
    wrong = differs(F.col("total_orders_lifetime"), F.col("orders")) | differs(
        F.col("total_merchandise_spend"), F.col("spend")
    )
    return _one(joined.agg(count_if(wrong).alias("n")), "financial.customer_merchandise")


def _join_fanout(core: Core) -> DataFrame:
    """Rows that joining the lines to their products, invoices and customers would add or lose.

    A line meets as many rows as its parents have copies. Only keys whose number of copies is not one matter, and lines are looked up
    by those alone; a line without customer, or with one that is missing, keeps its row.
    """

    def unusual(parts: DataFrame, parent: str, keys: list[str], name: str, required: bool) -> DataFrame:
        copies = core[parent].groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
        found = parts.where(F.col(keys[1]).isNotNull()).select(*keys).distinct().join(copies, keys, "left" if required else "inner")
        return found.withColumn(name, F.coalesce(name, F.lit(0))).where(F.col(name) != 1)

    lines = core["invoice_lines"].select("source_system", "stock_code", "invoice_number", "customer_id")
    names = {"products": (product_parts(core), _PRODUCT, True), "invoices": (invoice_parts(core), _INVOICE, True), "customers": (invoice_parts(core), _CUSTOMER, False)}
    joined, rows = lines, F.lit(1).cast("decimal(38,0)")
    for parent, (parts, keys, required) in names.items():
        joined = joined.join(unusual(parts, parent, keys, f"_{parent}", required), keys, "left")
        rows = rows * F.coalesce(F.col(f"_{parent}").cast("decimal(12,0)"), F.lit(1))
    return _one(joined.agg(F.abs(F.coalesce(F.sum(rows - 1), F.lit(0))).alias("n")), "integrity.join_fanout")


def _line_rule(name: str):
    return lambda core: check_line_rules(core, [name])


CHECKS: dict[str, Callable[[Core], DataFrame]] = {
    **{f"completeness.{t}": _completeness(t) for t in CORE_SCHEMAS if t != "invoice_lines"},
    "completeness.invoice_lines": _line_rule("completeness.invoice_lines"),
    **{f"uniqueness.{t}.grain": _uniqueness(f"uniqueness.{t}.grain", t, grain) for t, grain in GRAINS.items()},
    "uniqueness.invoice_lines.line_id": _uniqueness_of_numbers("uniqueness.invoice_lines.line_id", "invoice_lines", [], "line_id"),
    "uniqueness.invoice_lines.source_position": _uniqueness_of_numbers(
        "uniqueness.invoice_lines.source_position", "invoice_lines", ["source_system", "source_sheet"], "source_row_number"
    ),
    "integrity.invoices.customers": _integrity("invoices", "customers", "customer_id"),
    "integrity.invoice_lines.customers": _orphan_lines(invoice_parts, "customers", _CUSTOMER),
    "integrity.invoice_lines.products": _orphan_lines(product_parts, "products", _PRODUCT),
    "integrity.invoice_lines.invoices": _orphan_lines(invoice_parts, "invoices", _INVOICE),
    **{
        name: _line_rule(name)
        for name in (
            "business.source_line_key", "business.identifiers", "business.customer_presence",
            "business.description_presence", "business.cancellation", "business.bad_debt", "business.return",
            "business.negative_quantity", "business.price_flags", "business.inventory_adjustment",
            "business.valid_sale", "business.non_product",
        )
    },
    "integrity.line_header_customer": _line_header_customer,
    "financial.line_arithmetic": _line_rule("financial.line_arithmetic"),
    "financial.invoice_ledger": _invoice_ledger,
    "business.invoice_type": _invoice_type,
    "financial.customer_merchandise": _customer_merchandise,
    "integrity.join_fanout": _join_fanout,
}

# Checks answered together by one scan of the lines.
FUSED = [
    "completeness.invoice_lines", "business.source_line_key", "business.identifiers", "business.customer_presence",
    "business.description_presence", "business.cancellation", "business.bad_debt", "business.return",
    "business.negative_quantity", "business.price_flags", "business.inventory_adjustment", "business.valid_sale",
    "business.non_product", "financial.line_arithmetic",
]


def in_namespace(core: Core, source_system: str) -> Core:
    return {table: namespace(frame, source_system) for table, frame in core.items()}


def core_check(core: Core, name: str, source_system: str) -> DataFrame:
    return CHECKS[name](in_namespace(core, source_system))


def core_checks(core: Core, source_system: str) -> dict[str, DataFrame]:
    """All checks, the line rules fused under one key and the sums of the lines written once."""
    scoped = with_shared_parts(in_namespace(core, source_system))
    return {
        "line_rules": check_line_rules(scoped, FUSED),
        **{name: check(scoped) for name, check in CHECKS.items() if name not in FUSED},
    }


# --- schema ------------------------------------------------------------------------------------


def missing_columns(core: Core) -> list[str]:
    return [
        f"{table}.{f.name}"
        for table, schema in CORE_SCHEMAS.items()
        for f in schema
        if table not in core or f.name not in core[table].columns
    ]


def required_columns_check(core: Core) -> DataFrame:
    """Per table, the number of contract columns it lacks; give it tables opened with the schema of their files."""
    missing = missing_columns(core)
    return union_results(
        frame.agg(F.lit(sum(m.startswith(f"{table}.") for m in missing)).alias("n")).select(
            *compared(F.lit("schema.required_columns"), F.lit(table), F.lit(0), F.col("n"))
        )
        for table, frame in core.items()
    )


def nullability_check(core: Core) -> DataFrame:
    """Columns declared required that hold a null, per table."""
    frames = []
    for table, frame in core.items():
        required = [f.name for f in CORE_SCHEMAS[table] if not f.nullable and f.name in frame.columns]
        broken = [F.when(count_if(F.col(c).isNull()) > 0, 1).otherwise(0).alias(c) for c in required]
        counted = frame.agg(*broken)
        total = counted.select(sum((F.col(c) for c in required), F.lit(0)).alias("n"))
        frames.append(
            total.select(*compared(F.lit("schema.nullability"), F.lit(table), F.lit(0), F.col("n")))
        )
    return union_results(frames)


def decimal_storage_check(core: Core) -> DataFrame:
    """Money columns not stored as decimals of the contracted precision and scale 2, per table.

    As above, the tables have to be opened with the schema of their files to say anything about storage.
    """
    frames = []
    for table, frame in core.items():
        wrong = 0
        for (owner, column), precision in MONEY_PRECISION.items():
            if owner == table:
                stored = frame.schema[column].dataType if column in frame.columns else None
                wrong += stored != T.DecimalType(precision, 2)
        frames.append(
            frame.agg(F.lit(wrong).alias("n")).select(
                *compared(F.lit("financial.decimal_storage"), F.lit(table), F.lit(0), F.col("n"))
            )
        )
    return union_results(frames)


def population_check(core: Core, source_system: str) -> DataFrame:
    found = namespace(core["invoice_lines"], source_system).limit(1).agg(F.count(F.lit(1)).alias("found"))
    return _one(found.select((1 - F.col("found")).alias("n")), "completeness.source_population")


def profile(core: Core, source_system: str) -> DataFrame:
    """Counts of permitted special lines; informational, always PASS."""
    counted = namespace(core["invoice_lines"], source_system).agg(
        count_if(F.col("customer_id").isNull()).alias("guest_lines"),
        count_if(F.col("description").isNull()).alias("missing_descriptions"),
        count_if(F.col("is_duplicate_within_sheet")).alias("retained_duplicate_lines"),
        count_if(F.col("quantity") == 0).alias("zero_quantity_lines"),
        count_if(F.col("is_price_zero")).alias("zero_price_lines"),
        count_if(F.col("is_price_negative")).alias("negative_price_lines"),
    )
    long = counted.unpivot([], counted.columns, "_item", "_count")
    name = F.lit("profile.allowed_missing_and_special_lines")
    return long.select(*compared(name, F.col("_item"), F.col("_count"), F.col("_count"))).withColumn(
        "expected", F.lit(None).cast("decimal(38,2)")
    )


def skipped_checks(spark, reason: str) -> DataFrame:
    return union_results(fixed(spark, name, "violations", "SKIP", reason) for name in CHECKS)
