"""Reconciliation of the core with the cleaned ledger it was loaded from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.expressions import any_of, count_if, differs, sum_if
from ...schema import CORE_TABLES, FLAG_COLUMNS, LEDGER_COLUMNS, PAYLOAD_COLUMNS
from ...session import scratch_table
from ...sources.fingerprint import differing_leaves, digest_leaves
from ..core import core_rows
from ..marts import is_merchandise_return, is_sale, namespace
from .core_checks import customer_totals
from .frames import line_business_rules
from .results import item_violations, side_by_side, union_results

_REQUIRED = [c for c in LEDGER_COLUMNS if c not in ("Customer ID", "Description")] + ["source_sheet", *FLAG_COLUMNS]


def source_contract(clean: DataFrame) -> DataFrame:
    """Required values, whole ids and quantities, finite prices, and flags matching raw prices."""
    quantity, price = F.col("Quantity").cast("double"), F.col("Price").cast("double")
    customer = F.col("`Customer ID`").cast("double")
    values = clean.agg(
        count_if(any_of(F.col(f"`{c}`").isNull() for c in _REQUIRED)).alias("null_required_values"),
        count_if(quantity % 1 != 0).alias("fractional_quantities"),
        count_if(customer % 1 != 0).alias("fractional_customer_ids"),
        count_if(F.isnan(price) | (F.abs(price) == float("inf"))).alias("non_finite_prices"),
    )
    renamed = clean.withColumnsRenamed(
        {
            "Invoice": "invoice_number", "StockCode": "stock_code", "Customer ID": "customer_id",
            "Description": "description", "Quantity": "quantity", "Price": "unit_price",
        }
    )
    flags = line_business_rules(renamed, prices_are_rounded=False)
    return item_violations(values, "source.parquet").unionByName(flags.withColumn("check_name", F.lit("source.parquet")))


_DIMENSIONS = {"customers": "customer_id", "products": "stock_code", "invoices": "invoice_number"}


def row_counts(clean: DataFrame, core: dict[str, DataFrame], source_system: str) -> DataFrame:
    rows = core_rows(clean)
    frames = []
    for table in CORE_TABLES:
        key = _DIMENSIONS.get(table)
        wanted = rows.agg((F.countDistinct(key) if key else F.count(F.lit(1))).alias(table))
        stored = namespace(core[table], source_system).agg(F.count(F.lit(1)).alias(table))
        frames.append(side_by_side(wanted, stored, "source.row_counts"))
    return union_results(frames)


def dimension_keys(clean: DataFrame, core: dict[str, DataFrame], source_system: str) -> DataFrame:
    """Keys only in the ledger (missing) or only in the core (extra), per dimension."""
    rows = core_rows(clean)
    frames = []
    for table, key in _DIMENSIONS.items():
        wanted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.lit(True).alias("in_source"))
        stored = namespace(core[table], source_system).groupBy(key).agg(F.lit(True).alias("in_core"))
        counted = wanted.join(stored, key, "full_outer").agg(
            count_if(F.col("in_core").isNull()).alias(f"{table}.missing"),
            count_if(F.col("in_source").isNull()).alias(f"{table}.extra"),
        )
        renamed = counted.toDF(f"{table}_missing", f"{table}_extra")
        frames.append(item_violations(renamed, "source.dimension_keys"))
    return union_results(frames)


def _flag_totals(rows: DataFrame) -> DataFrame:
    return rows.agg(
        *[count_if(F.col(flag)).alias(flag) for flag in FLAG_COLUMNS],
        count_if(F.col("customer_id").isNull()).alias("guest_lines"),
    )


def flag_counts(clean: DataFrame, core: dict[str, DataFrame], source_system: str) -> DataFrame:
    lines = namespace(core["invoice_lines"], source_system)
    return side_by_side(_flag_totals(core_rows(clean)), _flag_totals(lines), "source.flag_counts")


def _money_totals(rows: DataFrame) -> DataFrame:
    total = F.col("line_total")
    return rows.agg(
        F.coalesce(F.sum(total), F.lit(0)).alias("ledger"),
        sum_if(total, is_sale()).alias("gross_sales"),
        sum_if(total, is_merchandise_return()).alias("merchandise_returns"),
        sum_if(total, is_sale() | is_merchandise_return()).alias("net_merchandise"),
    )


def monetary_aggregates(clean: DataFrame, core: dict[str, DataFrame], source_system: str) -> DataFrame:
    lines = namespace(core["invoice_lines"], source_system)
    return side_by_side(_money_totals(core_rows(clean)), _money_totals(lines), "source.monetary_aggregates")


def row_fingerprint(columns: list[str] = PAYLOAD_COLUMNS) -> Column:
    """sha256 of the canonical JSON array of a line's content columns."""

    def text(name: str) -> Column:
        if name == "invoice_date":
            return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss")
        return F.col(name).cast("string")

    return F.sha2(F.to_json(F.array(*[text(c) for c in columns])), 256)


_POSITION = ["source_sheet", "source_row_number"]
BLOCK_BITS = 16


def record_tree(lines: DataFrame) -> DataFrame:
    """Digest leaves (source_sheet, block) over the content of lines, 2**BLOCK_BITS row numbers to a block."""
    block = F.shiftright("source_row_number", BLOCK_BITS)
    return digest_leaves(lines, row_fingerprint(), {"source_sheet": F.col("source_sheet"), "block": block})


def record_differences(expected_lines: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines missing, extra or changed by content, matched on their source position.

    Both sides are compared by digest trees first; only lines of blocks that differ are compared one by one, and none if the trees agree.
    """
    keys = ["source_sheet", "block"]
    differing = scratch_table(differing_leaves(record_tree(expected_lines), record_tree(lines), keys), "differing-blocks")
    block = F.shiftright("source_row_number", BLOCK_BITS).alias("block")

    def open_rows(frame: DataFrame, name: str) -> DataFrame:
        rows = frame.select(*_POSITION, block, row_fingerprint().alias(name))
        return rows.join(differing, keys, "left_semi").drop("block")

    if differing.isEmpty():
        none = F.lit(0).cast("bigint")
        return item_violations(differing.agg(*[F.coalesce(F.count(F.lit(1)), none).alias(c) for c in ("missing", "extra", "changed")]), "source.records")
    counted = open_rows(expected_lines, "wanted").join(open_rows(lines, "stored"), _POSITION, "full_outer").agg(
        count_if(F.col("stored").isNull()).alias("missing"),
        count_if(F.col("wanted").isNull()).alias("extra"),
        count_if(F.col("wanted") != F.col("stored")).alias("changed"),
    )
    return item_violations(counted, "source.records")


def provenance(core: dict[str, DataFrame], source_system: str, checksum: str) -> DataFrame:
    """Rows per table not stamped with the ledger's checksum."""
    return union_results(
        item_violations(
            namespace(core[table], source_system).agg(
                count_if(differs(F.col("source_file_sha256"), F.lit(checksum))).alias(table)
            ),
            "source.provenance",
        )
        for table in CORE_TABLES
    )


def financial_diagnostics(core: dict[str, DataFrame], source_system: str) -> DataFrame:
    """How far stored invoice and customer totals are from the sums of their lines."""
    lines = namespace(core["invoice_lines"], source_system)
    per_invoice = lines.groupBy("invoice_number").agg(F.sum("line_total").alias("found"))
    invoices = namespace(core["invoices"], source_system).join(per_invoice, "invoice_number").select(
        (F.col("total_invoice_amount") - F.col("found")).alias("delta")
    )
    customers = namespace(core["customers"], source_system).join(
        customer_totals(lines).select("customer_id", "spend"), "customer_id"
    ).select((F.col("total_merchandise_spend") - F.col("spend")).alias("delta"))

    def measured(frame, label):
        delta = F.col("delta")
        return frame.agg(
            count_if(delta != 0).alias("mismatched_groups"),
            F.coalesce(F.sum(delta), F.lit(0)).alias("signed_delta"),
            F.coalesce(F.sum(F.abs(delta)), F.lit(0)).alias("absolute_delta"),
            F.coalesce(F.max(F.abs(delta)), F.lit(0)).alias("maximum_absolute_delta"),
        ).withColumn("level", F.lit(label))

    return measured(invoices, "invoices").unionByName(measured(customers, "customers"))


def ledger_rounding(clean: DataFrame, core: dict[str, DataFrame], source_system: str) -> DataFrame:
    """Stored decimal ledger against the ledger before price rounding."""
    before = clean.agg(F.sum(F.col("line_total").cast("decimal(38,6)")).cast("decimal(38,2)"))
    stored = namespace(core["invoice_lines"], source_system).agg(F.sum("line_total").alias("stored_ledger"))
    return stored.withColumn("ledger_before_rounding", before.scalar()).withColumn(
        "difference", F.col("stored_ledger") - F.col("ledger_before_rounding")
    )


def reconcile(
    clean: DataFrame, core: dict[str, DataFrame], expected_lines: DataFrame, source_system: str, checksum: str
) -> dict[str, DataFrame]:
    lines = namespace(core["invoice_lines"], source_system)
    return {
        "source.parquet": source_contract(clean),
        "source.row_counts": row_counts(clean, core, source_system),
        "source.dimension_keys": dimension_keys(clean, core, source_system),
        "source.flag_counts": flag_counts(clean, core, source_system),
        "source.monetary_aggregates": monetary_aggregates(clean, core, source_system),
        "source.records": record_differences(expected_lines, lines),
        "source.provenance": provenance(core, source_system, checksum),
    }
