"""The eight-row reconciliation fixture: core values, and the right check fails on each edit."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import core as core_ops
from ledgerloom.operators import marts
from ledgerloom.operators.cleaning import clean_sheets
from ledgerloom.operators.quality import core_checks as cc
from ledgerloom.operators.quality import frames, results, source_checks, suite
from ledgerloom.schema import CORE_SCHEMAS, CORE_TABLES

SYSTEM, STAMP = "LEDGER", "f" * 64


@pytest.fixture(scope="module")
def clean(ledger):
    return clean_sheets(
        {
            "fixture": ledger(
                {}, {},
                {"Invoice": "C100", "Quantity": "-1"},
                {"Invoice": "200", "Quantity": "-1", "Price": "0", "Customer ID": None},
                {"Invoice": "300", "StockCode": "POST", "Price": "5", "Customer ID": None},
                {"Invoice": "400", "Quantity": "0"},
                {"Invoice": "500", "Price": "-1"},
                {"Invoice": "A100"},
            )
        }
    ).cache()


@pytest.fixture(scope="module")
def core(clean):
    return {name: frame.cache() for name, frame in core_ops.build_core(clean, SYSTEM, STAMP).items()}


def statuses(frame):
    return {r["check_name"]: r["status"] for r in frame.collect()}


def failing(core_tables):
    found = results.union_results(cc.core_checks(core_tables, SYSTEM).values()).where("status = 'FAIL'")
    return {r["check_name"] for r in found.collect()}


def test_core_counts_schema_and_money(core):
    assert {t: core[t].count() for t in CORE_TABLES} == {"customers": 1, "products": 2, "invoices": 7, "invoice_lines": 8}
    for table, schema in CORE_SCHEMAS.items():
        assert [(f.name, f.dataType) for f in core[table].schema] == [(f.name, f.dataType) for f in schema]
    customer = core["customers"].first()
    assert (customer["primary_country"], customer["total_orders_lifetime"]) == ("UK", 1)
    assert customer["total_merchandise_spend"] == Decimal("2.00")
    kinds = {r["invoice_number"]: r["invoice_type"] for r in core["invoices"].collect()}
    assert kinds == {
        "1": "SALE", "C100": "CANCELLATION", "200": "INVENTORY_ADJUSTMENT", "300": "SALE", "400": "SALE", "500": "SALE",
        "A100": "BAD_DEBT_ADJUSTMENT",
    }
    types = {r["stock_code"]: (r["product_type"], r["is_physical_merchandise"]) for r in core["products"].collect()}
    assert types == {"100": ("PHYSICAL_MERCHANDISE", True), "POST": ("POSTAGE", False)}


def test_row_numbers_are_gap_free_in_source_order(core, clean):
    keys = [r["source_line_key"] for r in core["invoice_lines"].orderBy("source_row_number").collect()]
    assert keys == [f"LEDGER:fixture:{i}" for i in range(1, 9)]


def test_row_numbers_cross_block_borders(spark):
    positions = [5, 2**20 - 1, 2**20, 2**21 + 7, 2**21 + 9, 3]
    rows = spark.createDataFrame([(p, "s") for p in positions], "source_order long, source_sheet string").repartition(4)
    got = {r["source_order"]: r["source_row_number"] for r in core_ops.number_rows(rows).collect()}
    assert got == {p: i + 1 for i, p in enumerate(sorted(positions))}


def test_mode_prefers_the_latest_on_a_tie_and_first_values_follow_source_order(ledger):
    cleaned = clean_sheets(
        {
            "s": ledger(
                {"Country": "France", "Customer ID": None, "Description": "old"},
                {"Country": "UK", "Description": "new"},
                {"Country": "France", "Customer ID": "7", "Invoice": "2", "Description": None},
                {"Country": "UK", "Customer ID": "7", "Invoice": "3", "Description": None},
            )
        }
    )
    invoice = core_ops.build_invoices(cleaned, SYSTEM, STAMP).where("invoice_number = '1'").first()
    assert (invoice["country"], invoice["customer_id"]) == ("France", 12345)
    customer = core_ops.build_customers(cleaned, SYSTEM, STAMP).where("customer_id = 7").first()
    assert customer["primary_country"] == "UK"
    assert core_ops.build_products(cleaned, SYSTEM, STAMP).first()["primary_description"] == "new"


def test_small_prices_round_to_zero_and_flags_stay(ledger):
    cleaned = clean_sheets({"s": ledger({"Price": "0.001"}, {"Invoice": "2", "Price": "-0.001"}, {"Invoice": "3", "Price": "0.105"})})
    lines = core_ops.build_lines(cleaned, SYSTEM, STAMP).orderBy("source_row_number").collect()
    assert [r["unit_price"] for r in lines] == [Decimal("0.00"), Decimal("0.00"), Decimal("0.10")]
    assert lines[0]["has_valid_price"] and lines[1]["is_price_negative"]
    stored = core_ops.build_core(cleaned, SYSTEM, STAMP)
    assert failing(stored) == set()


def test_every_check_passes_on_the_clean_core(spark, core, clean):
    lines = core_ops.build_lines(clean, SYSTEM, STAMP)
    found = suite.run_suite(spark, core, SYSTEM, clean=clean, expected_lines=lines, checksum=STAMP)
    bad = found.where("status <> 'PASS' AND check_name NOT LIKE 'marts.%'").collect()
    assert bad == []
    assert results.summarize(found).first()["status"] == "SKIP"  # no marts were supplied
    assert results.gate_summary(found).first()["status"] == "PASS"
    items = {r["item"]: r["actual"] for r in found.where("check_name = 'source.monetary_aggregates'").collect()}
    assert (items["gross_sales"], items["merchandise_returns"], items["ledger"]) == (4, -2, 8)
    flags = {r["item"]: r["actual"] for r in found.where("check_name = 'source.flag_counts'").collect()}
    assert (flags["guest_lines"], flags["is_duplicate_within_sheet"], flags["is_price_negative"]) == (2, 2, 1)


def _line(column, value, where="source_row_number = 1"):
    return lambda c: {**c, "invoice_lines": c["invoice_lines"].withColumn(
        column, F.expr(f"CASE WHEN {where} THEN {value} ELSE {column} END").cast(CORE_SCHEMAS["invoice_lines"][column].dataType)
    )}


def _table(table, change):
    return lambda c: {**c, table: change(c[table])}


@pytest.mark.parametrize(
    ("damage", "check"),
    [
        (_line("is_cancellation", "NOT is_cancellation"), "business.cancellation"),
        (_line("is_bad_debt_adjustment", "true"), "business.bad_debt"),
        (_line("is_return", "true"), "business.return"),
        (_line("is_negative_quantity", "true"), "business.negative_quantity"),
        (_line("has_valid_price", "false"), "business.price_flags"),
        (_line("is_inventory_adjustment", "true"), "business.inventory_adjustment"),
        (_line("is_valid_sale", "false"), "business.valid_sale"),
        (_line("is_non_product", "true"), "business.non_product"),
        (_line("has_customer_id", "false"), "business.customer_presence"),
        (_line("has_description", "false"), "business.description_presence"),
        (_line("source_line_key", "'x'"), "business.source_line_key"),
        (_line("stock_code", "''"), "business.identifiers"),
        (_line("stock_code", "'999'"), "integrity.invoice_lines.products"),
        (_line("line_total", "line_total + 0.01"), "financial.line_arithmetic"),
        (_line("customer_id", "99"), "integrity.line_header_customer"),
        (_line("source_row_number", "2"), "uniqueness.invoice_lines.source_position"),
        (_table("invoice_lines", lambda d: d.where("source_row_number <> 1")), "financial.invoice_ledger"),
        (_table("invoice_lines", lambda d: d.unionByName(d.limit(1))), "uniqueness.invoice_lines.grain"),
        (_table("invoices", lambda d: d.withColumn("total_invoice_amount", (F.col("total_invoice_amount") + Decimal("0.01")).cast("decimal(24,2)"))), "financial.invoice_ledger"),
        (_table("invoices", lambda d: d.withColumn("invoice_type", F.lit("SALE"))), "business.invoice_type"),
        (_table("invoices", lambda d: d.unionByName(d.limit(1))), "uniqueness.invoices.grain"),
        (_table("customers", lambda d: d.limit(0)), "integrity.invoices.customers"),
        (_table("customers", lambda d: d.withColumn("total_orders_lifetime", F.lit(9).cast("bigint"))), "financial.customer_merchandise"),
        (_table("products", lambda d: d.unionByName(d)), "integrity.join_fanout"),
        (_table("products", lambda d: d.withColumn("product_type", F.lit(None).cast("string"))), "completeness.products"),
    ],
)
def test_damage_is_found_by_its_check(core, damage, check):
    assert cc.core_check(core, check, SYSTEM).first()["status"] == "PASS"
    assert cc.core_check(damage(core), check, SYSTEM).first()["status"] == "FAIL"


def test_another_namespace_is_not_checked(core):
    other = {t: core[t].unionByName(core[t].withColumn("source_system", F.lit("OTHER"))) for t in core}
    broken = {**other, "invoice_lines": other["invoice_lines"].where("source_system = 'LEDGER' OR source_row_number > 4")}
    assert failing(broken) == set()


def test_record_differences_count_missing_extra_and_changed(core, clean):
    lines = core["invoice_lines"]
    replaced = lines.where("source_row_number > 1").unionByName(
        lines.where("source_row_number = 1").withColumn("source_row_number", F.lit(77).cast("bigint"))
    )
    drifted = replaced.withColumn("unit_price", F.expr("IF(source_row_number = 5, unit_price + 0.01, unit_price)").cast("decimal(12,2)"))
    found = {r["item"]: int(r["actual"]) for r in source_checks.record_differences(lines, drifted).collect()}
    assert found == {"missing": 1, "extra": 1, "changed": 1}


def test_incomplete_schema_skips_dependent_checks(spark, core):
    broken = {**core, "products": core["products"].drop("product_type")}
    found = statuses(suite.run_suite(spark, broken, SYSTEM))
    assert found["source.reconciliation"] == "SKIP" and found["business.valid_sale"] == "SKIP"
    rows = suite.run_suite(spark, broken, SYSTEM).where("check_name = 'schema.required_columns' AND status = 'FAIL'").collect()
    assert [r["item"] for r in rows] == ["products"]


def test_one_failing_check_does_not_stop_the_others(spark, core):
    explode = core["products"].select(
        F.lit("x").alias("check_name"), F.lit("i").alias("item"), F.lit(0).cast("decimal(38,2)").alias("expected"),
        F.lit(0).cast("decimal(38,2)").alias("actual"), F.raise_error(F.lit("secret 12345")).cast("string").alias("status"),
        F.lit(None).cast("string").alias("reason"),
    )
    found = suite.evaluate(spark, {"ok": cc.population_check(core, SYSTEM), "x": explode}).collect()
    assert {(r["check_name"], r["status"]) for r in found} == {("completeness.source_population", "PASS"), ("x", "FAIL")}
    assert "12345" not in str(found)


def test_status_algebra_and_tolerance(spark, core):
    fixed = lambda status: results.fixed(spark, "c", "i", status)
    assert results.summarize(fixed("PASS")).first()["status"] == "PASS"
    assert results.summarize(fixed("PASS").unionByName(fixed("SKIP"))).first()["status"] == "SKIP"
    assert results.summarize(fixed("FAIL").unionByName(fixed("SKIP"))).first()["status"] == "FAIL"
    assert results.summarize(fixed("PASS").limit(0)).first()["status"] == "SKIP"
    row = spark.createDataFrame([(Decimal("1.00"), Decimal("1.01"))], "a decimal(10,2), b decimal(10,2)")
    exact = results.compare(row, "n", F.col("a"), F.col("b")).first()["status"]
    near = results.compare(row, "n", F.col("a"), F.col("b"), tolerance="0.01").first()["status"]
    assert (exact, near) == ("FAIL", "PASS")
    with pytest.raises(ValueError):
        results.compare(row, "n", F.col("a"), F.col("b"), tolerance="-1")


def test_frame_helpers(core):
    lines = core["invoice_lines"]
    assert frames.missing_values(lines, ["customer_id"]).first()["actual"] == 2
    assert frames.unique_grain(lines, ["invoice_number"]).first()["actual"] == 1
    assert frames.missing_values(lines, ["nope"]).first()["reason"] == "nope"
    assert frames.foreign_keys(lines, core["customers"], ["customer_id"], nullable_key="customer_id").first()["status"] == "PASS"
    assert frames.monetary_total(lines, "line_total").first()["total"] == Decimal("8.00")
    with pytest.raises(TypeError):
        frames.monetary_total(lines.withColumn("x", F.lit(1.5)), "x")


def test_marts_on_the_fixture(core):
    daily = marts.daily_sales(core["invoice_lines"], core["invoices"], core["products"]).collect()
    assert len(daily) == 1
    day = daily[0]
    assert (day["gross_sales"], day["return_value"], day["net_sales"]) == (4, -2, 2)
    assert (day["distinct_invoices"], day["units_sold"], day["units_returned"]) == (1, 2, 1)
    snapshot = marts.customer_snapshot(
        core["customers"], core["invoice_lines"], core["invoices"], reference_date=date(2011, 1, 11)
    ).first()
    assert (snapshot["recency_days"], snapshot["frequency"], snapshot["monetary"]) == (10, 1, 2)
    assert snapshot["average_order_value"] == Decimal("4.00")


def test_calendar_day_is_the_headers(ledger):
    cleaned = clean_sheets({"s": ledger({"InvoiceDate": "2011-01-02 00:00:30"}, {"InvoiceDate": "2011-01-01 23:59:30", "StockCode": "2"})})
    core_tables = core_ops.build_core(cleaned, SYSTEM, STAMP)
    days = marts.customer_daily(core_tables["invoice_lines"], core_tables["invoices"]).collect()
    assert [(r["calendar_day"], r["order_frequency"]) for r in days] == [(date(2011, 1, 1), 1)]
    assert core_tables["invoices"].first()["invoice_date"] == datetime(2011, 1, 1, 23, 59, 30)
