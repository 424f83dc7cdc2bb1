from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.expressions import count_if, is_fractional
from ledgerloom.operators.cleaning import clean_ledger, clean_sheets, duplicate_counters, duplicate_groups, normalise
from ledgerloom.operators.validation import validate_ledger, validation_report
from ledgerloom.schema import CLEAN_COLUMNS, FLAG_COLUMNS


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy("source_order").select(*columns).collect()]


def test_cross_sheet_copies_go_and_within_sheet_copies_stay(ledger):
    cleaned = clean_sheets({"a": ledger({}, {}), "b": ledger({}, {"Invoice": "C2", "Quantity": "-1"})})
    assert cleaned.count() == 3
    assert cleaned.where("is_duplicate_within_sheet").count() == 2
    assert cleaned.where("is_duplicate_cross_sheet").count() == 2
    assert cleaned.where("is_return").count() == 1
    assert [c for c in cleaned.columns if c != "source_order"] == CLEAN_COLUMNS


def test_first_sheet_is_the_first_given_not_the_first_by_name(ledger):
    cleaned = clean_sheets({"z": ledger({}), "a": ledger({}, {"Invoice": "9"})})
    kept = {(r["Invoice"], r["source_sheet"]) for r in cleaned.collect()}
    assert kept == {("1", "z"), ("9", "a")}


def test_null_equals_null_in_duplicates(ledger):
    guest = {"Customer ID": None, "Description": None}
    cleaned = clean_sheets({"a": ledger(guest, guest), "b": ledger(guest)})
    assert cleaned.count() == 2
    assert cleaned.where("is_duplicate_within_sheet AND is_duplicate_cross_sheet").count() == 2


def test_transaction_flags(ledger):
    cleaned = clean_ledger(
        ledger(
            {"Invoice": "C100", "Quantity": "-1"},
            {"Invoice": "2", "Quantity": "-1"},
            {"Invoice": "a100"},
            {"Invoice": "4", "StockCode": "POST", "Description": None, "Quantity": "-1", "Price": "0", "Customer ID": None},
            {"Invoice": "5", "Price": "-1"},
        )
    ).collect()
    by_invoice = {r["Invoice"]: r for r in cleaned}
    cancelled = by_invoice["C100"]
    assert cancelled["is_cancellation"] and cancelled["is_return"] and not cancelled["is_inventory_adjustment"]
    assert by_invoice["2"]["is_negative_quantity"] and not by_invoice["2"]["is_return"]
    assert by_invoice["a100"]["is_bad_debt_adjustment"] and not by_invoice["a100"]["is_valid_sale"]
    stock = by_invoice["4"]
    assert stock["is_inventory_adjustment"] and stock["is_non_product"] and stock["is_price_zero"]
    assert by_invoice["5"]["is_price_negative"] and not by_invoice["5"]["has_valid_price"]


def test_codes_are_trimmed_upper_cased_and_null_stays_null(ledger):
    codes = [" gift_0001_abc ", "post", "\tm\u00a0", " BANK CHARGES", "dcgs0058", None]
    cleaned = clean_ledger(ledger(*[{"Invoice": str(i), "StockCode": c} for i, c in enumerate(codes)]))
    assert rows(cleaned, "StockCode", "is_non_product") == [
        ("GIFT_0001_ABC", True), ("POST", True), ("M", True), ("BANK CHARGES", True), ("DCGS0058", False), (None, False),
    ]


def test_missing_customer_and_description_are_kept(ledger):
    row = clean_ledger(ledger({"Customer ID": None, "Description": None})).first()
    assert not row["has_customer_id"] and not row["has_description"] and row["is_valid_sale"]


def test_unreadable_cells_become_null_and_flags_false(ledger):
    row = clean_ledger(ledger({"Quantity": "many", "Price": "x", "InvoiceDate": "soon", "Customer ID": "?"})).first()
    assert row["Quantity"] is None and row["Price"] is None and row["InvoiceDate"] is None and row["Customer ID"] is None
    assert not any(row[f] for f in FLAG_COLUMNS if f not in ("has_description",))


def test_validation_names_every_problem(ledger):
    report = validate_ledger(normalise(ledger({}, {"InvoiceDate": "bad"}, {"Quantity": "x"})))
    assert not report["is_valid"]
    assert report["errors"] == "invalid_datetime:1; non_numeric_quantity:1"
    with pytest.raises(ValueError, match="invalid_datetime"):
        validate_ledger(ledger({"InvoiceDate": "bad"}), raise_on_error=True)


def test_validation_reports_missing_columns_flags_rows_and_dates(ledger):
    cleaned = clean_ledger(ledger({}))
    good = validate_ledger(cleaned, raw_rows=2, removed_rows=1, require_flags=True)
    assert good["is_valid"] and good["errors"] == ""
    bad = validate_ledger(cleaned.drop("is_valid_sale", "Country"), raw_rows=5, removed_rows=1, require_flags=True)
    assert bad["errors"] == "missing_columns:Country; missing_flags:is_valid_sale; row_reconciliation:1!=4"
    moved = validation_report(cleaned, date_min="2010-01-01 00:00:00").first()["errors"]
    assert moved.startswith("date_min_changed:2011-01-01")


def test_missing_source_column_is_an_error(ledger):
    with pytest.raises(ValueError, match="Price"):
        clean_ledger(ledger({}).drop("Price"))


def test_one_group_of_copies_may_dominate(spark, ledger):
    """Most of the ledger is one repeated row; counting must not gather it in one place."""
    one = ledger({}).first().asDict()
    many = spark.range(20_000).select(
        *[F.lit(value).alias(name) for name, value in one.items()],
        F.lit("s").alias("source_sheet"),
        F.col("id").alias("source_order"),
    )
    groups = duplicate_groups(normalise(many))
    assert [r["copies"] for r in groups.collect()] == [20_000]
    assert duplicate_counters(many).first()["within_sheet_duplicates_detected"] == 20_000


def test_cells_that_are_no_numbers_or_dates(spark, ledger):
    rows = ledger(
        {"Invoice": "1", "Quantity": "NaN", "Price": "NaN"}, {"Invoice": "2", "Customer ID": "12345.7"}, {"Invoice": "3", "Customer ID": "NaN"},
        {"Invoice": "4", "InvoiceDate": "12/1/2010 8:26"}, {"Invoice": "5", "InvoiceDate": "1/31/2011"}, {"Invoice": "6", "InvoiceDate": "31/1/2011"},
        {"Invoice": "7", "Customer ID": "12345.0"}, {"Invoice": "8", "Customer ID": "1e30"},
    )
    got = {r["Invoice"]: r for r in clean_ledger(rows).collect()}
    assert got["1"]["Quantity"] is None and got["1"]["Price"] is None and not got["1"]["has_valid_price"] and not got["1"]["is_valid_sale"]
    assert [got[k]["Customer ID"] for k in "2378"] == [None, None, 12345, None]
    assert [str(got[k]["InvoiceDate"]) for k in "456"] == ["2010-12-01 08:26:00", "2011-01-31 00:00:00", "None"]
    counted = rows.agg(count_if(is_fractional(rows, "Customer ID")).alias("n")).first()["n"]
    assert counted == 2
    assert "non_numeric_quantity:1" in validation_report(rows).first()["errors"]
