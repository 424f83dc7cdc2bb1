"""Checks and marts read and stage no more than they need. Rows are built here."""

from __future__ import annotations

from pyspark.sql import functions as F
from test_staging import order_tables, plan_of

from ledgerloom.operators import marts
from ledgerloom.operators.quality import core_checks, frames
from ledgerloom.plans.families import quality_queries
from ledgerloom.plans.warehouse import Warehouse
from ledgerloom.session import SPLIT_BYTES, limit_splits


def test_repeated_numbers_are_counted_in_words_of_64(spark):
    numbers = [*range(130), 5, 5, 129, None, None, -1, -1, -64, 1 << 40]
    rows = spark.createDataFrame([(s, n) for s in ("a", None) for n in numbers], "sheet string, number long")
    assert frames.extra_numbers(rows, ["sheet"], "number").first()["n"] == frames.extra_rows(rows, ["sheet", "number"]).first()["n"] == 10
    assert frames.extra_numbers(rows, [], "number").first()["n"] == frames.extra_rows(rows, ["number"]).first()["n"]
    assert frames.extra_numbers(rows.limit(0), [], "number").first()["n"] == 0


def test_line_numbers_are_not_shuffled_one_by_one(spark):
    lines = spark.range(1000).select(
        F.lit("L").alias("source_system"), F.lit("S").alias("source_sheet"), F.col("id").alias("line_id"), F.col("id").alias("source_row_number")
    )
    for name in ("uniqueness.invoice_lines.line_id", "uniqueness.invoice_lines.source_position"):
        check = core_checks.core_check({"invoice_lines": lines}, name, "L")
        assert "bit_or" in plan_of(check) and check.first()["status"] == "PASS"


def test_two_marts_share_the_sums_per_customer_and_day(spark, tmp_path, monkeypatch):
    order_tables(spark, tmp_path)
    house = Warehouse(spark, str(tmp_path), root=f"{tmp_path}/staged")
    calls, sums = [], marts.customer_daily
    monkeypatch.setattr(marts, "customer_daily", lambda *a, **b: calls.append(1) or sums(*a, **b))
    house.register_views()
    assert len(calls) == 1
    alone = house.build_mart("mart_customer_snapshot")
    held = house.table("mart_customer_snapshot")
    assert held.count() > 0 and alone.exceptAll(held).count() == held.exceptAll(alone).count() == 0


def test_a_mart_contract_stages_only_what_it_reads(spark, tmp_path):
    order_tables(spark, tmp_path)
    house = Warehouse(spark, str(tmp_path), root=f"{tmp_path}/staged")
    # An order without a date has no day to be found again on.
    found = {r["item"]: r["status"] for r in quality_queries.mart_result(house, "mart_customer_daily").collect()}
    assert found == {"repeated_grain": "PASS", "null_customers": "PASS", "broken_identity": "PASS", "differs_from_core": "FAIL"}
    assert not {"products", "customers", "mart_daily_sales", "mart_customer_snapshot"} & set(house._frames)


def test_a_split_of_staged_rows_is_small(spark, tmp_path):
    name = "spark.sql.files.maxPartitionBytes"
    session = spark.newSession()
    Warehouse(session, str(tmp_path))
    assert session.conf.get(name) == str(SPLIT_BYTES)
    session.conf.set(name, "1m")
    limit_splits(session)
    assert session.conf.get(name) == "1m"
