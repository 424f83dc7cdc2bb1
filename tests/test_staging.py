"""Staging steps move and scan the ledger no more often than they need to. Rows are built here."""

from __future__ import annotations

import pathlib
from datetime import datetime
from types import SimpleNamespace

from pyspark.sql import functions as F

from ledgerloom.functions import ranks
from ledgerloom.operators import cleaning, core
from ledgerloom.plans import warehouse
from ledgerloom.plans.families import ingest_and_cleaning
from ledgerloom.schema import LEDGER_COLUMNS
from ledgerloom.sources import adapter, sheets
from ledgerloom.sources.sheets import read_sheets, read_text_sheets, snapshot_sheets, write_raw_snapshot


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def order_tables(spark, folder):
    """Orders of 30 days, one of them twice and one without a date, with two lines each."""
    day = lambda i: None if i == 7 else datetime(1998, 6, 1 + i % 30)
    orders = [(i, i * 3, day(i), "4-NOT SPECIFIED" if i % 6 == 0 else "1-URGENT") for i in [*range(200), 11]]
    lines = [
        (i, (i * 7) % 41, i % 5, n, 2.0 + n, float(i), 0.1 * (i % 2), 0.0, "RAN"[(i + n) % 3], "OF"[i % 2], datetime(1998, 9, 1))
        for i in range(200) for n in (1, 7)
    ]
    moment = "timestamp_ntz"
    made = {
        "orders": (orders, f"o_orderkey long, o_custkey long, o_orderdate {moment}, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     f"l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate {moment}"),
        "part": ([(i, f"part {i}") for i in range(41)], "p_partkey long, p_name string"),
        "nation": ([(i, f"NATION_{i}") for i in range(25)], "n_nationkey long, n_name string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_lines_reach_their_snapshot_in_source_order_without_being_sampled(spark, tmp_path):
    order_tables(spark, tmp_path)
    tables = {t: spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in adapter.ADAPTER_TABLES}
    wanted = spark.sql(adapter.ADAPTER_SQL, **tables)
    names = [c for c in wanted.columns if c not in adapter.SOURCE_ORDER and c != "source_sheet"]
    tasks = sheets.snapshot_tasks(spark, 5)
    placed = adapter.placed_lines(spark, str(tmp_path), tasks)
    assert "rangepartitioning(o_orderdate" in plan_of(placed) and placed.select("task").distinct().count() > 1
    write_raw_snapshot(placed, f"{tmp_path}/raw", adapter.SOURCE_ORDER, 5, task="task", finish=warehouse._ledger)
    got = read_sheets(spark, snapshot_sheets(f"{tmp_path}/raw", adapter.SHEETS), snapshot=True)
    for sheet in adapter.SHEETS:
        expected = wanted.where(F.col("source_sheet") == sheet).orderBy(*adapter.SOURCE_ORDER).select(*names).collect()
        assert got.where(F.col("source_sheet") == sheet).orderBy("source_order").select(*[f"`{c}`" for c in LEDGER_COLUMNS]).collect() == expected


def test_the_ledger_is_scanned_once_to_be_flagged(spark, ledger, tmp_path):
    ledger({}, {}, {"Invoice": "2"}).withColumn("source_sheet", F.lit("s")).withColumn("source_order", F.monotonically_increasing_id()).write.parquet(
        f"{tmp_path}/flagged_ledger"
    )
    flagged = cleaning.flag_duplicates(cleaning.normalise(spark.read.parquet(f"{tmp_path}/flagged_ledger")))
    scans = [line for line in plan_of(flagged).splitlines() if "FileScan parquet" in line]
    assert len([line for line in scans if "_hash" not in line and "_bits" not in line]) == 1
    assert sorted((r.Invoice, r.is_duplicate_within_sheet) for r in flagged.collect()) == [("1", True), ("1", True), ("2", False)]


def test_invoices_are_built_in_one_shuffle(spark, ledger):
    rows = ledger({"Customer ID": None}, {"Country": "FR"}, {"Customer ID": "7"}, {"Invoice": "C2", "Quantity": "-3"})
    invoices = core.build_invoices(cleaning.clean_ledger(rows).localCheckpoint(), "X", "f")
    assert plan_of(invoices).count("Exchange hashpartitioning") == 1
    got = {r.invoice_number: (r.customer_id, r.country, r.invoice_type, r.total_line_count, r.total_quantity, float(r.total_invoice_amount)) for r in invoices.collect()}
    assert got == {"1": (12345, "UK", "SALE", 3, 3, 6.0), "C2": (12345, "UK", "CANCELLATION", 1, -3, -6.0)}


def test_text_files_follow_the_rows_and_their_rows_are_not_shuffled(spark, ledger, tmp_path, monkeypatch):
    monkeypatch.setattr(sheets, "ROWS_PER_TASK", 10)
    raw = ledger(*[{"Invoice": str(i)} for i in range(80)]).withColumn("source_order", F.monotonically_increasing_id())
    raw = raw.withColumn("source_sheet", F.when(F.col("source_order") < 70, "S1").otherwise("S2"))
    paths = ingest_and_cleaning._text_sheets(SimpleNamespace(spark=spark, root=str(tmp_path), _frames={}, raw=lambda: raw))
    assert len(list(pathlib.Path(paths["S1"]).glob("*.csv"))) == 7
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = read_text_sheets(spark, paths)
        assert "SortMergeJoin" not in plan_of(read)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    found = read.orderBy("_sheet", "_path", "_ordinal").select("Invoice").collect()
    assert [r.Invoice for r in found] == [str(i) for i in range(80)]


def test_a_staged_ledger_is_cleaned_in_two_scans(spark, ledger, tmp_path):
    rows = [{"Customer ID": None}, {"Customer ID": None}, {"Invoice": "2"}, {"Invoice": "C3", "Price": "x"}, {"Invoice": "2"}, {}]
    sheets_of = F.when(F.monotonically_increasing_id() < 4, "a").otherwise("b")
    ledger(*rows).withColumn("source_sheet", sheets_of).withColumn("source_order", F.monotonically_increasing_id()).write.parquet(f"{tmp_path}/rows")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    stored = spark.read.parquet(f"{tmp_path}/rows")
    counted = stored.mapInArrow(count, stored.schema)
    writers = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    staged = cleaning.write_clean_ledger(counted, f"{tmp_path}/clean")
    assert seen.value == 2 * len(rows) and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == writers
    expected = cleaning.clean_ledger(stored)
    assert staged.columns == expected.columns
    got = staged.orderBy("source_order").collect()
    assert got == expected.orderBy("source_order").collect() and len(got) == 5
    empty = cleaning.write_clean_ledger(stored.where("Invoice = 'none'"), f"{tmp_path}/empty")
    assert empty.count() == 0 and empty.columns == expected.columns


def test_prices_of_a_code_are_sorted_once(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 3.0), ("b", 2.0), ("b", None)], "k string, v double")
    ranked = ranks.group_ranks(rows, "v", ["k"])
    assert plan_of(ranked).count("Sort [") == 1
    got = sorted(tuple(r) for r in ranked.collect())
    assert got == [("a", 1.0, 2, 1, 2, 3), ("a", 3.0, 1, 3, 3, 3), ("b", 2.0, 1, 1, 1, 1)]


def test_staged_tables_are_packed(spark, tmp_path):
    order_tables(spark, tmp_path)
    house = warehouse.Warehouse(spark, str(tmp_path), root=f"{tmp_path}/staged")
    core_tables = house.core()
    assert core_tables["invoice_lines"].count() == house.clean().count() > 0
    written = [p.name for p in pathlib.Path(f"{tmp_path}/staged").rglob("*.parquet")]
    assert written and all(".zstd." in name for name in written)
