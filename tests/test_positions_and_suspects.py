"""Numbers without moving rows, and duplicates found behind a set filter."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import cleaning, core
from ledgerloom.sources.sheets import sheet_position


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def positions(spark, holes):
    """Two sheets of several files; ``holes`` decides which rows were removed."""
    rnd = random.Random(3)
    rows = [(s, f, r) for s in range(2) for f, n in enumerate((700, 1, 64, 333)) for r in range(n)]
    rows = [x for x in rows if not holes(rnd, x)]
    frame = spark.createDataFrame(rows, "s int, f long, r long")
    order = F.when(F.col("s") == 0, sheet_position(0, F.col("f"), F.col("r"))).otherwise(sheet_position(1, F.col("f"), F.col("r")))
    return rows, frame.select(F.concat(F.lit("S"), "s").alias("source_sheet"), order.alias("source_order"), "s", "f", "r")


@pytest.mark.parametrize("bits", [6, 8, 15])
@pytest.mark.parametrize(
    "holes",
    [
        lambda rnd, x: False,
        lambda rnd, x: rnd.random() < 0.4,
        lambda rnd, x: x[2] < 130,  # whole words and blocks are missing
        lambda rnd, x: x[0] == 1 and x[1] == 0,  # a whole file
    ],
)
def test_numbers_are_ranks_of_positions(spark, monkeypatch, bits, holes):
    monkeypatch.setattr(core, "BLOCK_BITS", bits)
    rows, frame = positions(spark, holes)
    got = {(r.s, r.f, r.r): r.source_row_number for r in core.number_rows(frame.repartition(5)).collect()}
    assert got == {x: sum(y[0] == x[0] and y <= x for y in rows) for x in rows}


def test_numbering_moves_no_rows(spark, house):
    rows = core.core_rows(house.clean())
    numbered = plan_of(core.number_rows(rows))
    assert "Exchange hashpartitioning" not in numbered and "rangepartitioning" not in numbered and "Window" not in numbered
    index = plan_of(core.position_index(rows))
    scans = re.findall(r"ReadSchema: (struct<[^\n]*)", index)
    assert scans and all(set(re.findall(r"(\w+):", s)) <= {"source_sheet", "source_order"} for s in scans)


def test_only_suspects_are_shuffled_in_full(spark, house):
    rows = cleaning.normalise(house.raw())
    clear = plan_of(cleaning.split_suspects(rows).where("not _suspect"))
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", clear)
    assert "BroadcastHashJoin" in clear and set(keys) <= {"_hash", "_groupingexpression"}  # narrow rows only
    share = cleaning.split_suspects(rows).where("_suspect").count() / rows.count()
    assert 0 < share < 0.2


def copies(ledger):
    rows = [{"Invoice": str(i)} for i in range(40)]
    rows += [{"Invoice": "7"}, {"Invoice": "7"}, {"Invoice": "9", "Description": None}, {"Invoice": "9", "Description": None}]
    return ledger(*rows)


@pytest.mark.parametrize("bits", [26, 6])
def test_flags_do_not_depend_on_the_filter(spark, ledger, monkeypatch, bits):
    """A filter of one word lets every row through; the real columns decide."""
    monkeypatch.setattr(cleaning, "FILTER_BITS", bits)
    first, second = copies(ledger), ledger({"Invoice": "3"}, {"Invoice": "100"}, {"Invoice": "100"}, {"Invoice": "9", "Description": None})
    kept = cleaning.clean_sheets({"a": first, "b": second})
    flags = {
        (r.source_sheet, r.Invoice, r.Description): (r.is_duplicate_within_sheet, r.is_duplicate_cross_sheet)
        for r in kept.where("is_duplicate_within_sheet or is_duplicate_cross_sheet").collect()
    }
    assert flags == {
        ("a", "7", "Widget"): (True, False), ("a", "9", None): (True, True), ("a", "3", "Widget"): (False, True), ("b", "100", "Widget"): (True, False),
    }
    assert kept.count() == 44 + 2
    suspects = cleaning.split_suspects(cleaning.normalise(first.withColumn("source_sheet", F.lit("a")))).where("_suspect").count()
    assert suspects == (44 if bits == 6 else 5) or bits == 6 and suspects > 5


def test_the_filter_is_small_whatever_the_ledger(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "FILTER_BITS", 10)
    hashed = spark.range(100_000).select(F.xxhash64(F.col("id") % 50_000).alias("_hash"))
    assert cleaning.suspect_filter(hashed).count() <= 1 << (10 - 6)
