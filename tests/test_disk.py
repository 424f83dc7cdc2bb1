"""What staging shuffles is narrow and leaves the disks when its step is done. Rows are built here."""

from __future__ import annotations

import pathlib
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_staging import order_tables, plan_of

from ledgerloom.plans import warehouse
from ledgerloom.plans.registry import _made
from ledgerloom.schema import LEDGER_COLUMNS
from ledgerloom.session import _RELEASE, shuffles_released
from ledgerloom.sources import adapter
from ledgerloom.sources.sheets import read_sheets, snapshot_sheets, write_raw_snapshot


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p.name for folder in folders for p in pathlib.Path(folder).glob("*/shuffle_*")}


def left_over(spark, before: set[str]) -> set[str]:
    for _ in range(50):  # files go a moment after the action
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_a_staged_table_leaves_no_shuffle_files(spark, tmp_path):
    order_tables(spark, tmp_path)
    house = warehouse.Warehouse(spark, str(tmp_path), root=f"{tmp_path}/staged")
    before = shuffle_files(spark)
    for name in warehouse.MARTS:
        house.table(name)
    house.core()
    assert not left_over(spark, before)
    assert house.table("mart_customer_snapshot").count() > 0 and spark.conf.get(_RELEASE, None) is None


def test_blocks_that_release_shuffles_overlap(spark):
    session = spark.newSession()
    rows = session.range(100).repartition(3)
    before = shuffle_files(spark)
    first, second = shuffles_released(session), shuffles_released(session)
    first.__enter__(), second.__enter__()
    first.__exit__(None, None, None)
    assert session.conf.get(_RELEASE) == "true"
    assert rows.groupBy("id").count().count() == 100 and not left_over(spark, before)
    second.__exit__(None, None, None)
    assert session.conf.get(_RELEASE, None) is None
    session.conf.set(_RELEASE, "false")
    with pytest.raises(ValueError), shuffles_released(session):
        raise ValueError
    assert session.conf.get(_RELEASE) == "false"


def test_lines_get_copies_and_countries_in_their_last_task(spark, tmp_path):
    """Every placement: before, in and after the month of both sheets, once and twice."""
    order_tables(spark, tmp_path / "given")
    dates = [datetime(1998, 5, 31, 23), datetime(1998, 6, 1), datetime(1998, 6, 30, 23), datetime(1998, 7, 1), None]
    orders = [(i * 50 // 2, i, dates[i % 5], ["4-NOT SPECIFIED", "1-URGENT", None][i % 3]) for i in range(60)]
    lines = [(o[0], o[1] % 41, o[1] % 5, n, 2.0, 3.0, 0.0, 0.0, "RAN"[n % 3], "OF"[o[1] % 2], None) for o in orders for n in (1, 2, 7)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    schema = spark.read.parquet(f"{tmp_path}/given/lineitem.parquet").schema
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("part", "nation"):
        spark.read.parquet(f"{tmp_path}/given/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = adapter.placed_lines(spark, str(tmp_path), 3)
        plan = plan_of(placed)
        assert plan.index("n_nationkey") < plan.index("p_name", plan.index("Exchange")) and "BroadcastHashJoin" in plan.split("SortMergeJoin")[0]
        assert placed.where(F.spark_partition_id() != F.col("task")).count() == 0
        write_raw_snapshot(placed, f"{tmp_path}/raw", adapter.SOURCE_ORDER, len(lines), task="task", parted=True, finish=warehouse._ledger)
        got = read_sheets(spark, snapshot_sheets(f"{tmp_path}/raw", adapter.SHEETS), snapshot=True)
        wanted = spark.sql(adapter.ADAPTER_SQL, **{t: spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in adapter.ADAPTER_TABLES})
        names = [c for c in wanted.columns if c not in adapter.SOURCE_ORDER and c != "source_sheet"]
        for sheet in adapter.SHEETS:
            expected = wanted.where(F.col("source_sheet") == sheet).orderBy(*adapter.SOURCE_ORDER).select(*names).collect()
            assert len(expected) > 60
            assert got.where(F.col("source_sheet") == sheet).orderBy("source_order").select(*[f"`{c}`" for c in LEDGER_COLUMNS]).collect() == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_query_shuffles_nothing_that_stays_before_its_result_is_asked_for(spark, tmp_path):
    order_tables(spark, tmp_path)
    before = shuffle_files(spark)
    made = _made(lambda w: w.spark.createDataFrame(w.spark.range(100).repartition(3).groupBy("id").count().collect()), spark, str(tmp_path))
    assert not left_over(spark, before) and made.count() == 100
