"""The registered queries: contract, oracle agreement on the smallest data, and plan shapes."""

from __future__ import annotations

import re

import pytest
from oracle_check import compare, duck

from conftest import SMALL
from ledgerloom.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()

@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_every_operator_family_is_covered():
    wanted = {
        "i": 11, "c": 15, "b": 11, "m": 4, "e": 11, "d": 22, "k": 6, "a": 22, "x": 14,
    }
    for family, last in wanted.items():
        numbers = {int(m.group(1)) for n in QUERIES if (m := re.match(rf"{family}(\d\d)_", n))}
        assert numbers >= set(range(1, last + 1)), family
    assert {int(n[1:3]) for n in QUERIES if re.match(r"q\d\d_", n)} == set(range(1, 59))
    assert {int(n[1:3]) for n in QUERIES if re.match(r"r\d\d_", n)} == set(range(5))
    assert {int(n[1:3]) for n in QUERIES if re.match(r"f\d\d_", n)} == {1, 2, 3}


@pytest.mark.parametrize(
    "name",
    [
        "c15_clean_ledger", "b04_customers", "b05_products", "b06_invoices", "b10_invoice_lines", "m02_daily_sales",
        "m03_customer_daily", "m04_customer_snapshot", "m05_sql_over_views", "f01_customer_features",
        "d03_sales_kpis_filtered", "d11_rfm_segments", "d12_resample_weekly", "d16_segment_summary", "e10_sparsity_and_long_tail",
        "x08_reconciliation_tree", "a09_duplicate_scopes", "a12_issue_table", "q45_row_fingerprint",
        "q54_core_checks_on_damaged_core",
    ],
)
def test_query_equals_its_oracle(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SMALL) is None


def test_entry_returns_the_flagship_row(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert len(entry.entry(spark).collect()) == 1


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted_plan(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


FACT_GRAIN = [
    "c15_clean_ledger", "b01_source_row_number", "b04_customers", "b05_products", "b06_invoices", "b10_invoice_lines",
    "m01_eligible_lines", "m02_daily_sales", "m03_customer_daily", "m04_customer_snapshot", "f01_customer_features",
    "d10_rfm_snapshot", "x11_demand_weekly", "x13_lifetime_return_rate", "q45_row_fingerprint",
]


@pytest.mark.parametrize("name", FACT_GRAIN)
def test_no_fact_sized_data_is_gathered_in_one_task(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "SinglePartition" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas", plan)


def test_filters_and_columns_reach_the_scan(spark, house):
    from datetime import date

    from ledgerloom.operators import dashboard

    plan = formatted_plan(dashboard.sales_kpis(house.table("mart_daily_sales"), date(1996, 1, 1), None, "NATION_3"))
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(calendar_day,1996-01-01)" in pushed and "EqualTo(country,NATION_3)" in pushed
    mart = formatted_plan(house.build_mart("mart_customer_daily"))
    read = [line for line in mart.splitlines() if line.startswith("ReadSchema") and "line_total" in line]
    assert read and not any("description" in line or "source_file_sha256" in line for line in read)


def test_per_column_examples_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(QUERIES["a03_column_profile"](spark, SMALL))


def test_results_do_not_depend_on_partitioning(spark, house):
    from ledgerloom.operators import marts, rfm

    lines, invoices = house.table("invoice_lines"), house.table("invoices")
    plain = marts.customer_daily(lines, invoices)
    spread = marts.customer_daily(lines.repartition(7), invoices.repartition(3, "country"))
    assert plain.exceptAll(spread).count() == 0 and spread.exceptAll(plain).count() == 0
    snapshot = house.table("mart_customer_snapshot")
    one = rfm.rfm_scores(snapshot).select("customer_id", "rfm_score")
    other = rfm.rfm_scores(snapshot.repartition(5)).select("customer_id", "rfm_score")
    assert one.exceptAll(other).count() == 0
