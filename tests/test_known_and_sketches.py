"""Attributes as known on a day, mergeable summaries, and summaries shared by checks."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import cleaning, known_at, sketches
from ledgerloom.operators.quality import core_checks


def lines(ledger):
    rnd = random.Random(2)
    rows = [{"Invoice": str(i), "InvoiceDate": str(date(2011, 1, 1) + timedelta(rnd.randint(0, 40))), "Customer ID": str(rnd.randint(1, 4)),
             "Country": rnd.choice(["UK", "FR", "DE"])} for i in range(120)]
    rows += [{"Invoice": "a", "Customer ID": None}, {"Invoice": "b", "Customer ID": "9", "InvoiceDate": "2011-02-01", "Country": None}]
    return cleaning.clean_ledger(ledger(*rows).withColumn("source_sheet", F.lit("s")))


def leading(rows, customer, day):
    """Most lines up to the day, the last position on a tie."""
    counts, last = Counter(), {}
    for r in rows:
        if r["Customer ID"] == customer and r.InvoiceDate.date() <= day and r.Country is not None:
            counts[r.Country] += 1
            last[r.Country] = max(last.get(r.Country, -1), r.source_order)
    return max(counts, key=lambda c: (counts[c], last[c])) if counts else ""


def test_country_on_every_day_equals_a_recount(spark, ledger):
    clean = lines(ledger).cache()
    changes = known_at.country_changes(clean)
    rows = clean.collect()
    days = [date(2010, 12, 31) + timedelta(k) for k in range(45)]
    wanted = spark.createDataFrame([(c, d) for c in (1, 2, 3, 4, 9) for d in days], "customer_id long, as_of date")
    got = {(r.customer_id, r.as_of): r.primary_country for r in known_at.attributes_at(changes, wanted).collect()}
    first = {c: min(r.InvoiceDate.date() for r in rows if r["Customer ID"] == c) for c in (1, 2, 3, 4, 9)}
    assert got == {(c, d): leading(rows, c, d) for c in first for d in days if d >= first[c]}
    ranges = sorted((r.customer_id, r.known_from, r.known_to) for r in changes.collect())
    for one, two in zip(ranges, ranges[1:]):
        assert one[2] == (two[1] if one[0] == two[0] else None)  # ranges meet and do not overlap
    assert any(r[2] for r in ranges)


def test_features_for_many_days_know_nothing_later(spark, house):
    daily, changes = house.table("mart_customer_daily"), known_at.country_changes(house.clean())
    days = [date(1998, 3, 31), date(2000, 6, 30)]
    both = known_at.features_at(daily, changes, days)
    for day in days:
        cut = house.clean().where(F.to_date("InvoiceDate") <= F.lit(day))
        alone = known_at.features_at(daily.where(F.col("calendar_day") <= F.lit(day)), known_at.country_changes(cut), [day])
        part = both.where(F.col("reference_date") == F.lit(day))
        assert part.count() > 0 and part.exceptAll(alone).count() == 0 and alone.exceptAll(part).count() == 0


def test_merged_sketches_stay_within_their_bounds(spark):
    rnd = random.Random(1)
    rows = [(date(2020, 1, 1) + timedelta(k % 60), rnd.lognormvariate(3, 2), rnd.randint(1, 30_000), f"ns{k % 2}") for k in range(60_000)]
    rows += [(date(2020, 1, 5), None, None, "ns0")] + [(date(2020, 1, 6), 7.0, 1, "ns1")] * 3000
    frame = spark.createDataFrame(rows, "d date, v double, customer_id long, source_system string").repartition(6)
    levels = {"p1": 0.01, "p50": 0.5, "p99": 0.99}
    period = F.lit("all")
    daily = sketches.daily_value_sketches(frame, "d", "v", ["source_system"])
    found = sketches.period_quantiles(daily, period, levels)
    assert found.first().value_count == 63_000
    assert sketches.rank_error(frame, period, "v", found, levels).first().rank_error <= sketches.RANK_ERROR
    per_space = sketches.period_quantiles(daily, period, levels, ["source_system"])
    assert {r.source_system: r.value_count for r in per_space.collect()} == {"ns0": 30_000, "ns1": 33_000}

    months = sketches.period_customers(sketches.daily_customer_sketches(frame, "d"), F.date_format("day", "yyyy-MM"))
    exact = {m: {r[2] for r in rows if r[0].strftime("%Y-%m") == m and r[2]} for m in ("2020-01", "2020-02")}
    got = {r.period: r.active_customers for r in months.collect()}
    assert all(abs(got[m] - len(exact[m])) <= sketches.SET_ERROR * len(exact[m]) for m in exact)
    kept = sketches.retained_customers(months).first()
    overlap, union = exact["2020-01"] & exact["2020-02"], exact["2020-01"] | exact["2020-02"]
    assert abs(kept.retained - len(overlap)) <= sketches.SET_ERROR * len(union)


def test_small_sets_are_exact_and_empty_periods_are_absent(spark):
    frame = spark.createDataFrame([(date(2020, 1, 1 + k % 3), k % 50) for k in range(500)], "d date, customer_id long")
    all_days = sketches.period_customers(sketches.daily_customer_sketches(frame, "d"), F.lit("x"))
    assert all_days.first().active_customers == 50
    assert sketches.period_customers(sketches.daily_customer_sketches(frame.limit(0), "d"), F.lit("x")).count() == 0


def test_checks_give_the_same_from_shared_and_from_own_summaries(spark, house):
    core = core_checks.in_namespace(house.core(), "LEDGER")
    core["invoices"] = core["invoices"].where("total_line_count % 7 <> 3").unionByName(core["invoices"].where("total_line_count % 5 = 1"))
    core["customers"] = core["customers"].where("customer_id % 9 <> 2").unionByName(core["customers"].where("customer_id % 11 = 1"))
    shared = core_checks.with_shared_parts(core)
    names = ["integrity.invoice_lines.customers", "integrity.invoice_lines.invoices", "integrity.line_header_customer", "financial.invoice_ledger",
             "business.invoice_type", "financial.customer_merchandise", "integrity.join_fanout"]
    for name in names:
        assert core_checks.CHECKS[name](shared).collect() == core_checks.CHECKS[name](core).collect()
    lines = core["invoice_lines"]
    joined = (
        lines.join(core["products"].select("stock_code"), "stock_code").join(core["invoices"].select("invoice_number"), "invoice_number")
        .join(core["customers"].select("customer_id"), "customer_id", "left").count()
    )
    assert core_checks.CHECKS["integrity.join_fanout"](core).first().actual == pytest.approx(abs(joined - lines.count()))
