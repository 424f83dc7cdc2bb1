from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import week_ending_monday
from ledgerloom.functions.expressions import round_half_even
from ledgerloom.functions.ranks import continuous_quantiles, exact_quantiles, group_ranks, scale_position, value_ranks


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(7)
    data = np.concatenate([rng.lognormal(2, 2, 3000).round(2), np.full(1500, 5.0)])
    keys = rng.integers(0, 3, len(data))
    frame = spark.createDataFrame(pd.DataFrame({"k": keys, "v": data})).repartition(5)
    return frame.cache(), pd.DataFrame({"k": keys, "v": data})


def test_ranks_equal_brute_force(values):
    frame, local = values
    got = {r["v"]: (r["n"], r["lo"], r["hi"], r["total"]) for r in value_ranks(frame, "v").collect()}
    low, high = local.v.rank(method="min"), local.v.rank(method="max")
    want = {v: (int(h - l + 1), int(l), int(h), len(local)) for v, l, h in zip(local.v, low, high)}
    assert got == want


def test_ranks_of_extreme_and_close_values(spark):
    numbers = [0.0, -0.0, 1e-300, -1e-300, 1e-12, 2e-12, 1.0, 1.0 + 2**-52, -1.0, 5e9, 5e9 + 1, 1e308, -1e308, float("inf"), float("-inf")]
    frame = spark.createDataFrame([(v,) for v in numbers + [1.0, None]], "v double")
    got = {r["v"]: (r["lo"], r["hi"]) for r in value_ranks(frame, "v").collect()}
    local = pd.Series(numbers + [1.0])
    low, high = local.rank(method="min"), local.rank(method="max")
    assert got == {v: (int(l), int(h)) for v, l, h in zip(local, low, high)}


def test_scale_never_falls(spark):
    numbers = sorted(np.random.default_rng(3).normal(0, 1, 4000) * 10.0 ** np.random.default_rng(4).integers(-20, 20, 4000))
    places = [r[0] for r in spark.createDataFrame([(float(v),) for v in numbers], "v double").coalesce(1).select(scale_position(F.col("v"))).collect()]
    assert places == sorted(places)


def test_only_coarse_buckets_meet_in_one_task(values):
    plan = value_ranks(values[0], "v")._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(single) <= 1 and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    keyed = value_ranks(values[0], "v", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in keyed


def test_quantiles_equal_numpy_overall_and_per_key(values):
    frame, local = values
    levels = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.999, "e": 1.0}
    got = exact_quantiles(frame, "v", levels).first()
    for name, level in levels.items():
        assert got[name] == pytest.approx(np.quantile(local.v, level), abs=1e-9)
    per_key = continuous_quantiles(value_ranks(frame, "v", ["k"]), "v", {"m": 0.5}, ["k"])
    assert {r["k"]: pytest.approx(r["m"]) for r in per_key.collect()} == local.groupby("k").v.median().to_dict()


def test_week_ends_on_monday_like_a_calendar_resample(spark):
    days = pd.date_range("2010-01-01", periods=30)
    want = {d.date(): (d + pd.offsets.Week(0, weekday=0)).date() for d in days}
    frame = spark.createDataFrame([(d.date(),) for d in days], "d date")
    got = {r["d"]: r["w"] for r in frame.select("d", week_ending_monday(F.col("d")).alias("w")).collect()}
    assert got == want


def test_price_rounding_follows_the_binary_value(spark):
    frame = spark.createDataFrame([(0.105,), (0.115,), (2.675,), (1.005,), (-0.105,)], "x double")
    got = [r[0] for r in frame.select(round_half_even(F.col("x"), 2)).collect()]
    assert got == pd.Series([0.105, 0.115, 2.675, 1.005, -0.105]).round(2).tolist()


def test_group_ranks_equal_value_ranks_in_two_shuffles(spark, values):
    frame, _ = values
    odd = spark.createDataFrame([(None, 1.0), (7, None), (8, 2.0), (8, 2.0), (8, -1.0)], "k long, v double")
    both = frame.select(F.col("k").cast("long").alias("k"), "v").unionByName(odd)
    rows = lambda found: sorted(map(tuple, found.select("k", "v", "n", "lo", "hi", "total").collect()))
    grouped = group_ranks(both, "v", ["k"])
    assert rows(grouped) == rows(value_ranks(both, "v", ["k"])) and {r[0] for r in rows(grouped)} >= {0, 1, 2, 8}
    assert grouped._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2


def test_product_medians_take_two_shuffles_of_prices(house):
    from ledgerloom.operators import core

    plan = core.build_products(house.clean(), "s", "f")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 5
