from __future__ import annotations

from datetime import date
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import clustering, dashboard, eda, features, rfm

D = Decimal
SALES = "calendar_day date, country string, is_physical_merchandise boolean, gross_sales decimal(14,2), valid_sales_revenue decimal(14,2), return_value decimal(14,2), net_sales decimal(14,2), distinct_invoices long, units_sold long, units_returned long"
SNAPSHOT = "customer_id long, primary_country string, recency_days int, frequency long, monetary decimal(14,2), average_order_value decimal(14,2), tenure_days int, first_purchase_date date, last_purchase_date date"


@pytest.fixture(scope="module")
def sales(spark):
    def row(day, country, physical, gross, back, invoices, sold, returned):
        return (date.fromisoformat(day), country, physical, D(gross), D(gross), D(back), D(gross) + D(back), invoices, sold, returned)

    return spark.createDataFrame(
        [
            row("2010-01-01", "UK", True, 1000, -100, 10, 100, 10),
            row("2010-01-01", "UK", False, 50, 0, 2, 2, 0),
            row("2010-01-05", "France", True, 300, -50, 3, 30, 5),
            row("2010-01-20", "UK", True, 400, 0, 4, 40, 0),
        ],
        SALES,
    )


@pytest.fixture(scope="module")
def snapshot(spark):
    return spark.createDataFrame(
        [
            (1, "UK", 5, 12, D(1200), D(100), 300, date(2010, 1, 1), date(2010, 12, 1)),
            (2, "UK", 50, 2, D(500), D(250), 200, date(2010, 1, 1), date(2010, 10, 1)),
            (3, "France", 90, 1, D(250), D(250), 90, date(2010, 9, 1), date(2010, 9, 1)),
            (4, "France", None, 0, D(0), None, None, None, None),
        ],
        SNAPSHOT,
    )


def test_sales_kpis(sales):
    row = dashboard.sales_kpis(sales).first()
    assert (row["gross_sales"], row["return_value"], row["net_sales"], row["invoice_segments"]) == (1750, -150, 1600, 19)
    assert (row["net_aov"], row["return_rate_pct"]) == (84.21, 8.57)
    one_day = dashboard.sales_kpis(sales, date(2010, 1, 1), date(2010, 1, 1), "UK").first()
    assert (one_day["gross_sales"], one_day["net_sales"], one_day["invoice_segments"]) == (1050, 950, 12)
    empty = dashboard.sales_kpis(sales, country="Nowhere").first()
    assert (empty["gross_sales"], empty["net_aov"], empty["return_rate_pct"]) == (0, 0.0, 0.0)
    assert dashboard.sales_kpis(sales, country="All").first() == row


def test_trend_resampling_fills_empty_weeks(sales):
    trend = dashboard.daily_sales_trend(sales)
    weeks = [(str(r["calendar_day"]), r["net_sales"]) for r in dashboard.resample_trend(trend, "Weekly").collect()]
    assert weeks == [("2010-01-04", 950), ("2010-01-11", 250), ("2010-01-18", 0), ("2010-01-25", 400)]
    local = trend.toPandas().assign(calendar_day=lambda d: pd.to_datetime(d.calendar_day), net_sales=lambda d: d.net_sales.astype(float))
    want = local.set_index("calendar_day").net_sales.resample("W-MON").sum()
    assert weeks == [(str(k.date()), v) for k, v in want.items()]
    months = dashboard.resample_trend(trend, "Monthly").collect()
    assert [(str(r["calendar_day"]), r["gross_sales"]) for r in months] == [("2010-01-01", 1750)]
    running = [r["cumulative_net_sales"] for r in dashboard.cumulative_net_sales(trend).collect()]
    assert running == [950, 1200, 1600]


def test_country_shares_use_the_given_total(sales):
    countries = dashboard.sales_by_country(sales, limit=1)
    assert dashboard.country_shares(countries, 1600).first()["market_share_pct"] == 84.38
    assert dashboard.country_shares(countries).first()["market_share_pct"] == 100.0
    assert dashboard.country_shares(countries, 0).first()["market_share_pct"] == 0.0


def test_customer_kpis_and_bins(snapshot):
    row = dashboard.customer_kpis(snapshot).first()
    assert (row["total_customers"], row["repeat_customers"], row["one_time_buyers"], row["repeat_rate_pct"]) == (4, 2, 1, 50.0)
    assert (row["total_customer_spend"], row["avg_aov"]) == (1950, 200.0)
    tiers = [r["customer_count"] for r in dashboard.frequency_tiers(snapshot).collect()]
    brackets = [r["customer_count"] for r in dashboard.monetary_brackets(snapshot).collect()]
    assert tiers == [1, 1, 1, 0, 1] and brackets == [1, 2, 1, 0, 0, 0]
    assert dashboard.frequency_tiers(snapshot.limit(0)).count() == 0


def rfm_frame(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, recency_days int, frequency long, monetary decimal(14,2)")


EIGHT = list(
    zip(range(1, 9), [2, 4, 8, 15, 30, 50, 80, 100], [12, 10, 8, 6, 4, 2, 1, 0], map(D, [500, 400, 300, 200, 100, 50, -10, 0]))
)


def brute_scores(values: pd.Series, ascending: bool) -> pd.Series:
    ranks = values.rank(method="first", ascending=ascending)
    cut = pd.qcut(ranks, 5, labels=False, duplicates="drop") + 1
    return cut.groupby(values).transform("median").round().astype(int)


@pytest.mark.parametrize("seed", range(3))
def test_scores_equal_brute_force_and_ignore_row_order(spark, seed):
    rng = np.random.default_rng(seed)
    n = 200 + seed
    local = pd.DataFrame(
        {
            "customer_id": range(n),
            "recency_days": rng.integers(0, 40, n),
            "frequency": rng.integers(1, 9, n),
            "monetary": rng.integers(-50, 400, n),
        }
    )
    frame = spark.createDataFrame(local.sample(frac=1, random_state=seed)).repartition(3)
    got = rfm.rfm_scores(frame).toPandas().sort_values("customer_id").reset_index(drop=True)
    assert got.recency_score.tolist() == brute_scores(local.recency_days, False).tolist()
    assert got.frequency_score.tolist() == brute_scores(local.frequency, True).tolist()
    assert got.monetary_score.tolist() == brute_scores(local.monetary, True).tolist()


def test_every_customer_gets_a_segment(spark):
    rows = {r["customer_id"]: r for r in rfm.snapshot_segments(rfm_frame(spark, EIGHT)).collect()}
    assert len(rows) == 8 and rows[8]["rfm_segment"] == "Lost Customers" and rows[8]["rfm_score"] == "111"
    assert rows[1]["rfm_segment"] == "Champions" and rows[7]["monetary"] == -10


def test_rfm_input_contract(spark):
    with pytest.raises(ValueError, match="active_without_recency"):
        rfm.require_rfm(rfm_frame(spark, [(1, None, 3, D(5))]))
    with pytest.raises(ValueError, match="customer_id_repeated"):
        rfm.require_rfm(rfm_frame(spark, [EIGHT[0], EIGHT[0]]))
    with pytest.raises(ValueError, match="missing"):
        rfm.require_rfm(rfm_frame(spark, EIGHT).drop("monetary"))


def test_one_active_customer_scores_one(spark):
    assert rfm.rfm_scores(rfm_frame(spark, EIGHT[:1])).first()["rfm_score"] == "111"


def test_scaling_keeps_raw_null_recency(spark):
    frame = rfm_frame(spark, EIGHT[:7] + [(8, None, 0, D(0))])
    scaled = rfm.scaled_features(frame).toPandas().set_index("customer_id")
    assert np.isnan(scaled.recency_days[8])
    filled = np.log1p(np.array([2, 4, 8, 15, 30, 50, 80, 81.0]))
    assert np.allclose(scaled.recency_scaled, (filled - filled.mean()) / filled.std())


def test_clusters_are_deterministic_and_profiled_on_raw_values(spark):
    frame = rfm_frame(spark, EIGHT)
    first, _ = clustering.fit_kmeans(frame, k=2, n_init=3)
    again, _ = clustering.fit_kmeans(frame, k=2, n_init=3)
    assert clustering.adjusted_rand_index(first, again).first()[0] == 1.0
    profile = clustering.profile_clusters(first).toPandas()
    assert profile.customer_count.sum() == 8
    local = first.toPandas().groupby("cluster").monetary.median()
    assert profile.median_monetary.tolist() == pytest.approx(local.tolist())
    table = clustering.compare_segments(rfm.snapshot_segments(frame), first, [0, 1]).toPandas()
    assert table[["cluster_0", "cluster_1"]].to_numpy().sum() == 8
    with pytest.raises(ValueError, match="differ"):
        clustering.compare_segments(rfm.snapshot_segments(frame), first.where("customer_id > 1"), [0, 1])


def test_evaluation_selects_and_bounds_k(spark):
    frame = rfm_frame(spark, EIGHT)
    table = clustering.evaluate_kmeans(frame, [2, 3], n_init=2)
    rows = table.collect()
    assert [r["k"] for r in rows] == [2, 3] and rows[1]["inertia"] <= rows[0]["inertia"]
    best = max(rows, key=lambda r: (r["silhouette_score"], -r["k"]))["k"]
    assert clustering.select_k(table).first()["k"] == best
    with pytest.raises(ValueError, match="each k"):
        clustering.evaluate_kmeans(frame, [8], n_init=1)


def test_rand_index_equals_pair_counting(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 3, 40), rng.integers(0, 4, 40)
    frames = [spark.createDataFrame([(i, int(c)) for i, c in enumerate(x)], "customer_id long, cluster int") for x in (a, b)]
    same = [(a[i] == a[j], b[i] == b[j]) for i in range(40) for j in range(i)]
    both, one, two = sum(x and y for x, y in same), sum(x for x, _ in same), sum(y for _, y in same)
    expected = one * two / len(same)
    want = (both - expected) / ((one + two) / 2 - expected)
    assert clustering.adjusted_rand_index(*frames).first()[0] == pytest.approx(want)


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        ({"customer_id": "CAST(1 AS BIGINT)"}, "customer_id_repeated"),
        ({"recency_days": "-1"}, "recency_negative"),
        ({"recency_days": "NULL"}, "active_without_recency"),
        ({"recency_days": "3"}, "inactive_with_recency"),
        ({"frequency": "CAST(NULL AS BIGINT)"}, "frequency_all_null"),
        ({"monetary": "CAST('Infinity' AS DOUBLE)"}, "non_finite"),
        ({"monetary": "'much'"}, "non_numeric"),
    ],
)
def test_feature_contract_rejects(snapshot, change, rule):
    frame = snapshot.withColumn("reference_date", F.lit(date(2011, 1, 1))).drop("first_purchase_date", "last_purchase_date")
    assert features.validate_features(frame) is frame
    for column, value in change.items():
        frame = frame.withColumn(column, F.expr(value))
    with pytest.raises(ValueError, match=rule):
        features.validate_features(frame)


def test_leakage_warning(spark):
    daily = spark.createDataFrame([(1, date(2011, 5, 1))], "customer_id long, calendar_day date")
    with pytest.warns(UserWarning, match="lifetime"):
        features.warn_on_leakage(daily, date(2011, 1, 1))


def test_spending_quantiles(snapshot):
    row = eda.spending_distribution(snapshot).first()
    assert (row["p50"], row["max_monetary"]) == (375.0, 1200)
