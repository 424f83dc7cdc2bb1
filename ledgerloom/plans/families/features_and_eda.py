"""F and E operators."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import functions as F

from ...operators import eda, features, known_at, sketches
from ..registry import day, query, real, whole

# A day inside the data, so that the as-of bound cuts rows.
FEATURE_DAY = date(2000, 6, 30)
_DAY = "DATE '2000-06-30'"

FEATURE_BLOCK = {
    "led_features": f"""
        SELECT c.customer_id, c.primary_country, {_DAY} AS reference_date,
            {_DAY} - a.last_day AS recency_days, coalesce(a.orders, 0) AS frequency,
            coalesce(a.net, 0) AS monetary,
            CASE WHEN a.orders > 0 THEN (2 * (a.gross * 100)::HUGEINT + a.orders) // (2 * a.orders) END::DOUBLE / 100
                AS average_order_value,
            {_DAY} - a.first_day AS tenure_days
        FROM core_customers AS c
        LEFT JOIN (
            SELECT customer_id, min(calendar_day) FILTER (is_valid_sale) AS first_day,
                max(calendar_day) FILTER (is_valid_sale) AS last_day,
                count(DISTINCT invoice_number) FILTER (is_valid_sale) AS orders,
                sum(line_total) FILTER (is_valid_sale) AS gross, sum(line_total) AS net
            FROM sales_lines WHERE customer_id IS NOT NULL AND calendar_day <= {_DAY} GROUP BY customer_id
        ) AS a USING (customer_id)
    """
}
_FEATURE_SELECT = f"""SELECT customer_id, primary_country, {day('reference_date')}, {whole('recency_days', 'frequency')},
    {real('monetary')}, average_order_value, {whole('tenure_days')} FROM led_features"""


def feature_frame(w):
    return features.customer_features(w.table("mart_customer_daily"), w.table("customers"), FEATURE_DAY)


def _unchecked_features(w):
    return features.customer_features(w.table("mart_customer_daily"), w.table("customers"), FEATURE_DAY, checked=False)


query("f01_customer_features", feature_frame, _FEATURE_SELECT, FEATURE_BLOCK)
query(
    "f02_feature_contract",
    lambda w: features.feature_violations(_unchecked_features(w)),
    """SELECT r.rule, CASE r.rule
            WHEN 'customer_id_null' THEN count_if(f.customer_id IS NULL)
            WHEN 'customer_id_repeated' THEN count(f.customer_id) - count(DISTINCT f.customer_id)
            WHEN 'frequency_negative' THEN count_if(f.frequency < 0)
            WHEN 'recency_negative' THEN count_if(f.recency_days < 0)
            WHEN 'tenure_negative' THEN count_if(f.tenure_days < 0)
            WHEN 'active_without_recency' THEN count_if(f.frequency > 0 AND f.recency_days IS NULL)
            WHEN 'inactive_with_recency' THEN count_if(f.frequency = 0 AND f.recency_days IS NOT NULL)
            WHEN 'frequency_all_null' THEN CASE WHEN count(f.frequency) = 0 THEN count(*) ELSE 0 END
            WHEN 'monetary_all_null' THEN CASE WHEN count(f.monetary) = 0 THEN count(*) ELSE 0 END
            ELSE 0 END::BIGINT AS violations
    FROM led_features AS f, (VALUES ('customer_id_null'), ('customer_id_repeated'), ('frequency_negative'),
        ('recency_negative'), ('tenure_negative'), ('active_without_recency'), ('inactive_with_recency'),
        ('frequency_all_null'), ('monetary_all_null'), ('non_numeric'), ('non_finite')) AS r(rule)
    GROUP BY r.rule""",
    FEATURE_BLOCK,
)
query(
    "f03_temporal_leakage",
    lambda w: features.dimension_leakage(w.table("mart_customer_daily"), FEATURE_DAY),
    f"""SELECT '2000-06-30' AS as_of, strftime(max(calendar_day), '%Y-%m-%d') AS data_end,
        max(calendar_day) > {_DAY} AS leaks_future FROM mart_buyer_day""",
)


# --- attributes as they were known on a day -----------------------------------------------------------

EARLIER_DAY = date(1998, 3, 31)
_KNOWN = {
    "asof_days": "SELECT unnest([DATE '1998-03-31', DATE '2000-06-30']) AS as_of",
    "asof_country": """
        SELECT customer_id, as_of, country FROM core_rows, asof_days WHERE customer_id IS NOT NULL AND invoice_date::DATE <= as_of
        GROUP BY customer_id, as_of, country
        QUALIFY row_number() OVER (PARTITION BY customer_id, as_of ORDER BY count(*) DESC, max(pos) DESC) = 1
    """,
    "asof_features": """
        SELECT k.customer_id, k.country AS primary_country, k.as_of AS reference_date, k.as_of - a.last_day AS recency_days,
            coalesce(a.orders, 0) AS frequency, coalesce(a.net, 0) AS monetary,
            CASE WHEN a.orders > 0 THEN (2 * (a.gross * 100)::HUGEINT + a.orders) // (2 * a.orders) END::DOUBLE / 100 AS average_order_value,
            k.as_of - a.first_day AS tenure_days
        FROM asof_country AS k
        LEFT JOIN (
            SELECT customer_id, as_of, min(calendar_day) FILTER (is_valid_sale) AS first_day, max(calendar_day) FILTER (is_valid_sale) AS last_day,
                count(DISTINCT invoice_number) FILTER (is_valid_sale) AS orders, sum(line_total) FILTER (is_valid_sale) AS gross, sum(line_total) AS net
            FROM sales_lines, asof_days WHERE customer_id IS NOT NULL AND calendar_day <= as_of GROUP BY customer_id, as_of
        ) AS a ON a.customer_id = k.customer_id AND a.as_of = k.as_of
    """,
    # the leading country after each day on which a customer has a line, from all lines up to it
    "asof_leading": """
        SELECT e.customer_id, e.day, r.country
        FROM (SELECT DISTINCT customer_id, invoice_date::DATE AS day FROM core_rows WHERE customer_id IS NOT NULL) AS e
        JOIN core_rows AS r ON r.customer_id = e.customer_id AND r.invoice_date::DATE <= e.day
        GROUP BY e.customer_id, e.day, r.country
        QUALIFY row_number() OVER (PARTITION BY e.customer_id, e.day ORDER BY count(*) DESC, max(r.pos) DESC) = 1
    """,
}


def _country_changes(w):
    return w.stage("country_changes", lambda: known_at.country_changes(w.clean()))


query(
    "f01_customer_features_as_known",
    lambda w: known_at.features_at(w.table("mart_customer_daily"), _country_changes(w), [EARLIER_DAY, FEATURE_DAY]),
    f"""SELECT customer_id, primary_country, {day('reference_date')}, {whole('recency_days', 'frequency')},
        {real('monetary')}, average_order_value, {whole('tenure_days')} FROM asof_features""",
    _KNOWN,
)
query(
    "f03_country_changes",
    _country_changes,
    f"""SELECT customer_id, primary_country, {day('known_from')}, strftime(lead(known_from) OVER (PARTITION BY customer_id ORDER BY known_from), '%Y-%m-%d') AS known_to
    FROM (
        SELECT customer_id, country AS primary_country, day AS known_from, lag(country) OVER (PARTITION BY customer_id ORDER BY day) AS before FROM asof_leading
    ) WHERE before IS NULL OR before <> primary_country""",
    _KNOWN,
)

# --- summaries per day that are merged for any period -------------------------------------------------

_YEAR, _MONTH = "yyyy", "yyyy-MM"
_LEVELS = {"p50": 0.5, "p95": 0.95}


def _sketched_quantiles(w):
    """Quantiles per year from the days' sketches, and whether their ranks are as near as promised."""
    mart = w.table("mart_daily_sales")
    found = sketches.period_quantiles(sketches.daily_value_sketches(mart, "calendar_day", "net_sales"), F.date_format("day", _YEAR), _LEVELS)
    errors = sketches.rank_error(mart.withColumn("day", F.col("calendar_day")), F.date_format("day", _YEAR), "net_sales", found, _LEVELS)
    return found.join(errors, "period").select("period", "value_count", (F.col("rank_error") <= sketches.RANK_ERROR).alias("within_bound"))


query(
    "e01_sales_distribution_sketched",
    _sketched_quantiles,
    "SELECT strftime(calendar_day, '%Y') AS period, count(*) AS value_count, TRUE AS within_bound FROM mart_daily GROUP BY ALL",
)


def _monthly_customers(w):
    daily = w.stage("customer_sketches", lambda: sketches.daily_customer_sketches(w.table("mart_customer_daily"), "calendar_day"))
    return sketches.period_customers(daily, F.date_format("day", _MONTH))


def _month_members(w):
    return w.table("mart_customer_daily").select(F.date_format("calendar_day", _MONTH).alias("period"), "customer_id").distinct()


def _active(w):
    exact = _month_members(w).groupBy("period").agg(F.count(F.lit(1)).alias("exact"))
    near = F.abs(F.col("active_customers") - F.col("exact")) <= sketches.SET_ERROR * F.col("exact")
    return _monthly_customers(w).join(exact, "period").select("period", F.col("exact").alias("active_customers"), near.alias("within_bound"))


def _retained(w):
    """Customers of two months running, from sketches, against the exact overlap; the error is relative to both months together."""
    months = _monthly_customers(w)
    kept = sketches.retained_customers(months)
    one, two = _month_members(w), _month_members(w).toDF("next_period", "customer_id")
    exact = kept.select("period", "next_period").join(one, "period").join(two, ["next_period", "customer_id"]).groupBy("period").agg(F.count(F.lit(1)).alias("exact"))
    sizes = one.groupBy("period").agg(F.count(F.lit(1)).alias("size"))
    joined = kept.join(exact, "period", "left").join(sizes, "period").join(sizes.toDF("next_period", "next_size"), "next_period")
    overlap = F.coalesce("exact", F.lit(0))
    near = F.abs(F.col("retained") - overlap) <= sketches.SET_ERROR * (F.col("size") + F.col("next_size") - overlap)
    return joined.select("period", "next_period", overlap.alias("retained"), near.alias("within_bound"))


_MONTHS = {"sk_months": "SELECT DISTINCT strftime(calendar_day, '%Y-%m') AS period, customer_id FROM mart_buyer_day"}
query(
    "x06_active_customers_sketched",
    _active,
    "SELECT period, count(*) AS active_customers, TRUE AS within_bound FROM sk_months GROUP BY period",
    _MONTHS,
)
query(
    "x06_retained_customers_sketched",
    _retained,
    """SELECT p.period, p.next_period, count(b.customer_id) AS retained, TRUE AS within_bound
    FROM (SELECT period, lead(period) OVER (ORDER BY period) AS next_period FROM (SELECT DISTINCT period FROM sk_months)) AS p
    JOIN sk_months AS a ON a.period = p.period LEFT JOIN sk_months AS b ON b.period = p.next_period AND b.customer_id = a.customer_id
    WHERE p.next_period IS NOT NULL GROUP BY p.period, p.next_period""",
    _MONTHS,
)


def _written_features(w):
    return features.write_features(feature_frame(w), f"{w.root}/customer_features")


query("i11_feature_sink", _written_features, _FEATURE_SELECT, FEATURE_BLOCK)

query(
    "e01_sales_distribution",
    lambda w: eda.sales_distribution(w.table("mart_daily_sales")),
    """SELECT count(*) AS day_count, min(net_sales)::DOUBLE AS min_net_sales,
        quantile_cont(net_sales::DOUBLE, 0.5) AS median_net_sales,
        quantile_cont(net_sales::DOUBLE, 0.95) AS p95_net_sales, max(net_sales)::DOUBLE AS max_net_sales
    FROM mart_daily""",
)
query(
    "e02_customer_transaction_behavior",
    lambda w: eda.customer_transaction_behavior(w.table("mart_customer_snapshot")),
    """SELECT count(*) AS customer_count, sum(frequency)::DOUBLE / count(frequency) AS average_frequency,
        sum(recency_days) FILTER (frequency > 0)::DOUBLE / count(recency_days) FILTER (frequency > 0) AS average_recency,
        sum(tenure_days) FILTER (frequency > 0)::DOUBLE / count(tenure_days) FILTER (frequency > 0) AS average_tenure
    FROM mart_snapshot""",
)
query(
    "e03_order_frequency",
    lambda w: eda.order_frequency(w.table("mart_customer_snapshot")),
    "SELECT frequency, count(*) AS customer_count FROM mart_snapshot GROUP BY frequency",
)
query(
    "e04_spending_distribution",
    lambda w: eda.spending_distribution(w.table("mart_customer_snapshot")),
    """SELECT quantile_cont(monetary::DOUBLE, 0.5) AS p50, quantile_cont(monetary::DOUBLE, 0.9) AS p90,
        quantile_cont(monetary::DOUBLE, 0.99) AS p99, max(monetary)::DOUBLE AS max_monetary FROM mart_snapshot""",
)
query(
    "e05_product_popularity",
    lambda w: eda.product_popularity(w.table("invoice_lines"), w.table("products")),
    """SELECT r.stock_code, p.primary_description, sum(r.quantity) FILTER (r.is_valid_sale)::BIGINT AS units_sold,
        sum(r.line_total) FILTER (r.is_valid_sale)::DOUBLE AS gross_sales
    FROM core_rows AS r JOIN core_products AS p USING (stock_code)
    GROUP BY r.stock_code, p.primary_description ORDER BY units_sold DESC NULLS LAST, stock_code LIMIT 100""",
)
query(
    "e06_country_distribution",
    lambda w: eda.country_distribution(w.table("mart_daily_sales")),
    "SELECT country, sum(net_sales)::DOUBLE AS net_sales FROM mart_daily GROUP BY country",
)
query(
    "e07_returns_and_cancellations",
    lambda w: eda.returns_and_cancellations(w.table("mart_daily_sales")),
    """SELECT sum(return_value)::DOUBLE AS return_value, sum(units_returned)::BIGINT AS units_returned,
        count_if(return_value < 0)::BIGINT AS groups_with_returns FROM mart_daily""",
)
query(
    "e08_missing_customer_id",
    lambda w: eda.missing_customer_id(w.table("invoice_lines")),
    """SELECT count(*) AS line_count, count(*) - count(customer_id) AS missing_customer_lines,
        sum(line_total) FILTER (customer_id IS NULL)::DOUBLE AS missing_customer_ledger FROM core_rows""",
)
query(
    "e09_temporal_transaction_patterns",
    lambda w: eda.temporal_transaction_patterns(w.table("mart_daily_sales")),
    f"""SELECT {day('calendar_day')}, sum(net_sales)::DOUBLE AS net_sales,
        sum(distinct_invoices)::BIGINT AS invoice_count FROM mart_daily GROUP BY mart_daily.calendar_day""",
)
_LONG_TAIL = """SELECT count(*) AS positive_customers, count_if(frequency = 0)::BIGINT AS zero_frequency_customers,
        max(monetary)::DOUBLE AS top_customer_monetary,
        (SELECT sum(monetary)::DOUBLE FROM (SELECT monetary FROM mart_snapshot WHERE monetary > 0
            ORDER BY monetary DESC LIMIT 100) AS leaders) / sum(monetary)::DOUBLE AS top_100_share
    FROM mart_snapshot WHERE monetary > 0"""
query(
    "e10_sparsity_and_long_tail",
    lambda w: eda.sparsity_and_long_tail(w.table("mart_customer_snapshot")),
    _LONG_TAIL,
)


def _eda_sizes(w):
    reports = eda.run_eda(
        w.table("mart_daily_sales"), w.table("mart_customer_snapshot"), w.table("invoice_lines"), w.table("products")
    )
    counted = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).withColumn("report", F.lit(name))
        for name, frame in reports.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)


query(
    "e11_run_eda",
    _eda_sizes,
    """SELECT 'sales_distribution' AS report, 1::BIGINT AS row_count
    UNION ALL SELECT 'customer_transaction_behavior', 1
    UNION ALL SELECT 'order_frequency', count(DISTINCT frequency) FROM mart_snapshot
    UNION ALL SELECT 'spending_distribution', 1
    UNION ALL SELECT 'product_popularity', least(100, count(*)) FROM core_products
    UNION ALL SELECT 'country_distribution', count(DISTINCT country) FROM mart_daily
    UNION ALL SELECT 'returns_and_cancellations', 1
    UNION ALL SELECT 'missing_customer_id', 1
    UNION ALL SELECT 'temporal_transaction_patterns', count(DISTINCT calendar_day) FROM mart_daily
    UNION ALL SELECT 'sparsity_and_long_tail', 1""",
)
