"""D operators: the dashboard query layer over the three marts."""

from __future__ import annotations

from datetime import date

from ...operators import dashboard as d
from ...operators.rfm import snapshot_segments
from ...schema import CRM_ACTIONS, CRM_DEFAULT, FREQUENCY_TIERS, MONETARY_BRACKETS
from ..registry import STATEMENTS, day, query, real, whole

START, END, COUNTRY = date(1996, 1, 1), date(2000, 12, 31), "NATION_3"
_SPAN = "calendar_day BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"
_HERE = f"{_SPAN} AND country = 'NATION_3'"


def _sales(w):
    return w.table("mart_daily_sales")


def _buyers(w):
    return w.table("mart_customer_daily")


def _snapshot(w):
    return w.table("mart_customer_snapshot")


query(
    "d01_date_range",
    lambda w: d.date_range(_sales(w)),
    """SELECT strftime(min(calendar_day), '%Y-%m-%d') AS min_date,
        strftime(max(calendar_day), '%Y-%m-%d') AS max_date FROM mart_daily""",
)
query(
    "d02_available_countries",
    lambda w: d.available_countries(_sales(w)),
    "SELECT DISTINCT country FROM mart_daily WHERE country <> ''",
)

_KPI_SUMS = """coalesce(sum(gross_sales), 0) AS gross_sales, coalesce(sum(return_value), 0) AS return_value,
    coalesce(sum(net_sales), 0) AS net_sales, coalesce(sum(distinct_invoices), 0)::BIGINT AS invoice_segments,
    coalesce(sum(units_sold), 0)::BIGINT AS units_sold, coalesce(sum(units_returned), 0)::BIGINT AS units_returned"""


def _kpi_sql(where):
    return f"""SELECT {real('gross_sales')}, gross_sales::DOUBLE AS valid_sales, {real('return_value', 'net_sales')},
        invoice_segments, units_sold, units_returned,
        CASE WHEN invoice_segments > 0 THEN round_even(net_sales::DOUBLE / invoice_segments * 100, 0) / 100 ELSE 0 END AS net_aov,
        CASE WHEN invoice_segments > 0 THEN round_even(gross_sales::DOUBLE / invoice_segments * 100, 0) / 100 ELSE 0 END AS gross_aov,
        CASE WHEN gross_sales > 0 THEN round_even(abs(return_value)::DOUBLE / gross_sales::DOUBLE * 100 * 100, 0) / 100 ELSE 0 END
            AS return_rate_pct
    FROM (SELECT {_KPI_SUMS} FROM mart_daily WHERE {where}) AS sums"""


query("d03_sales_kpis", lambda w: d.sales_kpis(_sales(w)), _kpi_sql("TRUE"))
query("d03_sales_kpis_filtered", lambda w: d.sales_kpis(_sales(w), START, END, COUNTRY), _kpi_sql(_HERE))

_TREND = f"""SELECT calendar_day, sum(gross_sales) AS gross_sales, sum(return_value) AS return_value,
    sum(net_sales) AS net_sales, sum(distinct_invoices)::BIGINT AS invoice_segments,
    sum(units_sold)::BIGINT AS units_sold, sum(units_returned)::BIGINT AS units_returned
    FROM mart_daily WHERE {_HERE} GROUP BY calendar_day"""
_TREND_BLOCK = {"led_trend": _TREND}
_TREND_COLUMNS = "invoice_segments, units_sold, units_returned"


def _trend(w):
    return d.daily_sales_trend(_sales(w), START, END, COUNTRY)


query(
    "d04_daily_sales_trend",
    _trend,
    f"SELECT {day('calendar_day')}, {real('gross_sales', 'return_value', 'net_sales')}, {_TREND_COLUMNS} FROM led_trend",
    _TREND_BLOCK,
)
query(
    "d05_sales_by_country",
    lambda w: d.sales_by_country(_sales(w), START, END),
    f"""SELECT country, sum(gross_sales)::DOUBLE AS gross_sales, sum(return_value)::DOUBLE AS return_value,
        sum(net_sales)::DOUBLE AS net_sales, sum(distinct_invoices)::BIGINT AS invoice_segments
    FROM mart_daily WHERE {_SPAN} GROUP BY country ORDER BY sum(mart_daily.net_sales) DESC, country LIMIT 10""",
)
query(
    "d06_merchandise_breakdown",
    lambda w: d.merchandise_breakdown(_sales(w), START, END),
    f"""SELECT CASE WHEN is_physical_merchandise THEN 'Physical Merchandise' ELSE 'Special & Service' END
            AS product_classification,
        sum(gross_sales)::DOUBLE AS gross_sales, sum(return_value)::DOUBLE AS return_value,
        sum(net_sales)::DOUBLE AS net_sales, sum(units_sold)::BIGINT AS units_sold
    FROM mart_daily WHERE {_SPAN} GROUP BY is_physical_merchandise""",
)


def _customer_kpi_sql(where):
    def average(column, alias):
        return f"coalesce(sum({column})::DOUBLE / nullif(count({column}), 0), 0) AS {alias}"

    return f"""SELECT count(*) AS total_customers, count_if(frequency >= 2)::BIGINT AS repeat_customers,
        count_if(frequency = 1)::BIGINT AS one_time_buyers, coalesce(sum(monetary), 0)::DOUBLE AS total_customer_spend,
        {average('frequency', 'avg_frequency')},
        coalesce((sum((average_order_value * 100)::BIGINT) / 100)::DOUBLE / nullif(count(average_order_value), 0), 0) AS avg_aov,
        {average('recency_days', 'avg_recency_days')}, {average('tenure_days', 'avg_tenure_days')},
        CASE WHEN count(*) > 0 THEN round_even(count_if(frequency >= 2)::DOUBLE / count(*) * 100 * 100, 0) / 100 ELSE 0 END
            AS repeat_rate_pct
    FROM mart_snapshot WHERE {where}"""


query("d07_customer_kpis", lambda w: d.customer_kpis(_snapshot(w)), _customer_kpi_sql("TRUE"))
query(
    "d07_customer_kpis_filtered",
    lambda w: d.customer_kpis(_snapshot(w), COUNTRY),
    _customer_kpi_sql("primary_country = 'NATION_3'"),
)
query(
    "d08_customer_daily_trend",
    lambda w: d.customer_daily_trend(_buyers(w), START, END),
    f"""SELECT {day('calendar_day')}, count(DISTINCT customer_id) AS active_customers,
        sum(gross_spend)::DOUBLE AS daily_gross_spend, sum(net_spend)::DOUBLE AS daily_net_spend,
        sum(order_frequency)::BIGINT AS daily_orders
    FROM mart_buyer_day WHERE {_SPAN} GROUP BY mart_buyer_day.calendar_day""",
)
query(
    "d09_top_customers",
    lambda w: d.top_customers(_snapshot(w)),
    f"""SELECT customer_id, primary_country, {real('monetary')}, frequency, average_order_value,
        {whole('recency_days', 'tenure_days')}, {day('first_purchase_date', 'last_purchase_date')}
    FROM mart_snapshot ORDER BY mart_snapshot.monetary DESC, customer_id LIMIT 15""",
)
query(
    "d10_rfm_snapshot",
    lambda w: d.rfm_snapshot(_snapshot(w), COUNTRY),
    f"""SELECT customer_id, primary_country, {whole('recency_days')}, frequency, {real('monetary')},
        average_order_value, {whole('tenure_days')} FROM mart_snapshot WHERE primary_country = 'NATION_3'""",
)

# --- segments: rank every active customer, cut into quintiles, take the tie group's median ----


def _score(metric, order):
    return f"""SELECT customer_id, round_even(median(quintile) OVER (PARTITION BY {metric}), 0)::BIGINT AS score
        FROM (
            SELECT customer_id, {metric}, greatest(1, ceil(5.0::DOUBLE
                * (row_number() OVER (ORDER BY {metric} {order}, customer_id) - 1)
                / greatest(count(*) OVER () - 1, 1))) AS quintile
            FROM mart_snapshot WHERE frequency > 0
        ) AS ranked"""


RFM_BLOCKS = {
    "rfm_recency": _score("recency_days", "DESC"),
    "rfm_frequency": _score("frequency", "ASC"),
    "rfm_monetary": _score("monetary", "ASC"),
    "rfm_scored": """
        SELECT s.*, coalesce(r.score, 1) AS recency_score, coalesce(f.score, 1) AS frequency_score,
            coalesce(m.score, 1) AS monetary_score,
            concat(coalesce(r.score, 1), coalesce(f.score, 1), coalesce(m.score, 1)) AS rfm_score
        FROM mart_snapshot AS s
        LEFT JOIN rfm_recency AS r USING (customer_id)
        LEFT JOIN rfm_frequency AS f USING (customer_id)
        LEFT JOIN rfm_monetary AS m USING (customer_id)
    """,
    "rfm_labelled": """
        SELECT *, CASE
            WHEN frequency = 0 THEN 'Lost Customers'
            WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
            WHEN recency_score >= 3 AND frequency_score >= 3 AND monetary_score >= 3 THEN 'Loyal Customers'
            WHEN recency_score >= 3 AND frequency_score <= 3 AND monetary_score >= 2 THEN 'Potential Loyalists'
            WHEN recency_score < 3 AND frequency_score >= 3 THEN 'At Risk'
            WHEN recency_score < 3 THEN 'Lost Customers'
            ELSE 'Other' END AS rfm_segment
        FROM rfm_scored
    """,
    "rfm_summary": """
        SELECT rfm_segment AS segment, count(*) AS customer_count,
            round_even(count(*)::DOUBLE / sum(count(*)) OVER () * 100 * 100, 0) / 100 AS customer_share_pct,
            sum(monetary)::DOUBLE AS total_revenue,
            CASE WHEN sum(sum(monetary)) OVER () > 0 THEN
                round_even(sum(monetary)::DOUBLE / (sum(sum(monetary)) OVER ())::DOUBLE * 100 * 100, 0) / 100 ELSE 0 END
                AS revenue_share_pct,
            round_even(sum(monetary)::DOUBLE / count(*) * 100, 0) / 100 AS avg_spend,
            round_even(sum(recency_days)::DOUBLE / nullif(count(recency_days), 0) * 10, 0) / 10 AS avg_recency_days,
            round_even(sum(frequency)::DOUBLE / count(*) * 10, 0) / 10 AS avg_frequency
        FROM rfm_labelled GROUP BY rfm_segment
    """,
}
RFM_SELECT = f"""customer_id, primary_country, {whole('recency_days')}, frequency, {real('monetary')}, average_order_value,
    {whole('tenure_days')}"""
_SCORES = "recency_score, frequency_score, monetary_score, rfm_score"


def segmented(w):
    """Segments of the whole snapshot, staged once for the reports below."""
    return w.stage("rfm_segments", lambda: snapshot_segments(d.rfm_snapshot(_snapshot(w))))


def _segments(w):
    return snapshot_segments(d.rfm_snapshot(_snapshot(w)))


query(
    "d11_rfm_segments",
    _segments,
    f"""SELECT {RFM_SELECT}, {_SCORES}, rfm_segment, recency_score AS r_score, frequency_score AS f_score,
        monetary_score AS m_score FROM rfm_labelled""",
    RFM_BLOCKS,
)

_RESAMPLED = {
    "led_bucketed": _TREND_BLOCK["led_trend"].replace(
        "SELECT calendar_day,",
        "SELECT {bucket} AS bucket,",
    ).replace("GROUP BY calendar_day", "GROUP BY bucket"),
}


def _resample_sql(bucket, step):
    return (
        f"""SELECT strftime(s.bucket, '%Y-%m-%d') AS calendar_day,
            {', '.join(f'coalesce(b.{m}, 0)::DOUBLE AS {m}' for m in ('gross_sales', 'return_value', 'net_sales'))},
            {', '.join(f'coalesce(b.{m}, 0)::BIGINT AS {m}' for m in ('invoice_segments', 'units_sold', 'units_returned'))}
        FROM (SELECT unnest(generate_series(min(bucket)::TIMESTAMP, max(bucket)::TIMESTAMP, INTERVAL '{step}')) AS bucket
            FROM led_bucketed) AS s
        LEFT JOIN led_bucketed AS b ON b.bucket::TIMESTAMP = s.bucket""",
        {"led_bucketed": _RESAMPLED["led_bucketed"].format(bucket=bucket)},
    )


query(
    "d12_resample_weekly",
    lambda w: d.resample_trend(_trend(w), "Weekly"),
    *_resample_sql("(date_trunc('week', calendar_day - 1) + INTERVAL 7 DAY)::DATE", "7 days"),
)
query(
    "d12_resample_monthly",
    lambda w: d.resample_trend(_trend(w), "Monthly"),
    *_resample_sql("date_trunc('month', calendar_day)::DATE", "1 month"),
)


def _shares(w):
    countries = d.sales_by_country(_sales(w), START, END)
    total = d.sales_kpis(_sales(w), START, END).select("net_sales").scalar()
    return d.country_shares(countries, total)


query(
    "d13_country_shares",
    _shares,
    f"""SELECT country, {real('gross_sales', 'return_value', 'net_sales')}, invoice_segments,
        CASE WHEN total > 0 THEN round_even(net_sales::DOUBLE / total::DOUBLE * 100 * 100, 0) / 100 ELSE 0 END AS market_share_pct
    FROM (
        SELECT country, sum(gross_sales) AS gross_sales, sum(return_value) AS return_value, sum(net_sales) AS net_sales,
            sum(distinct_invoices)::BIGINT AS invoice_segments, sum(sum(net_sales)) OVER () AS total
        FROM mart_daily WHERE {_SPAN} GROUP BY country
    ) AS c ORDER BY c.net_sales DESC, country LIMIT 10""",
)


def _bins_sql(column, bins, label):
    rows, low = [], "-'infinity'::DOUBLE"
    for i, (high, name) in enumerate(bins):
        high = "'infinity'::DOUBLE" if high is None else high
        rows.append(f"({i}, '{name}', {low}, {high})")
        low = high
    return f"""SELECT b.position::BIGINT AS position, b.{label}, count(s.customer_id) AS customer_count,
        round_even(count(s.customer_id)::DOUBLE / (SELECT count(*) FROM mart_snapshot) * 100 * 100, 0) / 100 AS percentage
    FROM (VALUES {', '.join(rows)}) AS b(position, {label}, low, high)
    LEFT JOIN mart_snapshot AS s ON coalesce(s.{column}, 0) > b.low AND coalesce(s.{column}, 0) <= b.high
    GROUP BY b.position, b.{label}"""


query(
    "d14_frequency_tiers",
    lambda w: d.frequency_tiers(_snapshot(w)),
    _bins_sql("frequency", FREQUENCY_TIERS, "tier"),
)
query(
    "d15_monetary_brackets",
    lambda w: d.monetary_brackets(_snapshot(w)),
    _bins_sql("monetary", MONETARY_BRACKETS, "bracket"),
)
query(
    "d16_segment_summary",
    lambda w: d.segment_summary(segmented(w)),
    "SELECT * FROM rfm_summary",
    RFM_BLOCKS,
)
query(
    "d17_cumulative_net_sales",
    lambda w: d.cumulative_net_sales(_trend(w)),
    f"""SELECT {day('calendar_day')}, {real('net_sales')},
        (sum(led_trend.net_sales) OVER (ORDER BY led_trend.calendar_day))::DOUBLE AS cumulative_net_sales FROM led_trend""",
    _TREND_BLOCK,
)


def _ratios(w):
    ltv = d.average_lifetime_value(d.customer_kpis(_snapshot(w))).scalar()
    return d.sales_ratios(d.sales_kpis(_sales(w))).withColumn("average_ltv", ltv)


query(
    "d18_derived_ratios",
    _ratios,
    """SELECT sum(net_sales)::DOUBLE / sum(gross_sales)::DOUBLE * 100 AS net_realization_pct,
        sum(units_sold)::DOUBLE / sum(distinct_invoices)::DOUBLE AS items_per_segment,
        (SELECT sum(monetary)::DOUBLE / count(*) FROM mart_snapshot) AS average_ltv FROM mart_daily""",
)
query(
    "d19_score_histograms",
    lambda w: d.score_histograms(segmented(w)),
    """SELECT metric, score, count(*) AS customer_count FROM (
        SELECT 'R' AS metric, recency_score AS score FROM rfm_scored
        UNION ALL SELECT 'F', frequency_score FROM rfm_scored
        UNION ALL SELECT 'M', monetary_score FROM rfm_scored) AS scores GROUP BY metric, score""",
    RFM_BLOCKS,
)
query(
    "d20_segment_drilldown",
    lambda w: d.segment_drilldown(segmented(w), "Champions"),
    f"""SELECT customer_id, primary_country, {whole('recency_days')}, frequency, {real('monetary')}, average_order_value,
        rfm_score FROM rfm_labelled WHERE rfm_segment = 'Champions'""",
    RFM_BLOCKS,
)
_ACTIONS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CRM_ACTIONS.items())
query(
    "d21_segment_actions",
    lambda w: d.segment_actions(d.segment_summary(segmented(w))),
    f"SELECT DISTINCT rfm_segment AS segment, CASE rfm_segment {_ACTIONS} ELSE '{CRM_DEFAULT}' END AS action FROM rfm_labelled",
    RFM_BLOCKS,
)
query(
    "d22_segment_spotlight",
    lambda w: d.segment_spotlight(d.segment_summary(segmented(w))),
    """SELECT n.segment, coalesce(s.customer_count, 0) AS customer_count, n.metric,
        coalesce(CASE n.metric WHEN 'customer_share_pct' THEN s.customer_share_pct ELSE s.revenue_share_pct END, 0) AS share_pct
    FROM (VALUES ('Champions', 'revenue_share_pct'), ('Loyal Customers', 'revenue_share_pct'),
        ('At Risk', 'revenue_share_pct'), ('Lost Customers', 'customer_share_pct')) AS n(segment, metric)
    LEFT JOIN rfm_summary AS s ON s.segment = n.segment""",
    RFM_BLOCKS,
)

# --- the windowed queries once more over the whole marts ---------------------------------------------


def _over_everything(sql, extra=None):
    """The same statement without its date and country window."""

    def opened(text):
        return text.replace(_HERE, "TRUE").replace(_SPAN, "TRUE").replace(" WHERE primary_country = 'NATION_3'", "")

    return opened(sql), {name: opened(block) for name, block in (extra or {}).items()} or None


def _whole_trend(w):
    return d.daily_sales_trend(_sales(w))


def _whole_shares(w):
    return d.country_shares(d.sales_by_country(_sales(w)), d.sales_kpis(_sales(w)).select("net_sales").scalar())


_WHOLE = {
    "d04_daily_sales_trend": _whole_trend,
    "d05_sales_by_country": lambda w: d.sales_by_country(_sales(w)),
    "d06_merchandise_breakdown": lambda w: d.merchandise_breakdown(_sales(w)),
    "d08_customer_daily_trend": lambda w: d.customer_daily_trend(_buyers(w)),
    "d10_rfm_snapshot": lambda w: d.rfm_snapshot(_snapshot(w)),
    "d12_resample_weekly": lambda w: d.resample_trend(_whole_trend(w), "Weekly"),
    "d12_resample_monthly": lambda w: d.resample_trend(_whole_trend(w), "Monthly"),
    "d13_country_shares": _whole_shares,
    "d17_cumulative_net_sales": lambda w: d.cumulative_net_sales(_whole_trend(w)),
}
for _name, _run in _WHOLE.items():
    query(f"{_name}_whole", _run, *_over_everything(*STATEMENTS[_name]))
