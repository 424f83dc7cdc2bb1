"""Dashboard queries: filtered KPIs, trends, rankings, shares and distributions.

Filters are optional; ``None`` or ``"All"`` means no filter.  KPI functions return one row.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import month_start, spine, week_ending_monday
from ..functions.expressions import attach_row, count_if, percent, ratio, right_closed_label, round_half_even
from ..schema import (
    CRM_ACTIONS,
    CRM_DEFAULT,
    FREQUENCY_TIERS,
    MONETARY_BRACKETS,
)
from .eda import mean

TREND_MEASURES = [
    "gross_sales", "return_value", "net_sales", "invoice_segments", "units_sold", "units_returned",
]


def _between(df: DataFrame, start: date | None, end: date | None) -> DataFrame:
    if start is not None:
        df = df.where(F.col("calendar_day") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("calendar_day") <= F.lit(end))
    return df


def _in_country(df: DataFrame, country: str | None, column: str = "country") -> DataFrame:
    return df.where(F.col(column) == country) if country and country != "All" else df


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


# --- filter metadata -------------------------------------------------------------------------


def date_range(mart_daily_sales: DataFrame) -> DataFrame:
    return mart_daily_sales.agg(
        F.min("calendar_day").alias("min_date"), F.max("calendar_day").alias("max_date")
    )


def available_countries(mart_daily_sales: DataFrame) -> DataFrame:
    return mart_daily_sales.where("country <> ''").select("country").distinct().orderBy("country")


# --- sales -------------------------------------------------------------------------------------


def sales_kpis(mart_daily_sales, start=None, end=None, country=None) -> DataFrame:
    """Seven totals plus average order values and the return rate."""
    totals = _in_country(_between(mart_daily_sales, start, end), country).agg(
        _total("gross_sales").alias("gross_sales"),
        _total("valid_sales_revenue").alias("valid_sales"),
        _total("return_value").alias("return_value"),
        _total("net_sales").alias("net_sales"),
        _total("distinct_invoices").alias("invoice_segments"),
        _total("units_sold").alias("units_sold"),
        _total("units_returned").alias("units_returned"),
    )
    segments = F.col("invoice_segments")
    return totals.withColumns(
        {
            "net_aov": round_half_even(ratio(F.col("net_sales"), segments), 2),
            "gross_aov": round_half_even(ratio(F.col("gross_sales"), segments), 2),
            "return_rate_pct": percent(F.abs("return_value"), F.col("gross_sales")),
        }
    )


def _segment_sums():
    return [
        F.sum("gross_sales").alias("gross_sales"),
        F.sum("return_value").alias("return_value"),
        F.sum("net_sales").alias("net_sales"),
    ]


def daily_sales_trend(mart_daily_sales, start=None, end=None, country=None) -> DataFrame:
    return (
        _in_country(_between(mart_daily_sales, start, end), country)
        .groupBy("calendar_day")
        .agg(
            *_segment_sums(),
            F.sum("distinct_invoices").alias("invoice_segments"),
            F.sum("units_sold").alias("units_sold"),
            F.sum("units_returned").alias("units_returned"),
        )
        .orderBy("calendar_day")
    )


def sales_by_country(mart_daily_sales, start=None, end=None, country=None, limit: int = 10) -> DataFrame:
    return (
        _in_country(_between(mart_daily_sales, start, end), country)
        .groupBy("country")
        .agg(*_segment_sums(), F.sum("distinct_invoices").alias("invoice_segments"))
        .orderBy(F.desc("net_sales"), "country")
        .limit(limit)
    )


def merchandise_breakdown(mart_daily_sales, start=None, end=None, country=None) -> DataFrame:
    label = F.when(F.col("is_physical_merchandise"), "Physical Merchandise").otherwise("Special & Service")
    return (
        _in_country(_between(mart_daily_sales, start, end), country)
        .groupBy("is_physical_merchandise")
        .agg(*_segment_sums(), F.sum("units_sold").alias("units_sold"))
        .orderBy(F.desc("is_physical_merchandise"))
        .select(
            label.alias("product_classification"),
            "gross_sales", "return_value", "net_sales", "units_sold",
        )
    )


def resample_trend(trend: DataFrame, frequency: str = "Daily") -> DataFrame:
    """Daily trend summed to weeks ending Monday or calendar months, empty buckets as zero."""
    buckets = {
        "Weekly": (week_ending_monday, "7 days"),
        "Monthly": (month_start, "1 month"),
    }
    if frequency not in buckets:
        return trend
    bucket, step = buckets[frequency]
    summed = (
        trend.withColumn("calendar_day", bucket(F.col("calendar_day")))
        .groupBy("calendar_day")
        .agg(*[F.sum(m).alias(m) for m in TREND_MEASURES])
    )
    return (
        spine(summed, "calendar_day", step)
        .join(summed, "calendar_day", "left")
        .select("calendar_day", *[F.coalesce(m, F.lit(0)).alias(m) for m in TREND_MEASURES])
        .orderBy("calendar_day")
    )


def country_shares(countries: DataFrame, total_net_sales=None) -> DataFrame:
    """Market share against an explicit total (number or scalar column), else the frame's own."""
    if total_net_sales is None:
        total_net_sales = countries.agg(_total("net_sales")).scalar()
    elif not isinstance(total_net_sales, Column):
        total_net_sales = F.lit(total_net_sales)
    return countries.withColumn("market_share_pct", percent(F.col("net_sales"), total_net_sales))


def cumulative_net_sales(trend: DataFrame) -> DataFrame:
    """Running net sales over a trend; the frame holds at most one row per calendar bucket."""
    order = Window.orderBy("calendar_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return trend.withColumn("cumulative_net_sales", F.sum("net_sales").over(order)).select(
        "calendar_day", "net_sales", "cumulative_net_sales"
    )


def sales_ratios(kpis: DataFrame) -> DataFrame:
    """Net realization percent and items per invoice segment of a KPI row."""
    return kpis.select(
        (ratio(F.col("net_sales"), F.col("gross_sales")) * 100.0).alias("net_realization_pct"),
        ratio(F.col("units_sold"), F.col("invoice_segments")).alias("items_per_segment"),
    )


def average_lifetime_value(customer_kpi_row: DataFrame) -> DataFrame:
    return customer_kpi_row.select(
        ratio(F.col("total_customer_spend"), F.col("total_customers")).alias("average_ltv")
    )


# --- customers -----------------------------------------------------------------------------------


def customer_kpis(snapshot: DataFrame, country: str | None = None) -> DataFrame:
    """Population, repeat and one-time buyers, spend and averages (rate over all customers)."""
    frequency = F.col("frequency")

    def average(name):
        return F.coalesce(mean(name), F.lit(0.0)).alias(f"avg_{name}")

    totals = _in_country(snapshot, country, "primary_country").agg(
        F.count(F.lit(1)).alias("total_customers"),
        count_if(frequency >= 2).alias("repeat_customers"),
        count_if(frequency == 1).alias("one_time_buyers"),
        _total("monetary").alias("total_customer_spend"),
        average("frequency"),
        F.coalesce(mean("average_order_value"), F.lit(0.0)).alias("avg_aov"),
        average("recency_days"),
        average("tenure_days"),
    )
    return totals.withColumn("repeat_rate_pct", percent(F.col("repeat_customers"), F.col("total_customers")))


def customer_daily_trend(mart_customer_daily, start=None, end=None) -> DataFrame:
    """Active customers and spend per day; the mart holds one row per customer and day."""
    return (
        _between(mart_customer_daily, start, end)
        .groupBy("calendar_day")
        .agg(
            F.count("customer_id").alias("active_customers"),
            F.sum("gross_spend").alias("daily_gross_spend"),
            F.sum("net_spend").alias("daily_net_spend"),
            F.sum("order_frequency").alias("daily_orders"),
        )
        .orderBy("calendar_day")
    )


def top_customers(snapshot: DataFrame, country: str | None = None, limit: int = 15) -> DataFrame:
    return (
        _in_country(snapshot, country, "primary_country")
        .select(
            "customer_id", "primary_country", "monetary", "frequency", "average_order_value",
            "recency_days", "tenure_days", "first_purchase_date", "last_purchase_date",
        )
        .orderBy(F.desc("monetary"), "customer_id")
        .limit(limit)
    )


def rfm_snapshot(snapshot: DataFrame, country: str | None = None) -> DataFrame:
    return _in_country(snapshot, country, "primary_country").select(
        "customer_id", "primary_country", "recency_days", "frequency", "monetary",
        "average_order_value", "tenure_days",
    )


def _binned(df: DataFrame, value: str, bins, label_column: str) -> DataFrame:
    label = right_closed_label(F.coalesce(value, F.lit(0)), bins)
    counted = df.groupBy(label.alias(label_column)).agg(F.count(F.lit(1)).alias("n"))
    names = df.sparkSession.createDataFrame(
        [(i, name) for i, (_, name) in enumerate(bins)], f"position int, {label_column} string"
    )
    total = df.agg(F.count(F.lit(1))).scalar()
    count = F.coalesce("n", F.lit(0))
    return (
        names.join(counted, label_column, "left")
        .withColumn("_total", total)
        .where("_total > 0")
        .select(
            "position", label_column, count.alias("customer_count"),
            percent(count, F.col("_total")).alias("percentage"),
        )
        .orderBy("position")
    )


def frequency_tiers(snapshot: DataFrame) -> DataFrame:
    return _binned(snapshot, "frequency", FREQUENCY_TIERS, "tier")


def monetary_brackets(snapshot: DataFrame) -> DataFrame:
    return _binned(snapshot, "monetary", MONETARY_BRACKETS, "bracket")


# --- segments ----------------------------------------------------------------------------------------


def segment_summary(segmented: DataFrame) -> DataFrame:
    """Count, revenue, shares and averages per segment, largest revenue first."""
    population = segmented.agg(
        F.count(F.lit(1)).alias("customers"), _total("monetary").alias("revenue")
    )
    per_segment = (
        segmented.groupBy(F.col("rfm_segment").alias("segment"))
        .agg(
            F.count("customer_id").alias("customer_count"),
            F.sum("monetary").alias("total_revenue"),
            round_half_even(mean("monetary"), 2).alias("avg_spend"),
            round_half_even(mean("recency_days"), 1).alias("avg_recency_days"),
            round_half_even(mean("frequency"), 1).alias("avg_frequency"),
        )
    )
    return (
        attach_row(per_segment, population)
        .withColumn("customer_share_pct", percent(F.col("customer_count"), F.col("customers")))
        .withColumn("revenue_share_pct", percent(F.col("total_revenue"), F.col("revenue")))
        .select(
            "segment", "customer_count", "customer_share_pct", "total_revenue", "revenue_share_pct",
            "avg_spend", "avg_recency_days", "avg_frequency",
        )
        .orderBy(F.desc("total_revenue"), "segment")
    )


def score_histograms(segmented: DataFrame) -> DataFrame:
    """Customers per score for the three scores, in long form."""
    scores = segmented.select(
        F.col("recency_score").alias("R"), F.col("frequency_score").alias("F"), F.col("monetary_score").alias("M")
    )
    return (
        scores.unpivot([], ["R", "F", "M"], "metric", "score")
        .groupBy("metric", "score")
        .agg(F.count(F.lit(1)).alias("customer_count"))
        .orderBy("metric", "score")
    )


def segment_drilldown(segmented: DataFrame, segment: str) -> DataFrame:
    return (
        segmented.where(F.col("rfm_segment") == segment)
        .select(
            "customer_id", "primary_country", "recency_days", "frequency", "monetary",
            "average_order_value", "rfm_score",
        )
        .orderBy(F.desc("monetary"), "customer_id")
    )


def crm_action(segment: Column) -> Column:
    """Recommended action text of a segment, with a default for the unlisted."""
    pairs = [F.lit(text) for pair in CRM_ACTIONS.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), segment), F.lit(CRM_DEFAULT))


def segment_actions(summary: DataFrame) -> DataFrame:
    return summary.select("segment", crm_action(F.col("segment")).alias("action"))


SPOTLIGHT = {
    "Champions": "revenue_share_pct",
    "Loyal Customers": "revenue_share_pct",
    "At Risk": "revenue_share_pct",
    "Lost Customers": "customer_share_pct",
}


def segment_spotlight(summary: DataFrame) -> DataFrame:
    """Count and headline share of four segments, zero for the absent ones."""
    names = summary.sparkSession.createDataFrame([(s, m) for s, m in SPOTLIGHT.items()], "segment string, metric string")
    share = F.when(F.col("metric") == "customer_share_pct", F.col("customer_share_pct")).otherwise(
        F.col("revenue_share_pct")
    )
    return names.join(summary, "segment", "left").select(
        "segment",
        F.coalesce("customer_count", F.lit(0)).alias("customer_count"),
        "metric",
        F.coalesce(share, F.lit(0.0)).alias("share_pct"),
    )
