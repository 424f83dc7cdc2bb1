"""RFM scores, rule segments and the scaled feature space for clustering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import attach_row, count_if
from ..functions.ranks import column_ranks

RFM_COLUMNS = ["recency_days", "frequency", "monetary"]
SCORE_COLUMNS = {
    "recency_days": "recency_score",
    "frequency": "frequency_score",
    "monetary": "monetary_score",
}


def rfm_violations(frame: DataFrame) -> DataFrame:
    """Rows breaking each input rule of the scoring, as (rule, violations)."""
    missing = [c for c in ["customer_id", *RFM_COLUMNS] if c not in frame.columns]
    if missing:
        raise ValueError(f"RFM columns missing: {missing}")

    def number(name: str) -> Column:
        column = F.col(name)
        if not isinstance(frame.schema[name].dataType, T.NumericType):
            column = column.try_cast("double")
        return F.nanvl(column.cast("double"), F.lit(None).cast("double"))

    def infinite(name: str) -> Column:
        return F.abs(number(name)) == F.lit(float("inf"))

    rules = {
        "customer_id_null": count_if(F.col("customer_id").isNull()),
        "frequency_not_finite": count_if(number("frequency").isNull() | infinite("frequency")),
        "monetary_not_finite": count_if(number("monetary").isNull() | infinite("monetary")),
        "recency_not_finite": count_if(infinite("recency_days")),
        "active_without_recency": count_if(number("recency_days").isNull() & (number("frequency") > 0)),
    }
    by_rule = frame.agg(*[v.alias(k) for k, v in rules.items()]).unpivot([], list(rules), "rule", "violations")
    repeated = (
        frame.groupBy("customer_id")
        .agg((F.count(F.lit(1)) - 1).alias("extra"))
        .agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("violations"))
        .select(F.lit("customer_id_repeated").alias("rule"), "violations")
    )
    return by_rule.unionByName(repeated)


def require_rfm(frame: DataFrame) -> DataFrame:
    broken = [r["rule"] for r in rfm_violations(frame).where("violations > 0").collect()]
    if broken:
        raise ValueError(f"RFM input contract broken: {sorted(broken)}")
    return frame


def _rank_score(rank: Column, total: Column) -> Column:
    """Quintile of a 1-based rank: max(1, ceil(5 (rank - 1) / (total - 1))); 1 for one value."""
    steps = F.when(total > 1, total - 1).otherwise(F.lit(1))
    return F.greatest(F.lit(1), F.floor((5 * (rank - 1) + steps - 1) / steps).cast("bigint"))


def value_scores(active: DataFrame) -> DataFrame:
    """(metric, value, score) of every distinct value: the tie group's median quintile, halves to even.

    All three metrics go through one rank plan. Quintiles grow with the rank, so the median over ranks lo..hi is the mean of
    the scores of its one or two middle ranks. A low recency is good, so its ranks count from the top.
    """
    ranks = column_ranks(active, {metric: F.col(metric) for metric in SCORE_COLUMNS}).withColumnRenamed("column_name", "metric")
    total, turned = F.col("total"), F.col("metric") == "recency_days"
    low = F.when(turned, total - F.col("hi") + 1).otherwise(F.col("lo"))
    high = F.when(turned, total - F.col("lo") + 1).otherwise(F.col("hi"))
    lower_middle = F.floor((low + high) / 2).cast("bigint")
    upper_middle = F.ceil((low + high) / 2).cast("bigint")
    doubled = _rank_score(lower_middle, total) + _rank_score(upper_middle, total)
    return ranks.select("metric", "value", F.rint(doubled / 2.0).cast("int").alias("score"))


def rfm_scores(frame: DataFrame) -> DataFrame:
    """Add the three 1-5 scores and their concatenation; inactive customers score 1."""
    # A score is a step function of the value: at most five value ranges a metric, looked up without a join.
    steps = value_scores(frame.where(F.col("frequency") > 0)).groupBy("metric", "score").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    packed = steps.agg(F.collect_list(F.struct("metric", "score", "low", "high")).alias("_steps"))
    scored = attach_row(frame, packed)

    def score(metric: str) -> Column:
        value = F.col(metric).cast("double")
        held = F.filter("_steps", lambda step: (step["metric"] == metric) & (value >= step["low"]) & (value <= step["high"]))
        return F.when(F.col("frequency") > 0, F.coalesce(F.get(held, F.lit(0))["score"], F.lit(1))).otherwise(F.lit(1))

    scored = scored.withColumns({name: score(metric) for metric, name in SCORE_COLUMNS.items()})
    scores = list(SCORE_COLUMNS.values())
    return scored.select(
        *frame.columns, *scores, F.concat(*[F.col(s).cast("string") for s in scores]).alias("rfm_score")
    )


def segment_rule(recency: Column, frequency_score: Column, monetary: Column, frequency: Column) -> Column:
    """The first matching rule names the segment."""
    return (
        F.when((frequency == 0) & (frequency_score == 1), "Lost Customers")
        .when(F.least(recency, frequency_score, monetary) >= 4, "Champions")
        .when(F.least(recency, frequency_score, monetary) >= 3, "Loyal Customers")
        .when((recency >= 3) & (frequency_score <= 3) & (monetary >= 2), "Potential Loyalists")
        .when((recency <= 2) & (frequency_score >= 3), "At Risk")
        .when(recency <= 2, "Lost Customers")
        .otherwise("Other")
    )


def rfm_segments(scored: DataFrame) -> DataFrame:
    return scored.withColumn(
        "rfm_segment",
        segment_rule(F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score"), F.col("frequency")),
    )


def snapshot_segments(snapshot: DataFrame) -> DataFrame:
    """Scores and segments of a customer snapshot with the short score names added."""
    return rfm_segments(rfm_scores(snapshot)).withColumns(
        {
            "r_score": F.col("recency_score"),
            "f_score": F.col("frequency_score"),
            "m_score": F.col("monetary_score"),
        }
    )


def signed_log1p(value: Column) -> Column:
    """log(1 + |x|) with the sign of x."""
    number = value.cast("double")
    return F.signum(number) * F.log1p(F.abs(number))


def transformed_features(frame: DataFrame) -> DataFrame:
    """Raw R/F/M plus their compressed values, not yet standardised.

    A missing recency stays null in the raw column; only the model copy uses one day more than
    the longest active recency.
    """
    raw = frame.select("customer_id", *[F.col(c).cast("double").alias(c) for c in RFM_COLUMNS])
    longest = raw.where(F.col("frequency") > 0).agg(F.max("recency_days")).scalar()
    filled = F.coalesce(F.col("recency_days"), longest + 1, F.lit(1.0))
    return raw.withColumns(
        {
            "recency_scaled": signed_log1p(filled),
            "frequency_scaled": signed_log1p(F.col("frequency")),
            "monetary_scaled": signed_log1p(F.col("monetary")),
        }
    )


def scaled_features(frame: DataFrame) -> DataFrame:
    """Raw R/F/M plus their transformed z-scores (population deviation)."""
    transformed = transformed_features(frame)
    names = ["recency_scaled", "frequency_scaled", "monetary_scaled"]
    moments = transformed.agg(
        *[F.avg(n).alias(f"{n}_mean") for n in names], *[F.stddev_pop(n).alias(f"{n}_spread") for n in names]
    )

    def standard(name: str) -> Column:
        spread = F.when(F.col(f"{name}_spread") > 0, F.col(f"{name}_spread")).otherwise(F.lit(1.0))
        return ((F.col(name) - F.col(f"{name}_mean")) / spread).alias(name)

    return attach_row(transformed, moments).select("customer_id", *RFM_COLUMNS, *[standard(n) for n in names])
