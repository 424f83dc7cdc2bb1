"""As-of customer features and their contract."""

from __future__ import annotations

import warnings
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import any_of, count_if
from ..schema import DEFAULT_SOURCE_SYSTEM, FEATURE_COLUMNS
from .marts import customer_lifetime, describe_customers, namespace

_MEASURES = ["recency_days", "frequency", "monetary", "average_order_value", "tenure_days"]


def customer_features(
    mart_customer_daily: DataFrame,
    customers: DataFrame,
    as_of: date,
    *,
    source_system: str = DEFAULT_SOURCE_SYSTEM,
    checked: bool = True,
) -> DataFrame:
    """One row per customer from activity up to and including ``as_of``.

    ``checked`` warns if later activity exists and raises if the result breaks the feature contract.
    """
    if checked:
        warn_on_leakage(mart_customer_daily, as_of)
    bounded = mart_customer_daily.where(F.col("calendar_day") <= F.lit(as_of))
    described = describe_customers(
        namespace(customers, source_system), customer_lifetime(bounded), as_of
    )
    features = described.withColumn("reference_date", F.lit(as_of)).select(*FEATURE_COLUMNS)
    return validate_features(features) if checked else features


def feature_violations(features: DataFrame) -> DataFrame:
    """Rows breaking each rule of the feature contract, as (rule, violations)."""
    missing = [c for c in FEATURE_COLUMNS if c not in features.columns]
    if missing:
        raise ValueError(f"feature columns missing: {missing}")

    def number(name):
        column = F.col(name)
        if not isinstance(features.schema[name].dataType, T.NumericType):
            column = column.try_cast("double")
        return column.cast("double")

    def absent(name):
        return number(name).isNull() | F.isnan(number(name))

    infinite = [F.abs(number(c)) == F.lit(float("inf")) for c in _MEASURES]
    text = [F.col(c).isNotNull() & number(c).isNull() for c in _MEASURES]
    rows = F.count(F.lit(1))

    def all_absent(name):
        return F.when((rows > 0) & (count_if(absent(name)) == rows), rows).otherwise(F.lit(0))

    rules = {
        "customer_id_null": count_if(F.col("customer_id").isNull()),
        "frequency_all_null": all_absent("frequency"),
        "monetary_all_null": all_absent("monetary"),
        "non_numeric": count_if(any_of(text)),
        "non_finite": count_if(any_of(infinite)),
        "frequency_negative": count_if(number("frequency") < 0),
        "recency_negative": count_if(number("recency_days") < 0),
        "tenure_negative": count_if(number("tenure_days") < 0),
        "active_without_recency": count_if((number("frequency") > 0) & absent("recency_days")),
        "inactive_with_recency": count_if((number("frequency") == 0) & ~absent("recency_days")),
    }
    counted = features.agg(*[value.alias(rule) for rule, value in rules.items()])
    by_rule = counted.unpivot([], list(rules), "rule", "violations")
    repeated = (
        features.groupBy("customer_id")
        .agg((F.count(F.lit(1)) - 1).alias("extra"))
        .agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("violations"))
        .select(F.lit("customer_id_repeated").alias("rule"), "violations")
    )
    return by_rule.unionByName(repeated)


def validate_features(features: DataFrame) -> DataFrame:
    """Return the features unchanged, or raise with the names of the broken rules."""
    broken = [r["rule"] for r in feature_violations(features).where("violations > 0").collect()]
    if broken:
        raise ValueError(f"customer feature contract broken: {sorted(broken)}")
    return features


def dimension_leakage(mart_customer_daily: DataFrame, as_of: date) -> DataFrame:
    """Whether activity after ``as_of`` exists, so lifetime attributes know the future."""
    return mart_customer_daily.agg(F.max("calendar_day").alias("data_end")).select(
        F.lit(as_of).alias("as_of"),
        "data_end",
        F.coalesce(F.col("data_end") > F.lit(as_of), F.lit(False)).alias("leaks_future"),
    )


def warn_on_leakage(mart_customer_daily: DataFrame, as_of: date) -> None:
    if dimension_leakage(mart_customer_daily, as_of).first()["leaks_future"]:
        warnings.warn(
            "customer attributes such as primary_country are lifetime values, not values "
            f"known at {as_of}",
            UserWarning,
            stacklevel=2,
        )


def write_features(features: DataFrame, path: str) -> DataFrame:
    """Validate, then persist the feature table; returns what a reader gets back."""
    validate_features(features).write.mode("overwrite").parquet(path)
    return features.sparkSession.read.parquet(path)
