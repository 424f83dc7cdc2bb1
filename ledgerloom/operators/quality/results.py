"""Result rows, comparison and report roll-ups."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER = T.DecimalType(38, 2)
RESULT_SCHEMA = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("expected", NUMBER),
        T.StructField("actual", NUMBER),
        T.StructField("status", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)
MISMATCH = "Aggregate does not match the contract."


def compared(name: Column, item: Column, expected: Column, actual: Column, tolerance=None) -> list[Column]:
    """The six result columns; null-safe equality unless a tolerance is given."""
    expected, actual = expected.cast(NUMBER), actual.cast(NUMBER)
    if tolerance is None:
        passed = expected.eqNullSafe(actual)
    else:
        if Decimal(str(tolerance)) < 0:
            raise ValueError("tolerance must not be negative")
        passed = F.coalesce(F.abs(actual - expected) <= F.lit(Decimal(str(tolerance))), F.lit(False))
    return [
        name.alias("check_name"),
        item.alias("item"),
        expected.alias("expected"),
        actual.alias("actual"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        F.when(~passed, MISMATCH).alias("reason"),
    ]


def compare(row: DataFrame, name: str, expected: Column, actual: Column, *, item: str = "value", tolerance=None) -> DataFrame:
    """Result of comparing two expressions over a one-row frame."""
    return row.select(*compared(F.lit(name), F.lit(item), expected, actual, tolerance))


def violations(counted: DataFrame, names: dict[str, str]) -> DataFrame:
    """Results from a one-row frame of violation counts; ``names`` maps column to check name."""
    columns = list(names)
    label = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    long = counted.select(*[F.col(c).cast(NUMBER).alias(c) for c in columns]).unpivot([], columns, "_key", "_count")
    return long.select(*compared(label[F.col("_key")], F.lit("violations"), F.lit(0), F.col("_count")))


def item_violations(counted: DataFrame, name: str) -> DataFrame:
    """Results of one check with several counted items, all expected to be zero."""
    columns = counted.columns
    long = counted.select(*[F.col(c).cast(NUMBER).alias(c) for c in columns]).unpivot([], columns, "_item", "_count")
    return long.select(*compared(F.lit(name), F.col("_item"), F.lit(0), F.col("_count")))


def side_by_side(expected: DataFrame, actual: DataFrame, name: str) -> DataFrame:
    """Compare two one-row frames column by column."""
    columns = expected.columns

    def long(frame, value):
        typed = frame.select(*[F.col(c).cast(NUMBER).alias(c) for c in columns])
        return typed.unpivot([], columns, "_item", value)

    return (
        long(expected, "_expected")
        .join(long(actual, "_actual"), "_item", "full_outer")
        .select(*compared(F.lit(name), F.col("_item"), F.col("_expected"), F.col("_actual")))
    )


def fixed(spark: SparkSession, name: str, item: str, status: str, reason: str | None = None) -> DataFrame:
    return spark.createDataFrame([(name, item, None, None, status, reason)], RESULT_SCHEMA)


def union_results(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), list(frames))


def status_of(failed: Column, skipped: Column, total: Column) -> Column:
    """Any FAIL fails; else any SKIP, or no check at all, is incomplete; else PASS."""
    return F.when(failed > 0, "FAIL").when((skipped > 0) | (total == 0), "SKIP").otherwise("PASS")


def summarize(results: DataFrame) -> DataFrame:
    def having(status):
        return F.count(F.when(F.col("status") == status, F.lit(1)))

    return results.agg(
        F.count(F.lit(1)).alias("total"),
        having("PASS").alias("passed"),
        having("FAIL").alias("failed"),
        having("SKIP").alias("skipped"),
    ).withColumn("status", status_of(F.col("failed"), F.col("skipped"), F.col("total")))


def gate_summary(results: DataFrame) -> DataFrame:
    """The roll-up of core and source checks; mart checks do not gate a load."""
    return summarize(results.where(~F.col("check_name").startswith("marts."))).withColumn(
        "scope", F.lit("relational_core_and_source")
    )


def to_markdown(results: DataFrame) -> DataFrame:
    """One table line per result, pipes and line breaks escaped."""

    def cell(name):
        text = F.coalesce(F.col(name).cast("string"), F.lit("—"))
        return F.replace(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))

    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(f.name) for f in RESULT_SCHEMA]), F.lit(" |"))
    return results.select("check_name", "item", line.alias("line"))


def write_report(results: DataFrame, path: str, *, markdown: bool = False) -> None:
    """Write the (small) report as JSON lines or Markdown table lines."""
    if markdown:
        to_markdown(results).orderBy("check_name", "item").select("line").coalesce(1).write.mode("overwrite").text(path)
    else:
        results.orderBy("check_name", "item").coalesce(1).write.mode("overwrite").json(path)
