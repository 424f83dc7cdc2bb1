"""Exact order statistics without a global sort, by one plan for every size.

Equal values are first collapsed to one row with a count (map-side combined). A value's place on a fixed
logarithmic scale, which grows with the value and does not depend on the data, gives it three nested
buckets, coarse to fine. A rank is the sum of the sizes of all lower buckets on each level plus a running sum
inside the finest bucket. A window never holds more than ``FAN_OUT`` buckets, whatever the number of rows, and
nothing is counted or sampled on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVEL_BITS = 16
FAN_OUT = 1 << LEVEL_BITS
# log1p of the largest double is below 710; infinities and NaN share the last bucket and are ordered inside it
_TOP = 710.0
_SCALE = float(1 << 36)


def scale_position(value: Column) -> Column:
    """A long that never falls as the value grows: signed log1p, to about 1.5e-11."""
    number = value.cast("double")
    size = F.least(F.log1p(F.abs(number)), F.lit(_TOP))
    return F.floor(F.when(number < 0, -size).otherwise(size) * _SCALE).cast("bigint")


def _lower_sizes(sizes: DataFrame, within: list[str], bucket: str, name: str) -> DataFrame:
    """Adds the total size of all lower buckets of the same parent."""
    order = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    return sizes.withColumn(name, F.sum("_size").over(order.orderBy(bucket)) - F.col("_size"))


def value_ranks(df: DataFrame, value: str, keys: list[str] = ()) -> DataFrame:
    """One row per distinct value: ``n`` copies holding the 1-based ranks ``lo..hi`` of ``total``.

    Ranks are ascending within each key combination; null values are left out.
    """
    keys = list(keys)
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("_fine", scale_position(F.col(value)))
    middle, coarse = F.shiftright("_fine", LEVEL_BITS), F.shiftright("_fine", 2 * LEVEL_BITS)

    fine = counted.groupBy(*keys, "_fine").agg(F.sum("n").alias("_size"))
    fine = fine.withColumn("_middle", middle).withColumn("_coarse", coarse)
    per_middle = fine.groupBy(*keys, "_coarse", "_middle").agg(F.sum("_size").alias("_size"))
    per_coarse = per_middle.groupBy(*keys, "_coarse").agg(F.sum("_size").alias("_size"))

    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    per_coarse = _lower_sizes(per_coarse.withColumn("total", F.sum("_size").over(whole)), keys, "_coarse", "_below_coarse")
    per_middle = _lower_sizes(per_middle, [*keys, "_coarse"], "_middle", "_below_middle")
    fine = _lower_sizes(fine, [*keys, "_middle"], "_fine", "_below_fine")
    below = fine.drop("_size").join(per_middle.drop("_size", "_coarse"), [*keys, "_middle"])
    below = below.join(per_coarse.drop("_size"), [*keys, "_coarse"]).select(
        *keys, "_fine", "total", (F.col("_below_coarse") + F.col("_below_middle") + F.col("_below_fine")).alias("_below")
    )
    inside = Window.partitionBy(*keys, "_fine").orderBy(value)
    return (
        counted.withColumn("_running", F.sum("n").over(inside))
        .join(below, [*keys, "_fine"])
        .withColumn("hi", F.col("_below") + F.col("_running"))
        .withColumn("lo", F.col("hi") - F.col("n") + 1)
        .select(*keys, value, "n", "lo", "hi", "total")
    )


def group_ranks(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """``value_ranks`` for very many groups: two shuffles of the counted values instead of one for each level of buckets.

    A task holds one group at a time, sorted by distinct value and spilled if it is large, so groups need an order of values but no
    buckets. A group must have values that repeat, as prices in cents do; for few groups over all rows use ``value_ranks``.
    """
    present = F.col(value).isNotNull()
    for key in keys:
        present = present & F.col(key).isNotNull()
    counted = df.where(present).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    # Both sums share one sort; the rows of a group are spilled if they are many.
    upward = Window.partitionBy(*keys).orderBy(value)
    whole = upward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = counted.select("*", F.sum("n").over(upward).alias("hi"), F.sum("n").over(whole).alias("total"))
    return ranked.select(*keys, value, "n", (F.col("hi") - F.col("n") + 1).alias("lo"), "hi", "total")


def continuous_quantiles(ranks: DataFrame, value: str, levels: dict[str, float], keys: list[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles from ``value_ranks``; one row per key combination."""

    def at(position: Column) -> Column:
        covered = (position >= F.col("lo") - 1) & (position <= F.col("hi") - 1)
        return F.max(F.when(covered, F.col(value).cast("double")))

    parts = []
    for name, level in levels.items():
        position = (F.col("total") - 1).cast("double") * F.lit(float(level))
        parts += [
            at(F.floor(position)).alias(f"_{name}_low"),
            at(F.ceil(position)).alias(f"_{name}_high"),
            F.max(position - F.floor(position)).alias(f"_{name}_step"),
        ]
    grouped = ranks.groupBy(*keys).agg(*parts)
    return grouped.select(
        *keys,
        *[
            (
                F.col(f"_{name}_low")
                + (F.col(f"_{name}_high") - F.col(f"_{name}_low")) * F.col(f"_{name}_step")
            ).alias(name)
            for name in levels
        ],
    )


def column_ranks(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``value_ranks`` of several columns in one plan: (column_name, value, n, lo, hi, total), values as doubles."""
    cells = F.array(*[F.struct(F.lit(name).alias("column_name"), column.cast("double").alias("value")) for name, column in columns.items()])
    stacked = df.select(F.explode(cells).alias("cell")).select("cell.*")
    return value_ranks(stacked, "value", ["column_name"])


def column_quantiles(df: DataFrame, columns: dict[str, Column], levels: dict[str, float]) -> DataFrame:
    """Exact continuous quantiles of several columns: one row per column that has values."""
    return continuous_quantiles(column_ranks(df, columns), "value", levels, ["column_name"])


def column_limits(df: DataFrame, columns: dict[str, Column], level: float) -> DataFrame:
    """One row with one quantile of each column under the column's name."""
    found = column_quantiles(df, columns, {"limit": level})
    return found.agg(*[F.max(F.when(F.col("column_name") == name, F.col("limit"))).alias(name) for name in columns])


def exact_quantiles(df: DataFrame, value: str, levels: dict[str, float]) -> DataFrame:
    """One row of exact continuous quantiles over the whole frame."""
    return continuous_quantiles(value_ranks(df, value), value, levels)
