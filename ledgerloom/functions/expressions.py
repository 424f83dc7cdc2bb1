"""Reusable column expressions: text trimming, safe casts, rounding, guarded ratios."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LEDGER_COLUMNS

# Every character Unicode calls white space; Spark's plain trim removes blanks only.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(column: Column) -> Column:
    """Text without white space at its ends. Most cells begin and end with a printable ASCII character and are left as they are unread."""
    text = column.cast("string")
    last = F.substring(text, -1, 1)
    bare = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(bare, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def as_number(df: DataFrame, name: str) -> Column:
    """Numeric value of a column; NaN, and text that is no number, become null. Infinities stay."""
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.NumericType) and not isinstance(kind, (T.DoubleType, T.FloatType)):
        return column
    number = column if isinstance(kind, T.NumericType) else column.try_cast("double")
    return F.when(~F.isnan(number), number)


def as_whole_number(df: DataFrame, name: str) -> Column:
    """A number without a fraction as a long; anything else becomes null."""
    number = as_number(df, name)
    return F.when(number.cast("double") == F.floor(number.cast("double")), number.try_cast("bigint"))


def is_fractional(df: DataFrame, name: str) -> Column:
    """Whether a cell holds a number that is no whole number a long can hold."""
    return truth(as_number(df, name).isNotNull() & as_whole_number(df, name).isNull())


# Date texts read besides ISO dates: month first, as the public CSV export of the ledger writes them.
DATE_FORMATS = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy")


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Wall-clock timestamp of a column, ISO or one of ``DATE_FORMATS``; other text becomes null."""
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return column
    iso = column.try_cast("timestamp_ntz")
    if not isinstance(kind, T.StringType):
        return iso
    return F.coalesce(iso, *[F.try_to_timestamp(column, F.lit(f)).cast("timestamp_ntz") for f in DATE_FORMATS])


def truth(condition: Column) -> Column:
    """A condition whose unknown outcome counts as false."""
    return F.coalesce(condition, F.lit(False))


def differs(left: Column, right: Column) -> Column:
    return ~left.eqNullSafe(right)


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_if(value: Column, condition: Column) -> Column:
    """Sum over matching rows, zero when none matches."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def money(column: Column, precision: int = 24) -> Column:
    """Exact money; the default width holds sums over any number of lines."""
    return column.cast(T.DecimalType(precision, 2))


def round_half_even(column: Column, digits: int = 0) -> Column:
    """Binary-float rounding, ties to even at the scaled value."""
    scale = float(10**digits)
    return F.rint(column.cast("double") * scale) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Float quotient, 0.0 unless the denominator is positive."""
    return F.when(
        denominator > 0, numerator.cast("double") / denominator.cast("double")
    ).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    share = part.cast("double") / whole.cast("double") * 100.0
    return F.when(whole > 0, round_half_even(share, digits)).otherwise(F.lit(0.0))


def right_closed_label(value: Column, bins) -> Column:
    """Label of the right-closed bin holding the value; the first bin has no lower, the last no upper bound."""
    label = F.lit(bins[-1][1])
    for upper, name in reversed(bins[:-1]):
        label = F.when(value <= upper, F.lit(name)).otherwise(label)
    return label


def attach_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to every row, evaluated once as a scalar subquery."""
    packed = row.select(F.struct(*[F.col(f"`{c}`") for c in row.columns])).scalar()
    return df.withColumn("_attached", packed).select(
        *[F.col(f"`{c}`") for c in df.columns], *[F.col(f"_attached.`{c}`").alias(c) for c in row.columns]
    )


def canonical_row(ledger: DataFrame) -> Column:
    """A ledger row as one text, the same for numeric and textual input columns."""

    def text(name: str) -> Column:
        column = F.col(f"`{name}`")
        if name in ("Quantity", "Price", "Customer ID"):
            column = as_number(ledger, name).cast("decimal(38,6)")
        elif name == "InvoiceDate":
            column = F.date_format(as_timestamp(ledger, name), "yyyy-MM-dd HH:mm:ss")
        return F.coalesce(column.cast("string"), F.lit("\\N"))

    return F.concat_ws("|", *[text(c) for c in [*LEDGER_COLUMNS, "source_sheet"]])
