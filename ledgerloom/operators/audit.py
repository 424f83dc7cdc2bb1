"""Profiling of the raw ledger before cleaning: schema, missing values, copies, extremes, dates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import month_start, spine
from ..functions.expressions import as_number, as_timestamp, attach_row, canonical_row, count_if, percent, strip, truth
from ..functions.ranks import column_limits, column_quantiles, exact_quantiles
from ..schema import LEDGER_COLUMNS
from .cleaning import duplicate_groups, flag_duplicates


def _all() -> Column:
    return F.count(F.lit(1))


def _rows(ledger: DataFrame) -> Column:
    return ledger.agg(_all()).scalar()


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


# --- structure ---------------------------------------------------------------------------------


def sheet_overview(sheets: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per sheet and whether all sheets share one column list."""
    compatible = len({tuple(frame.columns) for frame in sheets.values()}) == 1
    return _union(
        frame.agg(_all().alias("row_count")).select(
            F.lit(name).alias("sheet"),
            "row_count",
            F.lit(len(frame.columns)).alias("column_count"),
            F.lit(compatible).alias("schemas_compatible"),
        )
        for name, frame in sheets.items()
    )


def find_column(columns: list[str], candidates: list[str]) -> str | None:
    """The column whose name equals a candidate when case and blanks are ignored."""

    def plain(name):
        return "".join(str(name).split()).lower()

    known = {plain(c): c for c in columns}
    return next((known[plain(c)] for c in candidates if plain(c) in known), None)


def resolve_columns(ledger: DataFrame, roles: dict[str, list[str]]) -> DataFrame:
    """Rename whatever columns match each role's candidates to the role name."""
    found = {find_column(ledger.columns, names): role for role, names in roles.items()}
    found.pop(None, None)
    return ledger.withColumnsRenamed(found)


def _unpivoted(ledger: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value as text, source_order) for every non-null cell."""
    text = ledger.select("source_order", *[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return text.unpivot(["source_order"], [F.col(f"`{c}`") for c in columns], "column_name", "value").where(
        F.col("value").isNotNull()
    )


def column_profile(ledger: DataFrame, examples: int = 5) -> DataFrame:
    """Type, distinct count and the first distinct values of each column."""
    columns = [c for c in ledger.columns if c != "source_order"]
    distinct = (
        _unpivoted(ledger, columns).groupBy("column_name", "value").agg(F.min("source_order").alias("first_seen"))
    )
    counts = distinct.groupBy("column_name").agg(_all().alias("unique_count"))
    # row_number <= n is pushed below the shuffle, so only n rows per task and column move.
    order = Window.partitionBy("column_name").orderBy("first_seen", "value")
    first = (
        distinct.withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= examples)
        .groupBy("column_name")
        .agg(F.array_sort(F.collect_list(F.struct("position", "value"))).alias("pairs"))
        .select("column_name", F.array_join("pairs.value", " | ").alias("example_values"))
    )
    types = ledger.sparkSession.createDataFrame(
        [(c, ledger.schema[c].dataType.simpleString()) for c in columns], "column_name string, data_type string"
    )
    return (
        types.join(counts, "column_name", "left")
        .join(first, "column_name", "left")
        .withColumn("unique_count", F.coalesce("unique_count", F.lit(0)))
    )


def mixed_types(ledger: DataFrame) -> DataFrame:
    """Whole-number and other values per text column."""
    columns = [f.name for f in ledger.schema if isinstance(f.dataType, T.StringType)]
    whole = {c: count_if(F.col(f"`{c}`").rlike("^[0-9]+$")).alias(f"{c}|int") for c in columns}
    known = {c: F.count(F.col(f"`{c}`")).alias(f"{c}|all") for c in columns}
    counted = ledger.agg(*whole.values(), *known.values())
    frames = [
        counted.select(
            F.lit(c).alias("column_name"),
            F.col(f"`{c}|int`").alias("integer_values"),
            (F.col(f"`{c}|all`") - F.col(f"`{c}|int`")).alias("text_values"),
        )
        for c in columns
    ]
    return _union(frames)


def customer_id_integrity(ledger: DataFrame) -> DataFrame:
    customer = as_number(ledger, "Customer ID").cast("double")
    return ledger.agg(
        F.count(customer).alias("non_null_values"), count_if(customer % 1 != 0).alias("non_integer_values")
    )


# --- missing values -------------------------------------------------------------------------------


def missing_table(ledger: DataFrame) -> DataFrame:
    """Missing count and percent per column, per sheet and over all sheets."""
    columns = LEDGER_COLUMNS
    per_sheet = ledger.groupBy("source_sheet").agg(
        _all().alias("_rows"), *[count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns]
    )
    overall = per_sheet.agg(
        F.sum("_rows").alias("_rows"), *[F.sum(F.col(f"`{c}`")).alias(c) for c in columns]
    ).withColumn("source_sheet", F.lit("all"))
    return (
        per_sheet.unionByName(overall)
        .unpivot(["source_sheet", "_rows"], [F.col(f"`{c}`") for c in columns], "column_name", "missing_count")
        .select(
            "source_sheet", "column_name", "missing_count",
            percent(F.col("missing_count"), F.col("_rows"), 3).alias("missing_percent"),
        )
    )


def missing_together(ledger: DataFrame) -> DataFrame:
    """How often description and customer are missing together."""
    return ledger.groupBy(
        F.col("Description").isNull().alias("description_missing"),
        F.col("`Customer ID`").isNull().alias("customer_missing"),
    ).agg(_all().alias("row_count"))


def _moments() -> list[Column]:
    return [
        F.count("value").alias("value_count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    ]


def number_summary(rows: DataFrame, column: str, levels: dict[str, float] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quantiles of one column."""
    levels = levels or {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    values = rows.select(as_number(rows, column).cast("double").alias("value"))
    quantiles = exact_quantiles(values, "value", levels)
    summary = values.agg(*_moments())
    return attach_row(summary, quantiles)


def undescribed_prices(ledger: DataFrame) -> DataFrame:
    return number_summary(ledger.where(F.col("Description").isNull()), "Price")


# --- copies -------------------------------------------------------------------------------------------


def duplicate_summary(ledger: DataFrame) -> DataFrame:
    groups = duplicate_groups(ledger)
    return (
        groups.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_in_duplicate_groups"),
            F.coalesce(
                F.sum("copies") - count_if(F.col("source_sheet") == F.col("first_sheet")), F.lit(0)
            ).alias("duplicate_count"),
        )
        .withColumn("_rows", _rows(ledger))
        .withColumn("duplicate_percent", percent(F.col("duplicate_count"), F.col("_rows"), 3))
        .drop("_rows")
    )


def duplicate_scopes(ledger: DataFrame) -> DataFrame:
    """Extra copies inside each sheet, and those that only appear across sheets."""
    groups = duplicate_groups(ledger)
    extra = groups.groupBy("source_sheet").agg(F.sum(F.col("copies") - 1).alias("duplicate_count"))
    within = (
        ledger.groupBy("source_sheet")
        .agg(_all().alias("_rows"))
        .join(extra, "source_sheet", "left")
        .select(
            F.concat(F.lit("within "), "source_sheet").alias("scope"),
            F.coalesce("duplicate_count", F.lit(0)).alias("duplicate_count"),
            percent(F.coalesce("duplicate_count", F.lit(0)), F.col("_rows"), 3).alias("duplicate_percent"),
        )
    )
    # A copy in a later sheet is extra overall but first in its own sheet.
    across = groups.agg(
        count_if(F.col("source_sheet") != F.col("first_sheet")).alias("duplicate_count")
    ).select(F.lit("cross-sheet only").alias("scope"), "duplicate_count", F.lit(None).cast("double").alias("duplicate_percent"))
    return within.unionByName(across)


def duplicate_samples(ledger: DataFrame, limit: int = 12) -> DataFrame:
    flagged = flag_duplicates(ledger)
    return (
        flagged.where("is_duplicate_within_sheet OR is_duplicate_cross_sheet")
        .orderBy("Invoice", "StockCode", "InvoiceDate", "source_order")
        .limit(limit)
        .select(*[F.col(f"`{c}`") for c in LEDGER_COLUMNS], "source_sheet")
    )


# --- invalid values --------------------------------------------------------------------------------------

QUANTILE_GRID = {
    "p0": 0.0, "p0_1": 0.001, "p1": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99,
    "p99_9": 0.999, "p100": 1.0,
}


def describe_numbers(ledger: DataFrame) -> DataFrame:
    """Summary and nine-level quantile grid of quantity and price."""
    columns = {c: as_number(ledger, c) for c in ("Quantity", "Price")}
    quantiles = column_quantiles(ledger, columns, QUANTILE_GRID)
    summaries = _union(
        ledger.select(column.cast("double").alias("value")).agg(*_moments()).withColumn("column_name", F.lit(name)) for name, column in columns.items()
    )
    names = [c for c in summaries.columns if c != "column_name"]
    return summaries.join(quantiles, "column_name", "left").select(*names, *QUANTILE_GRID, "column_name")


def issue_table(ledger: DataFrame, level: float = 0.999) -> DataFrame:
    """Rows showing each suspicious property, with the share of all rows."""
    numbers = ledger.withColumns(
        {"_quantity": as_number(ledger, "Quantity"), "_price": as_number(ledger, "Price")}
    ).withColumn("_size", F.abs("_quantity"))
    limits = column_limits(numbers, {"_size_limit": F.col("_size"), "_price_limit": F.col("_price")}, level)
    numbers = attach_row(numbers, limits)
    quantity, price, size = F.col("_quantity"), F.col("_price"), F.col("_size")
    size_limit, price_limit = F.col("_size_limit"), F.col("_price_limit")
    issues = {
        "quantity <= 0": quantity <= 0,
        "quantity < 0": quantity < 0,
        "quantity = 0": quantity == 0,
        "|quantity| > p99.9": size > size_limit,
        "price <= 0": price <= 0,
        "price < 0": price < 0,
        "price = 0": price == 0,
        "price > p99.9": price > price_limit,
        "stock code missing": F.col("StockCode").isNull(),
        "invoice missing": F.col("Invoice").isNull(),
        "customer id missing": F.col("`Customer ID`").isNull(),
        "description missing": F.col("Description").isNull(),
        "description blank": strip(F.col("Description")) == "",
    }
    counted = numbers.agg(_all().alias("_rows"), *[count_if(c).alias(f"i{n}") for n, c in enumerate(issues.values())])
    names = F.create_map(*[F.lit(x) for n, name in enumerate(issues) for x in (f"i{n}", name)])
    return counted.unpivot(["_rows"], [f"i{n}" for n in range(len(issues))], "_key", "row_count").select(
        names[F.col("_key")].alias("issue"), "row_count", percent(F.col("row_count"), F.col("_rows"), 3).alias("percent")
    )


def extremes(ledger: DataFrame, limit: int = 10) -> DataFrame:
    """The largest quantities by size, the largest prices, and the first negative prices."""
    rows = ledger.select(
        "Invoice", "StockCode", as_number(ledger, "Quantity").alias("Quantity"),
        as_number(ledger, "Price").alias("Price"), "source_order",
    )

    def top(kind, frame, *order):
        return frame.orderBy(*order, "source_order").limit(limit).select(
            F.lit(kind).alias("kind"), "Invoice", "StockCode", "Quantity", "Price"
        )

    return _union(
        [
            top("largest quantity", rows, F.desc(F.abs("Quantity"))),
            top("largest price", rows, F.desc("Price")),
            top("negative price", rows.where("Price < 0")),
        ]
    )


def _nonstandard(ledger: DataFrame) -> DataFrame:
    code = strip(F.col("StockCode"))
    return ledger.withColumn("code", code).where(~code.rlike("^[0-9]{5}"))


def nonstandard_codes(ledger: DataFrame, limit: int = 20) -> DataFrame:
    """Most frequent codes not starting with five digits, with their first description."""
    by_text = _nonstandard(ledger).groupBy("code", "Description").agg(
        _all().alias("n"), F.min("source_order").alias("first_order")
    )
    described = F.when(F.col("Description").isNotNull(), F.col("first_order"))
    return (
        by_text.groupBy("code")
        .agg(F.sum("n").alias("row_count"), F.min_by("Description", described).alias("sample_description"))
        .orderBy(F.desc("row_count"), "code")
        .limit(limit)
    )


def nonstandard_code_totals(ledger: DataFrame) -> DataFrame:
    return _nonstandard(ledger).agg(_all().alias("row_count"), F.countDistinct("code").alias("unique_codes"))


# --- returns and cancellations ---------------------------------------------------------------------------


def invoice_prefix() -> Column:
    letters = F.regexp_extract(strip(F.col("Invoice")), "^([A-Za-z]+)", 1)
    return F.when(letters == "", "<numeric>").otherwise(letters)


def prefix_profile(ledger: DataFrame) -> DataFrame:
    per_invoice = ledger.groupBy(strip(F.col("Invoice")).alias("Invoice")).agg(_all().alias("n"))
    return per_invoice.groupBy(invoice_prefix().alias("prefix")).agg(
        F.sum("n").alias("row_count"), _all().alias("unique_invoices")
    )


def cancellation_rates(ledger: DataFrame) -> DataFrame:
    cancelled = F.col("prefix") == "C"
    return (
        prefix_profile(ledger)
        .agg(
            F.coalesce(F.sum(F.when(cancelled, F.col("unique_invoices"))), F.lit(0)).alias("cancellation_invoices"),
            F.sum("unique_invoices").alias("total_invoices"),
            F.coalesce(F.sum(F.when(cancelled, F.col("row_count"))), F.lit(0)).alias("cancellation_rows"),
            F.sum("row_count").alias("_rows"),
        )
        .select(
            "cancellation_invoices",
            "total_invoices",
            percent(F.col("cancellation_invoices"), F.col("total_invoices"), 3).alias("cancellation_invoice_percent"),
            "cancellation_rows",
            percent(F.col("cancellation_rows"), F.col("_rows"), 3).alias("cancellation_row_percent"),
        )
    )


def cancellation_by_sign(ledger: DataFrame) -> DataFrame:
    """Row counts by cancellation prefix and quantity sign, with ``All`` margins."""
    quantity = as_number(ledger, "Quantity")
    sign = F.when(quantity < 0, "negative").when(quantity == 0, "zero").when(quantity > 0, "positive")
    cells = (
        ledger.groupBy((invoice_prefix() == "C").cast("string").alias("is_c_invoice"), sign.alias("quantity_sign"))
        .agg(_all().alias("n"))
        .where(F.col("quantity_sign").isNotNull())
    )
    return (
        cells.cube("is_c_invoice", "quantity_sign")
        .agg(F.sum("n").alias("row_count"))
        .select(
            F.coalesce("is_c_invoice", F.lit("All")).alias("is_c_invoice"),
            F.coalesce("quantity_sign", F.lit("All")).alias("quantity_sign"),
            "row_count",
        )
    )


def negative_outside_cancellations(ledger: DataFrame) -> DataFrame:
    """Negative quantities on other invoices: prices and missing customers."""
    negative = ledger.where(truth(as_number(ledger, "Quantity") < 0) & (invoice_prefix() != "C"))
    missing = negative.agg(
        _all().alias("row_count"), count_if(F.col("`Customer ID`").isNull()).alias("missing_customers")
    )
    return attach_row(number_summary(negative, "Price"), missing)


# --- dates --------------------------------------------------------------------------------------------------


def _per_day(ledger: DataFrame) -> DataFrame:
    """One row per calendar day, the base of every coverage report."""
    moment = as_timestamp(ledger, "InvoiceDate")
    return (
        ledger.where(moment.isNotNull())
        .groupBy(F.to_date(moment).alias("day"))
        .agg(_all().alias("n"), F.min(moment).alias("first_date"), F.max(moment).alias("last_date"))
    )


def date_coverage(ledger: DataFrame) -> DataFrame:
    return _per_day(ledger).agg(
        F.min("first_date").alias("min_date"),
        F.max("last_date").alias("max_date"),
        (F.datediff(F.max("day"), F.min("day")) + 1).alias("calendar_span_days"),
        _all().alias("observed_days"),
    )


def rows_per_year(ledger: DataFrame) -> DataFrame:
    return _per_day(ledger).groupBy(F.year("day").alias("year")).agg(F.sum("n").alias("record_count")).orderBy("year")


def monthly_coverage(ledger: DataFrame) -> DataFrame:
    """Every month of the span: rows, active days, edges, and whether it is missing or cut off."""
    observed = (
        _per_day(ledger)
        .groupBy(month_start(F.col("day")).alias("month"))
        .agg(
            F.sum("n").alias("record_count"),
            _all().alias("active_days"),
            F.min("first_date").alias("first_date"),
            F.max("last_date").alias("last_date"),
        )
    )
    edges = observed.agg(F.min("month").alias("first"), F.max("month").alias("last"))
    first, last = F.col("first"), F.col("last")
    return (
        attach_row(spine(observed, "month", "1 month").join(observed, "month", "left"), edges)
        .select(
            "month",
            F.coalesce("record_count", F.lit(0)).alias("record_count"),
            F.coalesce("active_days", F.lit(0)).alias("active_days"),
            "first_date",
            "last_date",
            F.col("record_count").isNull().alias("is_missing"),
            truth((F.col("month") == first) & (F.to_date("first_date") > F.col("month"))).alias("starts_late"),
            truth((F.col("month") == last) & (F.to_date("last_date") < F.last_day("month"))).alias("ends_early"),
        )
    )


def sheet_overlaps(ledger: DataFrame) -> DataFrame:
    """Each sheet against the one starting before it: overlap window and rows inside it."""
    moment = as_timestamp(ledger, "InvoiceDate")
    dated = ledger.select("source_sheet", moment.alias("moment"))
    per_sheet = dated.groupBy("source_sheet").agg(
        F.min("moment").alias("min_date"), F.max("moment").alias("max_date"), _all().alias("row_count")
    )
    # One row per sheet; sheets are folders named by the caller.
    order = Window.orderBy("min_date", "source_sheet")
    pairs = per_sheet.select(
        "source_sheet",
        "min_date",
        "max_date",
        "row_count",
        F.lag("source_sheet").over(order).alias("previous_sheet"),
        F.lag("max_date").over(order).alias("previous_max"),
    ).withColumn("overlaps", truth(F.col("min_date") <= F.col("previous_max")))
    sides = pairs.where("overlaps").select(
        F.explode(
            F.array(
                F.struct(F.col("source_sheet").alias("sheet"), F.lit("current").alias("side")),
                F.struct(F.col("previous_sheet").alias("sheet"), F.lit("previous").alias("side")),
            )
        ).alias("s"),
        F.col("source_sheet").alias("pair"),
        F.col("min_date").alias("start"),
        F.col("previous_max").alias("end"),
    ).select("s.sheet", "s.side", "pair", "start", "end")
    inside = (
        dated.join(sides, F.col("source_sheet") == F.col("sheet"))
        .where(F.col("moment").between(F.col("start"), F.col("end")))
        .groupBy("pair")
        .agg(
            count_if(F.col("side") == "previous").alias("previous_rows_in_window"),
            count_if(F.col("side") == "current").alias("current_rows_in_window"),
        )
    )
    return pairs.join(inside, F.col("source_sheet") == F.col("pair"), "left").select(
        "source_sheet", "min_date", "max_date", "row_count", "previous_sheet", "overlaps",
        F.when(F.col("overlaps"), F.col("min_date")).alias("window_start"),
        F.when(F.col("overlaps"), F.col("previous_max")).alias("window_end"),
        "previous_rows_in_window",
        "current_rows_in_window",
    )


# --- samples -------------------------------------------------------------------------------------------------


def row_sample(ledger: DataFrame, n: int, seed: int = 42, where: Column | None = None) -> DataFrame:
    """``n`` rows chosen by a seeded hash of their content: the same on every run and layout."""
    rows = ledger if where is None else ledger.where(where)
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), canonical_row(ledger)))
    return rows.orderBy(draw).limit(n).select(*[F.col(f"`{c}`") for c in LEDGER_COLUMNS], "source_sheet")
