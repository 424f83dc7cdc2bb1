"""Ledger cleaning: typed columns, duplicate detection, business flags.

Input is the eight ledger columns, ``source_sheet`` and ``source_order`` (a long that grows
with the source position).  Rows are never dropped for quality reasons; only copies of a row
already seen in an earlier sheet are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import as_number, as_timestamp, as_whole_number, strip, truth
from ..schema import CLEAN_COLUMNS, LEDGER_COLUMNS, NON_PRODUCT_CODES, NON_PRODUCT_PREFIX
from ..session import STAGED_CODEC, scratch_table
from ..sources.sheets import require_ledger_columns, sheet_position

_KEY = [f"`{c}`" for c in LEDGER_COLUMNS]
_ROW = [*_KEY, "source_sheet", "source_order"]
_FLAGS = ["is_duplicate_within_sheet", "is_duplicate_cross_sheet", "is_repeat_of_earlier_sheet"]
FILTER_BITS = 26  # of the set filter of repeated hashes: 8 MB of bits, at most a million rows


def normalise(ledger: DataFrame) -> DataFrame:
    """Trim text, upper-case stock codes and coerce numbers and dates; bad values and fractional ids become null."""
    ledger = require_ledger_columns(ledger)
    if "source_order" not in ledger.columns:
        ledger = ledger.withColumn("source_order", F.monotonically_increasing_id())
    return ledger.select(
        strip(F.col("Invoice")).alias("Invoice"),
        F.upper(strip(F.col("StockCode"))).alias("StockCode"),
        strip(F.col("Description")).alias("Description"),
        as_number(ledger, "Quantity").alias("Quantity"),
        as_timestamp(ledger, "InvoiceDate").alias("InvoiceDate"),
        as_number(ledger, "Price").cast("double").alias("Price"),
        as_whole_number(ledger, "Customer ID").alias("Customer ID"),
        strip(F.col("Country")).alias("Country"),
        "source_sheet",
        "source_order",
    )


def suspect_filter(hashed: DataFrame) -> DataFrame:
    """A set filter of the ``_hash`` values that occur more than once: (_word, _bits), at most 2**(FILTER_BITS - 6) rows.

    Each repeated hash sets the bit that its low FILTER_BITS bits name. Only hashes and counts are shuffled for it.
    """
    repeated = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    bit = F.expr("shiftleft(1L, cast(_hash & 63 as int))")
    return repeated.groupBy(_filter_word(F.col("_hash")).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def _filter_word(value: Column) -> Column:
    return F.shiftright(value.bitwiseAND((1 << FILTER_BITS) - 1), 6)


def split_suspects(rows: DataFrame, *, write_filter: bool = False) -> DataFrame:
    """``rows`` with ``_hash`` and ``_suspect``: true for every member of a repeated hash, and for few others.

    The filter has a fixed largest size, so it is broadcast however large the ledger is; if it fills up, more rows are suspects,
    which costs time but no correctness. ``write_filter`` makes it once for several uses of the result.
    """
    hashed = rows.withColumn("_hash", F.xxhash64(*_KEY))
    members = suspect_filter(hashed)
    if write_filter:
        members = scratch_table(members, "repeated")
    held = hashed.join(F.broadcast(members), _filter_word(F.col("_hash")) == F.col("_word"), "left")
    inside = F.getbit(F.col("_bits"), F.col("_hash").bitwiseAND(63).cast("int")) == 1
    return held.withColumn("_suspect", truth(inside)).drop("_word", "_bits")


def _groups_of(suspects: DataFrame) -> DataFrame:
    per_sheet = suspects.groupBy("_hash", *_KEY, "source_sheet").agg(
        F.count(F.lit(1)).alias("copies"), F.min("source_order").alias("_first")
    )
    # One row per sheet and group: the window never holds more rows than there are sheets.
    group = Window.partitionBy("_hash", *_KEY)
    return per_sheet.select(
        "*",
        F.count(F.lit(1)).over(group).alias("sheets"),
        F.first("source_sheet").over(group.orderBy("_first")).alias("first_sheet"),
    ).where("copies > 1 OR sheets > 1")


def duplicate_groups(rows: DataFrame) -> DataFrame:
    """Groups of rows equal in all eight columns, one output row per group and sheet.

    Only rows that the filter of repeated 64-bit hashes lets through are compared on their real columns.
    Counting is pre-aggregated before every shuffle, so a group that
    holds a large share of the ledger costs one partial row per task.
    """
    return _groups_of(split_suspects(rows).where("_suspect"))


def flag_duplicates(rows: DataFrame) -> DataFrame:
    """Add both duplicate flags and ``is_repeat_of_earlier_sheet``.

    Rows that the filter clears are flagged where they are scanned; only suspects are shuffled.
    """
    split = split_suspects(rows, write_filter=True)
    clear = split.where(~F.col("_suspect")).select(*_ROW, *[F.lit(False).alias(flag) for flag in _FLAGS])
    # Written, because the rows and their groups would each scan the whole ledger for them.
    return clear.unionByName(settle_suspects(scratch_table(split.where("_suspect").drop("_suspect"), "suspects")))


def settle_suspects(suspects: DataFrame) -> DataFrame:
    """Rows with ``_hash``, all members of a repeated hash among them, flagged by a comparison of their real columns."""
    left, groups = suspects.alias("r"), _groups_of(suspects).alias("g")
    same_row = (F.col("r._hash") == F.col("g._hash")) & (F.col("r.source_sheet") == F.col("g.source_sheet"))
    for name in _KEY:
        same_row = same_row & F.col(f"r.{name}").eqNullSafe(F.col(f"g.{name}"))
    crosses = truth(F.col("g.sheets") > 1)
    settled = left.join(groups, same_row, "left").select(
        *[F.col(f"r.{c}") for c in _ROW],
        truth(F.col("g.copies") > 1).alias(_FLAGS[0]),
        crosses.alias(_FLAGS[1]),
        (crosses & (F.col("r.source_sheet") != F.col("g.first_sheet"))).alias(_FLAGS[2]),
    )
    return settled


def drop_cross_sheet_repeats(flagged: DataFrame) -> DataFrame:
    """Keep a cross-sheet group in its first sheet only; copies inside a sheet all stay."""
    return flagged.where(~F.col("is_repeat_of_earlier_sheet")).drop("is_repeat_of_earlier_sheet")


def is_non_product_code(code: Column) -> Column:
    return truth(code.isin(NON_PRODUCT_CODES) | code.startswith(NON_PRODUCT_PREFIX))


def business_flags(rows: DataFrame) -> DataFrame:
    """The thirteen row-level flags and the float ledger amount."""
    invoice = F.upper("Invoice")
    quantity, price, customer = F.col("Quantity"), F.col("Price"), F.col("`Customer ID`")
    cancelled = truth(invoice.startswith("C"))
    bad_debt = truth(invoice.startswith("A"))
    negative = truth(quantity < 0)
    free = truth(price == 0)
    priced = truth(price > 0)
    non_product = is_non_product_code(F.upper("StockCode"))
    flags = {
        "is_cancellation": cancelled,
        "is_bad_debt_adjustment": bad_debt,
        "is_negative_quantity": negative,
        "is_return": cancelled,
        "is_inventory_adjustment": negative & ~cancelled & free & customer.isNull(),
        "has_customer_id": customer.isNotNull(),
        "has_description": F.col("Description").isNotNull(),
        "has_valid_price": priced,
        "is_price_zero": free,
        "is_price_negative": truth(price < 0),
        "is_non_product": non_product,
        "is_unknown_special_code": F.lit(False),
        "is_valid_sale": ~cancelled & ~bad_debt & truth(quantity > 0) & priced & ~non_product,
    }
    return rows.withColumns(flags).withColumn("line_total", quantity.cast("double") * price)


def clean_ledger(ledger: DataFrame) -> DataFrame:
    """Raw ledger to the cleaned ledger (25 columns plus ``source_order``)."""
    return _cleaned(flag_duplicates(normalise(ledger)))


def _cleaned(flagged: DataFrame, *also: str) -> DataFrame:
    return business_flags(drop_cross_sheet_repeats(flagged)).select(*[F.col(f"`{c}`") for c in CLEAN_COLUMNS], "source_order", *also)


def write_clean_ledger(ledger: DataFrame, path: str) -> DataFrame:
    """``clean_ledger`` written below ``path`` and read back, in one scan of the ledger after that for its hashes.

    Each task writes clear rows and suspects into two folders; suspects are settled from theirs and written beside the clear ones.
    """
    spark = ledger.sparkSession
    split = split_suspects(normalise(ledger), write_filter=True).drop("_hash")
    scanned = _cleaned(split.withColumns({flag: F.lit(False) for flag in _FLAGS}), "_suspect")
    # Two open files a task; otherwise each task would sort its rows by folder.
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, "2")
    try:
        scanned.write.mode("overwrite").partitionBy("_suspect").option(*STAGED_CODEC).parquet(f"{path}/scanned")
    finally:
        spark.conf.set(writers, before)
    kept = scanned.drop("_suspect").schema
    suspects = spark.read.schema(scanned.schema).parquet(f"{path}/scanned").where("_suspect")
    settled = _cleaned(settle_suspects(suspects.select(*_ROW, F.xxhash64(*_KEY).alias("_hash"))))
    settled.write.mode("overwrite").option(*STAGED_CODEC).parquet(f"{path}/settled")
    clear = spark.read.schema(scanned.schema).parquet(f"{path}/scanned").where(~F.col("_suspect")).drop("_suspect")
    return clear.unionByName(spark.read.schema(kept).parquet(f"{path}/settled"))


def clean_sheets(sheets: dict[str, DataFrame]) -> DataFrame:
    """Clean in-session sheets; dictionary order is sheet order."""
    ledger = None
    for i, (name, frame) in enumerate(sheets.items()):
        frame = frame.select(
            "*",
            F.lit(name).alias("source_sheet"),
            sheet_position(
                i,
                F.shiftright(F.monotonically_increasing_id(), 33),
                F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1),
            ).alias("source_order"),
        )
        ledger = frame if ledger is None else ledger.unionByName(frame, allowMissingColumns=True)
    return clean_ledger(ledger)


def duplicate_counters(ledger: DataFrame) -> DataFrame:
    """Rows in within-sheet groups and rows dropped as cross-sheet repeats, before removal."""
    groups = duplicate_groups(normalise(ledger))
    return groups.agg(
        F.coalesce(F.sum(F.when(F.col("copies") > 1, F.col("copies"))), F.lit(0)).alias(
            "within_sheet_duplicates_detected"
        ),
        F.coalesce(
            F.sum(F.when(F.col("source_sheet") != F.col("first_sheet"), F.col("copies"))), F.lit(0)
        ).alias("cross_sheet_duplicates_removed"),
    )
