"""The relational core: customers, products, invoices and invoice lines.

Every builder takes the cleaned ledger.  Dimensions are built in two aggregation
levels: the first groups on (entity, attribute) with fixed-width buffers, so Spark hash-combines
before the shuffle and a hot entity collapses inside each task; the second picks the attribute.
Headers need no count of attributes and are built in one level, combined by a sort in each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import money, round_half_even, sum_if
from ..functions.ranks import continuous_quantiles, group_ranks
from ..schema import CORE_SCHEMAS, FLAG_COLUMNS, PHYSICAL, PRODUCT_TYPES
from ..session import scratch_table
from ..sources.sheets import SHEET_SHIFT

# Source positions of one block of the index that numbers retained rows; at least 6 bits.
BLOCK_BITS = 15


def unit_price(price: Column) -> Column:
    """Float price rounded half-even at cents, stored as exact decimal."""
    return money(round_half_even(price, 2), 12)


def core_rows(clean: DataFrame) -> DataFrame:
    """Cleaned ledger under core names with decimal money."""
    price = unit_price(F.col("Price"))
    quantity = F.col("Quantity").cast("int")
    return clean.select(
        F.col("Invoice").alias("invoice_number"),
        F.col("StockCode").alias("stock_code"),
        F.col("`Customer ID`").alias("customer_id"),
        F.col("Description").alias("description"),
        F.col("InvoiceDate").alias("invoice_date"),
        F.col("Country").alias("country"),
        quantity.alias("quantity"),
        price.alias("unit_price"),
        money(F.round(quantity.cast("decimal(10,0)") * price, 2), 14).alias("line_total"),
        "source_sheet",
        "source_order",
        *FLAG_COLUMNS,
    )


def position_index(rows: DataFrame) -> DataFrame:
    """Which source positions are taken: (source_sheet, _block, _before, _prefix, _words), one row per block of 2**BLOCK_BITS positions.

    ``_before`` counts the rows of all earlier blocks of the sheet. A block without a hole needs nothing else; one with holes has its
    positions as bits, 64 a word, and the running count of rows before each word. Only positions are read and shuffled for it.
    """
    order, word_of_block = F.col("source_order"), (1 << (BLOCK_BITS - 6)) - 1
    words = rows.groupBy("source_sheet", F.shiftright("source_order", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(source_order & 63 as int))")).alias("_bits"),
        F.max(order.bitwiseAND((1 << BLOCK_BITS) - 1)).alias("_last"),
    )
    # At most 2**(BLOCK_BITS - 6) words a block.
    blocks = words.groupBy("source_sheet", F.shiftright("_word", BLOCK_BITS - 6).alias("_block")).agg(
        F.sum(F.bit_count("_bits")).alias("_size"),
        F.max("_last").alias("_last"),
        F.map_from_entries(F.collect_list(F.struct(F.col("_word").bitwiseAND(word_of_block).cast("int"), "_bits"))).alias("_held"),
    )
    # Rows before a block: those of earlier groups of blocks, and of earlier blocks of its group.
    group = F.shiftright("_block", BLOCK_BITS)
    groups = blocks.groupBy("source_sheet", group.alias("_group")).agg(F.sum("_size").alias("_group_size"))
    sheet = Window.partitionBy("source_sheet").orderBy("_group")
    groups = groups.withColumn("_earlier", F.sum("_group_size").over(sheet) - F.col("_group_size")).drop("_group_size")
    inside = Window.partitionBy("source_sheet", "_group").orderBy("_block")
    blocks = blocks.withColumn("_group", group).withColumn("_inside", F.sum("_size").over(inside) - F.col("_size"))
    blocks = blocks.join(groups, ["source_sheet", "_group"])
    dense = F.transform(F.sequence(F.lit(0), F.lit(word_of_block)), lambda w: F.coalesce(F.element_at("_held", w), F.lit(0).cast("bigint")))
    holes = F.col("_last") + 1 > F.col("_size")
    blocks = blocks.withColumn("_words", F.when(holes, dense))
    prefix = F.transform(
        "_words", lambda _, w: F.aggregate(F.slice("_words", 1, w), F.lit(0), lambda total, bits: total + F.bit_count(bits))
    )
    return blocks.select("source_sheet", "_block", (F.col("_earlier") + F.col("_inside")).alias("_before"), prefix.alias("_prefix"), "_words")


def number_rows(rows: DataFrame) -> DataFrame:
    """1-based ordinal of each retained row within its sheet, as ``source_row_number``.

    Rows stay where they are: a number is the row's place in its block, less the holes before it, plus the rows of earlier blocks. The
    index is written first, so that Spark sees its size and sends it to the rows while it is small.
    """
    index = scratch_table(position_index(rows), "positions")
    place = F.col("source_order").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int")
    word = F.shiftright(place, 6)
    lower = F.get("_words", word).bitwiseAND(F.expr("~shiftleft(-1L, cast(source_order & 63 as int))"))
    rank = F.when(F.col("_words").isNull(), place).otherwise(F.get("_prefix", word) + F.bit_count(lower))
    located = rows.withColumn("_block", F.shiftright("source_order", BLOCK_BITS)).join(index, ["source_sheet", "_block"])
    return located.withColumn("source_row_number", F.col("_before") + rank + 1).drop("_block", "_before", "_prefix", "_words")


def attribute_mode(stats: DataFrame, value: str) -> Column:
    """Most frequent non-null value, the one seen last winning a tie.

    ``stats`` holds one row per (entity, value) with ``n`` and ``last_order``.
    """
    return F.max_by(value, F.when(stats[value].isNotNull(), F.struct("n", "last_order")))


def _finish(df: DataFrame, table: str, source_system: str, fingerprint: str) -> DataFrame:
    df = df.withColumns(
        {"source_system": F.lit(source_system), "source_file_sha256": F.lit(fingerprint)}
    )
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CORE_SCHEMAS[table]])


def build_customers(clean: DataFrame, source_system: str, fingerprint: str) -> DataFrame:
    rows = core_rows(clean).where(F.col("customer_id").isNotNull())
    sale = F.col("is_valid_sale")
    merchandise_return = F.col("is_cancellation") & ~F.col("is_non_product")
    by_country = rows.groupBy("customer_id", "country").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("source_order").alias("last_order"),
        F.min("invoice_date").alias("first_date"),
        F.max("invoice_date").alias("last_date"),
        sum_if(F.col("line_total"), sale | merchandise_return).alias("spend"),
    )
    profile = by_country.groupBy("customer_id").agg(
        F.coalesce(attribute_mode(by_country, "country"), F.lit("")).alias("primary_country"),
        F.min("first_date").alias("first_invoice_date"),
        F.max("last_date").alias("last_invoice_date"),
        F.sum("spend").alias("total_merchandise_spend"),
    )
    orders = rows.where(sale).groupBy("customer_id").agg(
        F.countDistinct("invoice_number").alias("orders")
    )
    customers = profile.join(orders, "customer_id", "left").withColumn(
        "total_orders_lifetime", F.coalesce("orders", F.lit(0))
    )
    return _finish(customers, "customers", source_system, fingerprint)


def product_type(code: Column) -> Column:
    kind = F.when(F.lit(False), F.lit(None).cast("string"))
    for known, label in PRODUCT_TYPES.items():
        kind = kind.when(code == known, F.lit(label))
    return kind.otherwise(F.lit(PHYSICAL))


def build_products(clean: DataFrame, source_system: str, fingerprint: str) -> DataFrame:
    rows = core_rows(clean)
    by_text = rows.groupBy("stock_code", "description").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("source_order").alias("last_order"),
        F.min("invoice_date").alias("first_date"),
        F.max("invoice_date").alias("last_date"),
    )
    profile = by_text.groupBy("stock_code").agg(
        F.nullif(attribute_mode(by_text, "description"), F.lit("")).alias("primary_description"),
        F.min("first_date").alias("first_seen_date"),
        F.max("last_date").alias("last_seen_date"),
    )
    # Distinct cent prices per code, counted before the shuffle.
    prices = group_ranks(rows.where("has_valid_price"), "unit_price", ["stock_code"])
    median = continuous_quantiles(prices, "unit_price", {"median": 0.5}, ["stock_code"])
    kind = product_type(F.col("stock_code"))
    products = profile.join(median, "stock_code", "left").select(
        "*",
        kind.alias("product_type"),
        (kind == PHYSICAL).alias("is_physical_merchandise"),
        unit_price(F.col("median")).alias("median_unit_price"),
    )
    return _finish(products, "products", source_system, fingerprint)


def invoice_kind(cancelled: Column, bad_debt: Column, inventory: Column) -> Column:
    return (
        F.when(cancelled, "CANCELLATION")
        .when(bad_debt, "BAD_DEBT_ADJUSTMENT")
        .when(inventory, "INVENTORY_ADJUSTMENT")
        .otherwise("SALE")
    )


def build_invoices(clean: DataFrame, source_system: str, fingerprint: str) -> DataFrame:
    """One row per invoice, in one shuffle: an invoice's lines lie together, and each task sorts and combines its own first."""
    named = F.when(F.col("customer_id").isNotNull(), F.col("source_order"))
    invoices = core_rows(clean).groupBy("invoice_number").agg(
        F.min_by("customer_id", named).alias("customer_id"),
        F.min_by("country", "source_order").alias("country"),
        F.min("invoice_date").alias("invoice_date"),
        invoice_kind(
            F.bool_or("is_cancellation"), F.bool_or("is_bad_debt_adjustment"), F.bool_or("is_inventory_adjustment")
        ).alias("invoice_type"),
        F.count(F.lit(1)).alias("total_line_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("line_total").alias("total_invoice_amount"),
    )
    return _finish(invoices, "invoices", source_system, fingerprint)


def build_lines(clean: DataFrame, source_system: str, fingerprint: str) -> DataFrame:
    numbered = number_rows(core_rows(clean))
    key = F.concat_ws(":", F.lit(source_system), "source_sheet", F.col("source_row_number").cast("string"))
    # sheet ordinal above, line number below: unique for any number of lines
    line_id = F.shiftleft(F.shiftright("source_order", SHEET_SHIFT), SHEET_SHIFT) + F.col("source_row_number")
    lines = numbered.withColumn("source_line_key", key).withColumn("line_id", line_id)
    return _finish(lines, "invoice_lines", source_system, fingerprint)


def build_core(clean: DataFrame, source_system: str, fingerprint: str) -> dict[str, DataFrame]:
    return {
        "customers": build_customers(clean, source_system, fingerprint),
        "products": build_products(clean, source_system, fingerprint),
        "invoices": build_invoices(clean, source_system, fingerprint),
        "invoice_lines": build_lines(clean, source_system, fingerprint),
    }
