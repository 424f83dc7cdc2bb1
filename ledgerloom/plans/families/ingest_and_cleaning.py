"""I and C operators: ingest, pipeline and cleaning."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ...operators import cleaning as c
from ...operators import validation as v
from ...schema import LEDGER_COLUMNS
from ...sources import adapter, fingerprint, manifest, sheets, store
from ..oracle import FLAGS
from ..pipeline import run_clean
from ..registry import query
from .audit_queries import RAW, LEDGER_SELECT

query(
    "i01_read_sheets",
    lambda w: w.raw().drop("source_order"),
    f"SELECT {LEDGER_SELECT} FROM raw_ledger",
    RAW,
)


def _text_sheets(w):
    """The raw ledger written once as CSV files in source order, one folder per sheet."""
    paths = {name: f"{w.root}/text_sheets/{name}" for name in adapter.SHEETS}
    if "text_sheets" not in w._frames:
        for name, path in paths.items():
            rows = w.raw().where(F.col("source_sheet") == name)
            files = max(4, -(-rows.count() // sheets.ROWS_PER_TASK))
            rows = rows.repartitionByRange(files, "source_order").sortWithinPartitions("source_order").select(*[F.col(f"`{c}`") for c in LEDGER_COLUMNS])
            rows.write.mode("overwrite").options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
        w._frames["text_sheets"] = w.spark.read.text(list(paths.values()))
    return paths


query(
    "i01_text_sheets",
    lambda w: sheets.refuse_broken_records(sheets.read_text_sheets(w.spark, _text_sheets(w))).drop(*sheets.TEXT_POSITION).withColumns(
        {"Quantity": F.col("Quantity").cast("bigint"), "InvoiceDate": F.date_format(F.col("InvoiceDate").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss"),
         "Price": F.col("Price").cast("double"), "Customer ID": F.col("`Customer ID`").cast("bigint")}
    ),
    f"SELECT {LEDGER_SELECT} FROM raw_ledger",
    RAW,
)


def _text_positions(w):
    """The ordinal of each file's first and last row, and the sums of ordinals times quantity: they pin every row's place."""
    read = sheets.read_text_sheets(w.spark, _text_sheets(w))
    files = read.groupBy("_sheet", "_path").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("_sheet").orderBy("_path")
    starts = files.select("_sheet", "_path", (F.sum("n").over(order) - F.col("n")).alias("start"))
    placed = read.join(starts, ["_sheet", "_path"]).withColumn("place", F.col("start") + F.col("_ordinal") + 1)
    return placed.groupBy("source_sheet").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("place").alias("places"), F.max("place").alias("last_place"),
        F.sum(F.col("place") * F.col("Quantity").cast("bigint")).alias("weighted_quantity"),
        F.min_by("Invoice", "place").alias("first_invoice"), F.max_by("Invoice", "place").alias("last_invoice"),
    )


query(
    "i01_text_positions",
    _text_positions,
    """SELECT source_sheet, count(*) AS row_count, count(*) AS places, count(*) AS last_place, sum(place * quantity)::BIGINT AS weighted_quantity,
        arg_min(invoice, pos) AS first_invoice, arg_max(invoice, pos) AS last_invoice
    FROM (SELECT *, row_number() OVER (PARTITION BY source_sheet ORDER BY pos) AS place FROM led_raw) GROUP BY source_sheet""",
)
query(
    "i02_default_sheet",
    lambda w: sheets.require_ledger_columns(w.raw().drop("source_sheet"))
    .groupBy("source_sheet")
    .agg(F.count(F.lit(1)).alias("row_count")),
    "SELECT 'unknown' AS source_sheet, count(*) AS row_count FROM led_raw",
)


def _snapshot(w):
    path = f"{w.root}/snapshot_again"
    sheets.write_raw_snapshot(w.raw(), path, ["source_order"])
    again = sheets.read_sheets(w.spark, sheets.snapshot_sheets(path, adapter.SHEETS), snapshot=True)
    # The position within the file must come back as it was written.
    first = again.groupBy("source_sheet").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("Quantity").alias("quantity"),
        F.min_by("Invoice", "source_order").alias("first_invoice"),
        F.max_by("Invoice", "source_order").alias("last_invoice"),
    )
    return first


query(
    "i03_raw_snapshot",
    _snapshot,
    """SELECT source_sheet, count(*) AS row_count, sum(quantity)::BIGINT AS quantity,
        arg_min(invoice, pos) AS first_invoice, arg_max(invoice, pos) AS last_invoice FROM led_raw GROUP BY source_sheet""",
)
query(
    "i04_source_manifest",
    lambda w: manifest.source_manifest(w.raw()),
    f"""SELECT coalesce(source_sheet, 'all') AS source_sheet, count(*) AS row_count,
        strftime(min(invoice_date), '%Y-%m-%d %H:%M:%S') AS date_min, strftime(max(invoice_date), '%Y-%m-%d %H:%M:%S') AS date_max,
        (SELECT print FROM led_print) AS sha256, '{",".join(LEDGER_COLUMNS)}' AS columns
    FROM led_raw GROUP BY ROLLUP (source_sheet)""",
)
query(
    "i05_content_checksum",
    lambda w: fingerprint.ledger_fingerprint(w.raw()),
    "SELECT n AS rows, print AS sha256 FROM led_print",
)



def _changed_cell(w):
    """One cell of one row, a digit deep in its price: the roots differ, and one leaf below them on each side."""
    raw = w.raw().drop("source_order")
    one = raw.agg(F.max("Price")).scalar()
    other = raw.withColumn("Price", F.when(F.col("Price") == one, F.col("Price") + 0.0000001).otherwise(F.col("Price")))
    left, right = fingerprint.ledger_tree(raw), fingerprint.ledger_tree(other)
    roots = fingerprint.digest_root(left).select(F.col("sha256").alias("l")).join(fingerprint.digest_root(right).select(F.col("sha256").alias("r")), F.col("l") != F.col("r"), "left")
    leaves = fingerprint.differing_leaves(left, right, ["source_sheet", "bucket"]).groupBy("source_sheet").count()
    return leaves.groupBy().agg((F.max("count") <= 2 * raw.where(F.col("Price") == one).count()).alias("few_leaves_differ")).withColumn(
        "roots_differ", roots.select(F.col("r").isNotNull()).scalar()
    )


query("i05_one_changed_cell", _changed_cell, "SELECT TRUE AS few_leaves_differ, TRUE AS roots_differ")

_SUMMARY = """(SELECT count(*) FROM led_raw) AS raw_rows, count(*) AS rows_retained,
    (SELECT count(*) FROM led_marked WHERE repeated) AS cross_sheet_duplicates_removed,
    (SELECT count(*) FROM led_marked WHERE repeated) AS removed_as_cross_sheet_exact_duplicate,
    (SELECT count(*) FROM led_raw) - count(*) AS rows_removed,
    (SELECT count(*) FROM led_marked WHERE is_duplicate_within_sheet) AS duplicate_within_sheet_detected,
    count(*) FILTER (NOT is_valid_sale) AS rows_retained_flagged, count(*) FILTER (is_cancellation) AS cancellations,
    count(*) FILTER (is_return) AS returns, count(*) FILTER (is_inventory_adjustment) AS inventory_adjustments,
    count(*) FILTER (is_bad_debt_adjustment) AS bad_debt_adjustments, count(*) FILTER (NOT has_customer_id) AS missing_customer_id,
    count(*) FILTER (NOT has_description) AS missing_description, count(*) FILTER (is_price_zero) AS price_zero,
    count(*) FILTER (is_price_negative) AS price_negative,
    count(*) FILTER (is_duplicate_cross_sheet) AS duplicate_cross_sheet_flagged"""


def _pipeline(w):
    w.raw()
    paths = sheets.snapshot_sheets(f"{w.root}/raw", adapter.SHEETS)
    return run_clean(w.spark, paths, f"{w.root}/pipeline").summary


query("i06_clean_pipeline", _pipeline, f"SELECT {_SUMMARY} FROM led_clean")


def _text_pipeline(w):
    """The job on text, run twice: the second run finds the snapshot unchanged."""
    for _ in range(2):
        run = run_clean(w.spark, _text_sheets(w), f"{w.root}/text_pipeline", text=True)
    return run.summary.withColumn("reused_snapshot", F.lit(run.reused_snapshot))


query("i06_text_pipeline", _text_pipeline, f"SELECT {_SUMMARY}, TRUE AS reused_snapshot FROM led_clean")
query("i07_cleaning_summary", lambda w: v.cleaning_summary(w.raw(), w.clean()), f"SELECT {_SUMMARY} FROM led_clean")

_EDGES = """strftime(min(invoice_date), '%Y-%m-%d %H:%M:%S') AS date_min, strftime(max(invoice_date), '%Y-%m-%d %H:%M:%S') AS date_max"""


def _validated(w):
    counts = v.cleaning_summary(w.raw(), w.clean()).first()
    return v.validation_report(
        w.clean(), raw_rows=counts["raw_rows"], removed_rows=counts["cross_sheet_duplicates_removed"], require_flags=True
    )


query(
    "i08_validate_ledger",
    _validated,
    f"""SELECT TRUE AS is_valid, '' AS errors, count(*) AS row_count, (SELECT count(*) FROM led_raw) AS raw_rows,
        (SELECT count(*) FROM led_marked WHERE repeated) AS cross_sheet_duplicates_removed, {_EDGES} FROM led_clean""",
)
# Text with damaged cells: the validator must count exactly the cells that cannot be read.
_DAMAGE = {
    "Quantity": "quantity % 17 = 0",
    "Price": "quantity % 19 = 0",
    "InvoiceDate": "quantity % 23 = 0",
}


def _text_ledger(w):
    raw = w.raw()
    texts = {}
    for name, rule in _DAMAGE.items():
        text = F.col(name).cast("string")
        texts[name] = F.when(F.expr(rule.replace("quantity", "Quantity")), F.concat(F.lit("?"), text)).otherwise(text)
    return raw.withColumns({**texts, "Customer ID": F.col("`Customer ID`").cast("double").cast("string")})


query(
    "i09_validation_summary",
    lambda w: v.validation_summary(_text_ledger(w)),
    f"""SELECT FALSE AS is_valid, concat('invalid_datetime:', count(*) FILTER ({_DAMAGE['InvoiceDate']}),
            '; non_numeric_quantity:', count(*) FILTER ({_DAMAGE['Quantity']}),
            '; non_numeric_price:', count(*) FILTER ({_DAMAGE['Price']})) AS errors,
        count(*) AS row_count, NULL::BIGINT AS raw_rows, NULL::BIGINT AS cross_sheet_duplicates_removed,
        strftime(min(invoice_date) FILTER (NOT ({_DAMAGE['InvoiceDate']})), '%Y-%m-%d %H:%M:%S') AS date_min,
        strftime(max(invoice_date) FILTER (NOT ({_DAMAGE['InvoiceDate']})), '%Y-%m-%d %H:%M:%S') AS date_max FROM led_raw""",
)


def _published(w):
    """Publish twice under one namespace; readers must see one copy of every table."""
    target = store.CoreStore(w.spark, f"{w.root}/published")
    for _ in range(2):
        target.publish(w.core(), w.source_system)
    counts = [
        frame.groupBy("source_system").agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
        for name, frame in target.core().items()
    ]
    out = counts[0]
    for frame in counts[1:]:
        out = out.unionByName(frame)
    return out


query(
    "i10_publish_core",
    _published,
    """SELECT 'LEDGER' AS source_system, 'customers' AS table_name, count(*) AS row_count FROM core_customers
    UNION ALL SELECT 'LEDGER', 'products', count(*) FROM core_products
    UNION ALL SELECT 'LEDGER', 'invoices', count(*) FROM core_invoices
    UNION ALL SELECT 'LEDGER', 'invoice_lines', count(*) FROM core_rows""",
)

# --- cleaning ---------------------------------------------------------------------------------

query(
    "c01_normalise_text",
    lambda w: c.normalise(w.raw()).groupBy("Invoice", "StockCode", "Description", "Country").agg(
        F.count(F.lit(1)).alias("row_count")
    ),
    """SELECT invoice AS "Invoice", stock_code AS "StockCode", description AS "Description", country AS "Country",
        count(*) AS row_count FROM led_norm GROUP BY ALL""",
)
query(
    "c02_coerce_types",
    lambda w: c.normalise(_text_ledger(w)).select("Invoice", "Quantity", "Price", "InvoiceDate", F.col("`Customer ID`")),
    f"""SELECT invoice AS "Invoice", CASE WHEN {_DAMAGE['Quantity']} THEN NULL ELSE quantity::DOUBLE END AS "Quantity",
        CASE WHEN {_DAMAGE['Price']} THEN NULL ELSE price END AS "Price",
        CASE WHEN {_DAMAGE['InvoiceDate']} THEN NULL ELSE strftime(invoice_date, '%Y-%m-%d %H:%M:%S') END AS "InvoiceDate",
        customer_id AS "Customer ID" FROM led_norm""",
)


def _flagged(w):
    return c.flag_duplicates(c.normalise(w.raw()))


for _name, _flag in (
    ("c03_duplicates_within_sheet", "is_duplicate_within_sheet"),
    ("c04_duplicates_cross_sheet", "is_duplicate_cross_sheet"),
):
    query(
        _name,
        lambda w, flag=_flag: _flagged(w).groupBy("Invoice", "StockCode", "source_sheet", flag).agg(
            F.count(F.lit(1)).alias("row_count")
        ),
        f"""SELECT invoice AS "Invoice", stock_code AS "StockCode", source_sheet, {_flag}, count(*) AS row_count
        FROM led_marked GROUP BY ALL""",
    )
query(
    "c05_cross_sheet_dedupe",
    lambda w: c.duplicate_counters(w.raw()),
    """SELECT count(*) FILTER (is_duplicate_within_sheet) AS within_sheet_duplicates_detected,
        count(*) FILTER (repeated) AS cross_sheet_duplicates_removed FROM led_marked""",
)
query(
    "c05_retained_rows",
    lambda w: c.drop_cross_sheet_repeats(_flagged(w)).groupBy("Invoice", "StockCode", "source_sheet").agg(
        F.count(F.lit(1)).alias("row_count")
    ),
    """SELECT invoice AS "Invoice", stock_code AS "StockCode", source_sheet, count(*) AS row_count
    FROM led_marked WHERE NOT repeated GROUP BY ALL""",
)


def _flag_query(name, *flags):
    listed = ", ".join(flags)
    query(
        name,
        lambda w: c.business_flags(c.drop_cross_sheet_repeats(_flagged(w)))
        .groupBy("Invoice", *flags)
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("Quantity").alias("quantity")),
        f"""SELECT invoice AS "Invoice", {listed}, count(*) AS row_count, sum(quantity)::BIGINT AS quantity
        FROM led_clean GROUP BY ALL""",
    )


_flag_query("c06_cancellation_and_return", "is_cancellation", "is_return")
_flag_query("c07_bad_debt_adjustment", "is_bad_debt_adjustment")
_flag_query("c08_negative_quantity", "is_negative_quantity")
_flag_query("c09_inventory_adjustment", "is_inventory_adjustment")
_flag_query(
    "c10_presence_and_price",
    "has_customer_id", "has_description", "has_valid_price", "is_price_zero", "is_price_negative",
)
_flag_query("c11_non_product", "is_non_product")
_flag_query("c12_unknown_special_code", "is_unknown_special_code")
_flag_query("c13_valid_sale", "is_valid_sale")
query(
    "c14_ledger_amount",
    lambda w: c.business_flags(c.normalise(w.raw())).select("Quantity", "Price", "line_total"),
    'SELECT quantity AS "Quantity", price AS "Price", quantity::DOUBLE * price AS line_total FROM led_norm',
)
query(
    "c15_clean_ledger",
    lambda w: c.clean_ledger(w.raw()).drop("source_order"),
    f"""SELECT invoice AS "Invoice", stock_code AS "StockCode", description AS "Description", quantity AS "Quantity",
        strftime(invoice_date, '%Y-%m-%d %H:%M:%S') AS "InvoiceDate", price AS "Price", customer_id AS "Customer ID",
        country AS "Country", source_sheet, {FLAGS}, amount AS line_total FROM led_clean""",
)
