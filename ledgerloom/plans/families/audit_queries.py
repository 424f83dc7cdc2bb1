"""A operators: profiling of the raw ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import audit as a
from ...sources import adapter, sheets
from ...schema import LEDGER_COLUMNS
from ..registry import query

# The raw ledger under its source column names.
RAW = {
    "raw_ledger": """
        SELECT invoice AS "Invoice", stock_code AS "StockCode", description AS "Description", quantity AS "Quantity",
            invoice_date AS "InvoiceDate", price AS "Price", customer_id AS "Customer ID", country AS "Country",
            source_sheet, pos
        FROM led_raw
    """,
    "raw_copies": """
        SELECT "Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country",
            source_sheet, count(*) AS n, min(pos) AS first_pos FROM raw_ledger GROUP BY ALL
    """,
    "raw_groups": """
        SELECT "Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country",
            sum(n)::BIGINT AS n, count(*) AS sheets, sum(n - 1)::BIGINT AS inside FROM raw_copies
        GROUP BY "Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"
    """,
    "raw_days": """
        SELECT "InvoiceDate"::DATE AS day, count(*) AS n, min("InvoiceDate") AS first_date, max("InvoiceDate") AS last_date
        FROM raw_ledger GROUP BY 1
    """,
}


def _pct(part, whole, digits=3):
    scale = 10**digits
    return f"round_even(({part})::DOUBLE / ({whole})::DOUBLE * 100 * {scale}, 0) / {scale}"


def _sheet_frames(w):
    w.raw()
    paths = sheets.snapshot_sheets(f"{w.root}/raw", adapter.SHEETS)
    return {name: w.spark.read.parquet(path) for name, path in paths.items()}


query(
    "a01_sheet_overview",
    lambda w: a.sheet_overview(_sheet_frames(w)),
    """SELECT source_sheet AS sheet, count(*) AS row_count, 8::BIGINT AS column_count, TRUE AS schemas_compatible
    FROM raw_ledger GROUP BY source_sheet""",
    RAW,
)

ROLES = {
    "invoice": ["invoiceno", "invoice"],
    "stock_code": ["stock code", "stockcode"],
    "description": ["description"],
    "quantity": ["quantity"],
    "invoice_date": ["invoice date", "date"],
    "price": ["unit price", "price"],
    "customer_id": ["customerid", "customer"],
    "country": ["country"],
}


def _resolved(w):
    named = a.resolve_columns(w.raw(), ROLES)
    counted = named.agg(*[F.count(F.col(role)).alias(role) for role in ROLES])
    return counted.unpivot([], list(ROLES), "role", "non_null_values")


query(
    "a02_resolve_columns",
    _resolved,
    "\nUNION ALL ".join(
        f"""SELECT '{role}' AS role, count("{column}") AS non_null_values FROM raw_ledger"""
        for role, column in zip(ROLES, LEDGER_COLUMNS)
    ),
    RAW,
)

_TYPES = {
    "Quantity": "bigint", "InvoiceDate": "timestamp_ntz", "Price": "double", "Customer ID": "bigint",
}


def _profile_sql(column):
    return f"""SELECT '{column}' AS column_name, '{_TYPES.get(column, 'string')}' AS data_type,
        (SELECT count(DISTINCT "{column}") FROM raw_ledger) AS unique_count,
        (SELECT string_agg(v, ' | ' ORDER BY p) FROM (SELECT "{column}"::VARCHAR AS v, min(pos) AS p FROM raw_ledger
            WHERE "{column}" IS NOT NULL GROUP BY 1 ORDER BY p, v LIMIT 5) AS firsts) AS example_values"""


query(
    "a03_column_profile",
    lambda w: a.column_profile(w.raw()),
    "\nUNION ALL ".join(_profile_sql(c) for c in [*LEDGER_COLUMNS, "source_sheet"]),
    RAW,
)
query(
    "a04_mixed_types",
    lambda w: a.mixed_types(w.raw()),
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count_if(regexp_full_match("{c}", '[0-9]+'))::BIGINT AS integer_values,
        (count("{c}") - coalesce(count_if(regexp_full_match("{c}", '[0-9]+')), 0))::BIGINT AS text_values FROM raw_ledger"""
        for c in ("Invoice", "StockCode", "Description", "Country", "source_sheet")
    ),
    RAW,
)
query(
    "a05_customer_id_integrity",
    lambda w: a.customer_id_integrity(w.raw()),
    """SELECT count("Customer ID") AS non_null_values,
        count_if("Customer ID" <> floor("Customer ID"))::BIGINT AS non_integer_values FROM raw_ledger""",
    RAW,
)
query(
    "a06_missing_table",
    lambda w: a.missing_table(w.raw()),
    "\nUNION ALL ".join(
        f"""SELECT coalesce(source_sheet, 'all') AS source_sheet, '{c}' AS column_name,
        count(*) - count("{c}") AS missing_count, {_pct(f'count(*) - count("{c}")', 'count(*)')} AS missing_percent
        FROM raw_ledger GROUP BY ROLLUP (source_sheet)"""
        for c in LEDGER_COLUMNS
    ),
    RAW,
)
query(
    "a07_missing_together",
    lambda w: a.missing_together(w.raw()),
    """SELECT "Description" IS NULL AS description_missing, "Customer ID" IS NULL AS customer_missing, count(*) AS row_count
    FROM raw_ledger GROUP BY 1, 2""",
    RAW,
)


def _rounded(df, *names):
    """Float means and deviations depend on summation order in their last digits."""
    return df.withColumns({n: F.round(n, 4) for n in names})


def _summary_sql(column, where, levels):
    quantiles = ", ".join(
        f'quantile_cont("{column}"::DOUBLE, {level}) AS {name}' for name, level in levels.items()
    )
    return f"""SELECT count("{column}") AS value_count, round(avg("{column}"::DOUBLE), 4) AS mean,
        round(stddev_samp("{column}"::DOUBLE), 4) AS std, min("{column}")::DOUBLE AS min, max("{column}")::DOUBLE AS max,
        {quantiles} FROM raw_ledger WHERE {where}"""


_QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
query(
    "a07_undescribed_prices",
    lambda w: _rounded(a.undescribed_prices(w.raw()), "mean", "std"),
    _summary_sql("Price", '"Description" IS NULL', _QUARTILES),
    RAW,
)
query(
    "a08_duplicate_summary",
    lambda w: a.duplicate_summary(w.raw()),
    f"""SELECT coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS rows_in_duplicate_groups,
        sum(n - 1)::BIGINT AS duplicate_count, {_pct('sum(n - 1)', 'sum(n)')} AS duplicate_percent FROM raw_groups""",
    RAW,
)
query(
    "a09_duplicate_scopes",
    lambda w: a.duplicate_scopes(w.raw()),
    f"""SELECT 'within ' || source_sheet AS scope, sum(n - 1)::BIGINT AS duplicate_count,
        {_pct('sum(n - 1)', 'sum(n)')} AS duplicate_percent FROM raw_copies GROUP BY source_sheet
    UNION ALL SELECT 'cross-sheet only', sum(n - 1 - inside)::BIGINT, NULL FROM raw_groups""",
    RAW,
)
LEDGER_SELECT = """"Invoice", "StockCode", "Description", "Quantity", strftime("InvoiceDate", '%Y-%m-%d %H:%M:%S') AS "InvoiceDate",
    "Price", "Customer ID", "Country", source_sheet"""
query(
    "a10_duplicate_samples",
    lambda w: a.duplicate_samples(w.raw()),
    f"""SELECT {LEDGER_SELECT} FROM (
        SELECT r.*, count(*) OVER (PARTITION BY "Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price",
            "Customer ID", "Country") AS n FROM raw_ledger AS r) AS c
    WHERE n > 1 ORDER BY c."Invoice", c."StockCode", c."InvoiceDate", pos LIMIT 12""",
    RAW,
)
query(
    "a11_describe_numbers",
    lambda w: _rounded(a.describe_numbers(w.raw()), "mean", "std"),
    "\nUNION ALL ".join(
        _summary_sql(c, "TRUE", a.QUANTILE_GRID).replace("SELECT count", f"SELECT '{c}' AS column_name, count", 1)
        for c in ("Quantity", "Price")
    ),
    RAW,
)
_ISSUES = {
    "quantity <= 0": '"Quantity" <= 0',
    "quantity < 0": '"Quantity" < 0',
    "quantity = 0": '"Quantity" = 0',
    "|quantity| > p99.9": 'abs("Quantity") > (SELECT quantile_cont(abs("Quantity")::DOUBLE, 0.999) FROM raw_ledger)',
    "price <= 0": '"Price" <= 0',
    "price < 0": '"Price" < 0',
    "price = 0": '"Price" = 0',
    "price > p99.9": '"Price" > (SELECT quantile_cont("Price", 0.999) FROM raw_ledger)',
    "stock code missing": '"StockCode" IS NULL',
    "invoice missing": '"Invoice" IS NULL',
    "customer id missing": '"Customer ID" IS NULL',
    "description missing": '"Description" IS NULL',
    "description blank": """trim("Description") = ''""",
}
query(
    "a12_issue_table",
    lambda w: a.issue_table(w.raw()),
    "\nUNION ALL ".join(
        f"""SELECT '{name}' AS issue, count(*) FILTER ({rule}) AS row_count,
        {_pct(f'count(*) FILTER ({rule})', 'count(*)')} AS percent FROM raw_ledger"""
        for name, rule in _ISSUES.items()
    ),
    RAW,
)


def _extreme_sql(kind, order, where="TRUE"):
    return f"""SELECT * FROM (SELECT '{kind}' AS kind, "Invoice", "StockCode", "Quantity", "Price" FROM raw_ledger
        WHERE {where} ORDER BY {order} pos LIMIT 10) AS e"""


query(
    "a13_extremes",
    lambda w: a.extremes(w.raw()),
    "\nUNION ALL ".join(
        [
            _extreme_sql("largest quantity", 'abs("Quantity") DESC,'),
            _extreme_sql("largest price", '"Price" DESC,'),
            _extreme_sql("negative price", "", '"Price" < 0'),
        ]
    ),
    RAW,
)
_ODD = """trim("StockCode") AS code FROM raw_ledger WHERE NOT regexp_matches(trim("StockCode"), '^[0-9]{5}')"""
query(
    "a14_nonstandard_codes",
    lambda w: a.nonstandard_codes(w.raw()),
    f"""SELECT code, count(*) AS row_count, arg_min("Description", pos) FILTER ("Description" IS NOT NULL) AS sample_description
    FROM (SELECT "Description", pos, {_ODD}) AS odd GROUP BY code ORDER BY row_count DESC, code LIMIT 20""",
    RAW,
)
query(
    "a14_nonstandard_totals",
    lambda w: a.nonstandard_code_totals(w.raw()),
    f"SELECT count(*) AS row_count, count(DISTINCT code) AS unique_codes FROM (SELECT {_ODD}) AS odd",
    RAW,
)
_PREFIX = """CASE WHEN regexp_matches("Invoice", '^[A-Za-z]') THEN regexp_extract("Invoice", '^[A-Za-z]+') ELSE '<numeric>' END"""
query(
    "a15_invoice_prefixes",
    lambda w: a.prefix_profile(w.raw()),
    f"""SELECT {_PREFIX} AS prefix, count(*) AS row_count, count(DISTINCT "Invoice") AS unique_invoices
    FROM raw_ledger GROUP BY 1""",
    RAW,
)
_C = """left("Invoice", 1) = 'C'"""
query(
    "a16_cancellation_rates",
    lambda w: a.cancellation_rates(w.raw()),
    f"""SELECT count(DISTINCT "Invoice") FILTER ({_C}) AS cancellation_invoices, count(DISTINCT "Invoice") AS total_invoices,
        {_pct(f'count(DISTINCT "Invoice") FILTER ({_C})', 'count(DISTINCT "Invoice")')} AS cancellation_invoice_percent,
        count(*) FILTER ({_C}) AS cancellation_rows, {_pct(f'count(*) FILTER ({_C})', 'count(*)')} AS cancellation_row_percent
    FROM raw_ledger""",
    RAW,
)
query(
    "a17_cancellation_by_sign",
    lambda w: a.cancellation_by_sign(w.raw()),
    f"""SELECT coalesce(c, 'All') AS is_c_invoice, coalesce(s, 'All') AS quantity_sign, count(*) AS row_count
    FROM (SELECT CASE WHEN {_C} THEN 'true' ELSE 'false' END AS c,
        CASE sign("Quantity") WHEN -1 THEN 'negative' WHEN 0 THEN 'zero' ELSE 'positive' END AS s FROM raw_ledger) AS t
    GROUP BY CUBE (c, s)""",
    RAW,
)
query(
    "a18_negative_outside_cancellations",
    lambda w: _rounded(a.negative_outside_cancellations(w.raw()), "mean", "std"),
    _summary_sql("Price", f'"Quantity" < 0 AND NOT ({_C})', _QUARTILES).replace(
        "SELECT count", 'SELECT count(*) AS row_count, count(*) - count("Customer ID") AS missing_customers, count', 1
    ),
    RAW,
)
query(
    "a19_date_coverage",
    lambda w: a.date_coverage(w.raw()),
    """SELECT strftime(min("InvoiceDate"), '%Y-%m-%d %H:%M:%S') AS min_date, strftime(max("InvoiceDate"), '%Y-%m-%d %H:%M:%S') AS max_date,
        (max("InvoiceDate")::DATE - min("InvoiceDate")::DATE + 1)::BIGINT AS calendar_span_days,
        count(DISTINCT "InvoiceDate"::DATE) AS observed_days FROM raw_ledger""",
    RAW,
)
query(
    "a19_rows_per_year",
    lambda w: a.rows_per_year(w.raw()),
    """SELECT year("InvoiceDate") AS year, count(*) AS record_count FROM raw_ledger GROUP BY 1""",
    RAW,
)
query(
    "a20_monthly_coverage",
    lambda w: a.monthly_coverage(w.raw()),
    """SELECT strftime(s.month, '%Y-%m-%d') AS month, coalesce(m.n, 0)::BIGINT AS record_count,
        coalesce(m.active_days, 0) AS active_days, strftime(m.first_date, '%Y-%m-%d %H:%M:%S') AS first_date,
        strftime(m.last_date, '%Y-%m-%d %H:%M:%S') AS last_date, m.n IS NULL AS is_missing,
        s.month = min(s.month) OVER () AND coalesce(m.first_date::DATE > s.month, FALSE) AS starts_late,
        s.month = max(s.month) OVER () AND coalesce(m.last_date::DATE < last_day(s.month), FALSE) AS ends_early
    FROM (SELECT unnest(generate_series(date_trunc('month', min(day))::TIMESTAMP, date_trunc('month', max(day))::TIMESTAMP,
        INTERVAL 1 MONTH))::DATE AS month FROM raw_days) AS s
    LEFT JOIN (SELECT date_trunc('month', day)::DATE AS month, sum(n) AS n, count(*) AS active_days,
        min(first_date) AS first_date, max(last_date) AS last_date FROM raw_days GROUP BY 1) AS m ON m.month = s.month""",
    RAW,
)
query(
    "a21_sheet_overlaps",
    lambda w: a.sheet_overlaps(w.raw()),
    """SELECT p.source_sheet, strftime(p.min_date, '%Y-%m-%d %H:%M:%S') AS min_date, strftime(p.max_date, '%Y-%m-%d %H:%M:%S') AS max_date,
        p.row_count, p.previous_sheet, coalesce(p.min_date <= p.previous_max, FALSE) AS overlaps,
        CASE WHEN p.min_date <= p.previous_max THEN strftime(p.min_date, '%Y-%m-%d %H:%M:%S') END AS window_start,
        CASE WHEN p.min_date <= p.previous_max THEN strftime(p.previous_max, '%Y-%m-%d %H:%M:%S') END AS window_end,
        CASE WHEN p.min_date <= p.previous_max THEN (SELECT count(*) FROM raw_ledger AS r
            WHERE r.source_sheet = p.previous_sheet AND r."InvoiceDate" BETWEEN p.min_date AND p.previous_max) END AS previous_rows_in_window,
        CASE WHEN p.min_date <= p.previous_max THEN (SELECT count(*) FROM raw_ledger AS r
            WHERE r.source_sheet = p.source_sheet AND r."InvoiceDate" BETWEEN p.min_date AND p.previous_max) END AS current_rows_in_window
    FROM (SELECT *, lag(source_sheet) OVER (ORDER BY min_date) AS previous_sheet, lag(max_date) OVER (ORDER BY min_date) AS previous_max
        FROM (SELECT source_sheet, min("InvoiceDate") AS min_date, max("InvoiceDate") AS max_date, count(*) AS row_count
            FROM raw_ledger GROUP BY source_sheet) AS s) AS p""",
    RAW,
)
_DRAW = """md5(concat_ws(':', '42', concat_ws('|', coalesce("Invoice", '\\N'), coalesce("StockCode", '\\N'), coalesce("Description", '\\N'),
    "Quantity"::DECIMAL(38, 6)::VARCHAR, strftime("InvoiceDate", '%Y-%m-%d %H:%M:%S'), "Price"::DECIMAL(38, 6)::VARCHAR,
    coalesce("Customer ID"::DECIMAL(38, 6)::VARCHAR, '\\N'), "Country", source_sheet)))"""


def _sample_sql(n, where):
    return f"""SELECT {LEDGER_SELECT} FROM (SELECT *, {_DRAW} AS draw FROM raw_ledger WHERE {where}
        ORDER BY draw LIMIT {n}) AS s"""


query("a22_row_sample", lambda w: a.row_sample(w.raw(), 10), _sample_sql(10, "TRUE"), RAW)
query(
    "a22_cancellation_sample",
    lambda w: a.row_sample(w.raw(), 8, where=a.invoice_prefix() == "C"),
    _sample_sql(8, _C),
    RAW,
)
query(
    "a22_adjustment_sample",
    lambda w: a.row_sample(w.raw(), 8, where=(F.col("Quantity") < 0) & (a.invoice_prefix() != "C")),
    _sample_sql(8, f'"Quantity" < 0 AND NOT ({_C})'),
    RAW,
)
