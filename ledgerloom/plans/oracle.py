"""Independent DuckDB texts for the staged tables, composed into one statement per query.

Nothing here is run by Spark.  Each named block is a common table expression; ``compose``
prepends the blocks a statement mentions, in dependency order.
"""

from __future__ import annotations

import re

from ..schema import DEFAULT_SOURCE_SYSTEM, FLAG_COLUMNS, NON_PRODUCT_CODES, PHYSICAL, PRODUCT_TYPES
from ..sources.adapter import ADAPTER_SQL, ADAPTER_TABLES, SHEETS, SOURCE_ORDER

AS_OF = "DATE '2001-08-02'"
SYSTEM = DEFAULT_SOURCE_SYSTEM

_KEY = "invoice, stock_code, description, quantity, invoice_date, price, customer_id, country"
_CODES = ", ".join(f"'{c}'" for c in NON_PRODUCT_CODES)
_TYPES = " ".join(f"WHEN '{code}' THEN '{kind}'" for code, kind in PRODUCT_TYPES.items())
FLAGS = ", ".join(FLAG_COLUMNS)
# sheets in reading order, 2^51 line numbers for each
LINE_ID = f"((list_position({SHEETS}, source_sheet) - 1)::BIGINT * 2251799813685248 + source_row_number)"

BLOCKS = {
    "led_raw": f"""
        SELECT *, row_number() OVER (ORDER BY source_sheet, {", ".join(SOURCE_ORDER)}) AS pos
        FROM ({ADAPTER_SQL.format(**{t: t for t in ADAPTER_TABLES})}) AS adapted
    """,
    "led_print": """
        SELECT sha256(concat_ws(':', count(*), sum(('0x' || substr(h, 1, 15))::HUGEINT), sum(('0x' || substr(h, 16, 15))::HUGEINT))) AS print,
            count(*) AS n
        FROM (
            SELECT sha256(to_json([invoice, stock_code, description, quantity::VARCHAR, strftime(invoice_date, '%Y-%m-%d %H:%M:%S.%f'),
                CASE WHEN price = floor(price) THEN price::BIGINT::VARCHAR ELSE price::VARCHAR END, customer_id::VARCHAR, country,
                source_sheet])::VARCHAR) AS h
            FROM led_raw
        )
    """,
    "led_norm": """
        SELECT trim(invoice) AS invoice, upper(trim(stock_code)) AS stock_code,
            trim(description) AS description, quantity, invoice_date, price, customer_id,
            trim(country) AS country, source_sheet, pos
        FROM led_raw
    """,
    "led_marked": f"""
        SELECT *,
            count(*) OVER (PARTITION BY {_KEY}, source_sheet) > 1 AS is_duplicate_within_sheet,
            min(source_sheet) OVER k <> max(source_sheet) OVER k AS is_duplicate_cross_sheet,
            source_sheet <> first_value(source_sheet) OVER (PARTITION BY {_KEY} ORDER BY pos) AS repeated
        FROM led_norm
        WINDOW k AS (PARTITION BY {_KEY})
    """,
    "led_clean": f"""
        SELECT *,
            NOT is_cancellation AND NOT is_bad_debt_adjustment AND quantity > 0
                AND has_valid_price AND NOT is_non_product AS is_valid_sale,
            quantity::DOUBLE * price AS amount
        FROM (
            SELECT *,
                left(upper(invoice), 1) = 'C' AS is_cancellation,
                left(upper(invoice), 1) = 'A' AS is_bad_debt_adjustment,
                quantity < 0 AS is_negative_quantity,
                left(upper(invoice), 1) = 'C' AS is_return,
                quantity < 0 AND left(upper(invoice), 1) <> 'C' AND price = 0
                    AND customer_id IS NULL AS is_inventory_adjustment,
                customer_id IS NOT NULL AS has_customer_id,
                description IS NOT NULL AS has_description,
                price > 0 AS has_valid_price,
                price = 0 AS is_price_zero,
                price < 0 AS is_price_negative,
                coalesce(stock_code IN ({_CODES}) OR left(stock_code, 10) = 'GIFT_0001_', FALSE)
                    AS is_non_product,
                FALSE AS is_unknown_special_code
            FROM led_marked
            WHERE NOT repeated
        ) AS flagged
    """,
    "core_rows": f"""
        SELECT *, (quantity * unit_price)::DECIMAL(14, 2) AS line_total
        FROM (
            SELECT invoice AS invoice_number, stock_code, customer_id, description, invoice_date,
                country, quantity, pos, source_sheet,
                row_number() OVER (PARTITION BY source_sheet ORDER BY pos) AS source_row_number,
                (round_even(price * 100, 0) / 100)::DECIMAL(12, 2) AS unit_price, {FLAGS}
            FROM led_clean
        ) AS priced
    """,
    "core_lines": f"""
        SELECT r.*, '{SYSTEM}' AS source_system,
            concat('{SYSTEM}:', source_sheet, ':', source_row_number) AS source_line_key,
            p.print AS source_file_sha256
        FROM core_rows AS r, led_print AS p
    """,
    "core_customers": f"""
        SELECT '{SYSTEM}' AS source_system, a.customer_id, m.country AS primary_country,
            a.first_date AS first_invoice_date, a.last_date AS last_invoice_date,
            a.orders AS total_orders_lifetime, a.spend AS total_merchandise_spend
        FROM (
            SELECT customer_id, min(invoice_date) AS first_date, max(invoice_date) AS last_date,
                count(DISTINCT invoice_number) FILTER (is_valid_sale) AS orders,
                coalesce(sum(line_total) FILTER (is_valid_sale OR (is_cancellation AND NOT is_non_product)), 0) AS spend
            FROM core_rows WHERE customer_id IS NOT NULL GROUP BY customer_id
        ) AS a
        JOIN (
            SELECT customer_id, country FROM core_rows WHERE customer_id IS NOT NULL
            GROUP BY customer_id, country
            QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, max(pos) DESC) = 1
        ) AS m USING (customer_id)
    """,
    "core_products": f"""
        SELECT '{SYSTEM}' AS source_system, a.stock_code, m.description AS primary_description,
            CASE a.stock_code {_TYPES} ELSE '{PHYSICAL}' END AS product_type,
            CASE a.stock_code {_TYPES} ELSE '{PHYSICAL}' END = '{PHYSICAL}' AS is_physical_merchandise,
            (round_even(a.middle * 100, 0) / 100)::DECIMAL(12, 2) AS median_unit_price,
            a.first_date AS first_seen_date, a.last_date AS last_seen_date
        FROM (
            SELECT stock_code, min(invoice_date) AS first_date, max(invoice_date) AS last_date,
                median(unit_price::DOUBLE) FILTER (has_valid_price) AS middle
            FROM core_rows GROUP BY stock_code
        ) AS a
        LEFT JOIN (
            SELECT stock_code, description FROM core_rows WHERE description IS NOT NULL
            GROUP BY stock_code, description
            QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY count(*) DESC, max(pos) DESC) = 1
        ) AS m USING (stock_code)
    """,
    "core_invoices": f"""
        SELECT '{SYSTEM}' AS source_system, invoice_number,
            arg_min(customer_id, pos) FILTER (customer_id IS NOT NULL) AS customer_id,
            min(invoice_date) AS invoice_date, arg_min(country, pos) AS country,
            CASE WHEN count_if(is_cancellation) > 0 THEN 'CANCELLATION'
                WHEN count_if(is_bad_debt_adjustment) > 0 THEN 'BAD_DEBT_ADJUSTMENT'
                WHEN count_if(is_inventory_adjustment) > 0 THEN 'INVENTORY_ADJUSTMENT'
                ELSE 'SALE' END AS invoice_type,
            count(*) AS total_line_count, sum(quantity)::BIGINT AS total_quantity,
            sum(line_total) AS total_invoice_amount
        FROM core_rows GROUP BY invoice_number
    """,
    "sales_lines": """
        SELECT r.*, h.country AS header_country, h.invoice_date::DATE AS calendar_day,
            p.is_physical_merchandise
        FROM core_rows AS r
        JOIN core_invoices AS h ON h.invoice_number = r.invoice_number
        JOIN core_products AS p ON p.stock_code = r.stock_code
        WHERE NOT r.is_inventory_adjustment
            AND (r.is_valid_sale OR (r.is_cancellation AND NOT r.is_non_product))
    """,
    "mart_daily": """
        SELECT calendar_day, header_country AS country, is_physical_merchandise,
            coalesce(sum(line_total) FILTER (is_valid_sale), 0) AS gross_sales,
            coalesce(sum(line_total) FILTER (is_cancellation), 0) AS return_value,
            sum(line_total) AS net_sales,
            count(DISTINCT invoice_number) FILTER (is_valid_sale) AS distinct_invoices,
            coalesce(sum(quantity) FILTER (is_valid_sale), 0)::BIGINT AS units_sold,
            coalesce(-sum(quantity) FILTER (is_cancellation), 0)::BIGINT AS units_returned
        FROM sales_lines GROUP BY ALL
    """,
    "mart_buyer_day": """
        SELECT customer_id, calendar_day,
            count(DISTINCT invoice_number) FILTER (is_valid_sale) AS order_frequency,
            coalesce(sum(line_total) FILTER (is_valid_sale), 0) AS gross_spend,
            coalesce(sum(line_total) FILTER (is_cancellation), 0) AS return_value,
            sum(line_total) AS net_spend,
            count_if(is_valid_sale)::BIGINT AS valid_transaction_count
        FROM sales_lines WHERE customer_id IS NOT NULL GROUP BY ALL
    """,
    "mart_snapshot": f"""
        SELECT c.customer_id, c.primary_country, {AS_OF} - a.last_day AS recency_days,
            coalesce(a.orders, 0) AS frequency, coalesce(a.net, 0) AS monetary,
            CASE WHEN a.orders > 0 THEN
                (2 * (a.gross * 100)::HUGEINT + a.orders) // (2 * a.orders)
            END::DOUBLE / 100 AS average_order_value,
            {AS_OF} - a.first_day AS tenure_days,
            a.first_day AS first_purchase_date, a.last_day AS last_purchase_date
        FROM core_customers AS c
        LEFT JOIN (
            SELECT customer_id,
                min(calendar_day) FILTER (is_valid_sale) AS first_day,
                max(calendar_day) FILTER (is_valid_sale) AS last_day,
                count(DISTINCT invoice_number) FILTER (is_valid_sale) AS orders,
                sum(line_total) FILTER (is_valid_sale) AS gross,
                sum(line_total) AS net
            FROM sales_lines WHERE customer_id IS NOT NULL GROUP BY customer_id
        ) AS a ON a.customer_id = c.customer_id
    """,
}


def compose(statement: str, extra: dict[str, str] | None = None) -> str:
    """The statement with every block it needs, directly or not, as a materialized CTE."""
    blocks = {**BLOCKS, **(extra or {})}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in blocks:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                if blocks[name] is not text:
                    visit(blocks[name])
                    ordered.append(name)

    visit(statement)
    if not ordered:
        return statement.strip()
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({blocks[name].strip()})" for name in ordered)
    return f"WITH {ctes}\n{statement.strip()}"
