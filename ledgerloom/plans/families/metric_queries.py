"""X operators: contract metrics and ledger classification."""

from __future__ import annotations

from datetime import date

from ...operators import metrics as m

from ..registry import day, query

START, END = date(1997, 1, 1), date(1999, 12, 31)
_SPAN = "invoice_date::DATE BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'"
_RETURNED = "is_cancellation AND NOT is_non_product"


def _lines(w):
    return w.table("invoice_lines")


query(
    "x01_gross_sales",
    lambda w: m.gross_sales(_lines(w)),
    "SELECT coalesce(sum(line_total) FILTER (is_valid_sale), 0)::DOUBLE AS gross_merchandise_sales FROM core_rows",
)
query(
    "x01_gross_sales_by_product",
    lambda w: m.gross_sales(_lines(w), START, END, ["stock_code"]),
    f"""SELECT stock_code, coalesce(sum(line_total) FILTER (is_valid_sale), 0)::DOUBLE AS gross_merchandise_sales
    FROM core_rows WHERE {_SPAN} GROUP BY stock_code""",
)
query(
    "x02_return_value",
    lambda w: m.return_value(_lines(w)),
    f"SELECT coalesce(sum(line_total) FILTER ({_RETURNED}), 0)::DOUBLE AS merchandise_return_value FROM core_rows",
)
query(
    "x03_net_revenue",
    lambda w: m.net_revenue(_lines(w)),
    f"""SELECT (sum(CASE WHEN is_valid_sale THEN line_total ELSE 0 END)
        + sum(CASE WHEN {_RETURNED} THEN line_total ELSE 0 END))::DOUBLE AS net_merchandise_revenue FROM core_rows""",
)
query(
    "x04_valid_orders",
    lambda w: m.valid_orders(_lines(w)),
    "SELECT count(DISTINCT invoice_number) AS valid_order_count FROM core_rows WHERE is_valid_sale",
)
query(
    "x05_average_order_value",
    lambda w: m.average_order_value(_lines(w)),
    """SELECT sum(line_total)::DOUBLE / count(DISTINCT invoice_number)::DOUBLE AS average_order_value
    FROM core_rows WHERE is_valid_sale""",
)
query(
    "x06_customer_population",
    lambda w: m.customer_population(w.table("customers")),
    "SELECT count(DISTINCT customer_id) AS total_customer_count FROM core_rows",
)
query(
    "x06_active_customers",
    lambda w: m.active_customers(_lines(w), START, END),
    f"SELECT count(DISTINCT customer_id) AS active_customers FROM core_rows WHERE is_valid_sale AND {_SPAN}",
)
query(
    "x07_repeat_purchase_rate",
    lambda w: m.repeat_purchase_rate(_lines(w)),
    """SELECT count(*) AS buyers, count_if(orders >= 2)::BIGINT AS repeat_buyers,
        count_if(orders >= 2)::DOUBLE / count(*) AS repeat_purchase_rate
    FROM (SELECT customer_id, count(DISTINCT invoice_number) AS orders FROM core_rows
        WHERE is_valid_sale AND customer_id IS NOT NULL GROUP BY customer_id) AS o""",
)
query(
    "x08_reconciliation_tree",
    lambda w: m.reconciliation_tree(_lines(w)),
    f"""SELECT side, category, count(*) AS line_count, sum(line_total)::DOUBLE AS amount FROM (
        SELECT *, CASE WHEN category IN ('bad_debt_write_off', 'inventory_shrinkage', 'merchandise_returns',
            'service_and_fee_reversals') THEN 'deductions' ELSE 'gross_lines' END AS side
        FROM (SELECT line_total, CASE
            WHEN is_bad_debt_adjustment THEN CASE WHEN line_total < 0 THEN 'bad_debt_write_off' ELSE 'bad_debt_credit' END
            WHEN is_inventory_adjustment THEN 'inventory_shrinkage'
            WHEN is_cancellation THEN CASE WHEN is_non_product THEN 'service_and_fee_reversals' ELSE 'merchandise_returns' END
            WHEN is_valid_sale THEN 'merchandise_sales'
            WHEN is_non_product THEN CASE WHEN stock_code LIKE 'GIFT%' OR stock_code LIKE 'TEST%' OR stock_code = 'CRUK'
                THEN 'vouchers_and_special_services' ELSE 'services_and_freight' END
            WHEN is_price_zero THEN 'zero_price_items'
            ELSE 'other' END AS category FROM core_rows) AS c
    ) AS s GROUP BY ROLLUP (side, category)""",
)
query(
    "x09_transaction_taxonomy",
    lambda w: m.transaction_taxonomy(_lines(w)),
    """SELECT transaction_class, count(*) AS line_count, sum(line_total)::DOUBLE AS amount FROM (
        SELECT line_total, CASE WHEN is_valid_sale THEN 'VALID_SALE' WHEN is_cancellation THEN 'CANCELLATION'
            WHEN is_bad_debt_adjustment THEN 'BAD_DEBT_ADJUSTMENT' WHEN quantity < 0 THEN 'NEGATIVE_QTY_NON_C'
            WHEN is_non_product THEN 'NON_PRODUCT_SERVICE' WHEN unit_price = 0 AND quantity > 0 THEN 'ZERO_PRICE_POSITIVE'
            ELSE 'OTHER' END AS transaction_class FROM core_rows) AS t GROUP BY transaction_class""",
)
query(
    "x10_extreme_lines",
    lambda w: m.flag_extremes(w.clean())
    .where("is_extreme_quantity OR is_extreme_price")
    .select("Invoice", "StockCode", "Quantity", "Price", "is_extreme_quantity", "is_extreme_price"),
    """SELECT * FROM (
        SELECT invoice AS "Invoice", stock_code AS "StockCode", quantity AS "Quantity", price AS "Price",
            abs(quantity) > (SELECT quantile_cont(abs(quantity)::DOUBLE, 0.999) FROM led_clean) AS is_extreme_quantity,
            price > (SELECT quantile_cont(price, 0.999) FROM led_clean) AS is_extreme_price
        FROM led_clean) AS e WHERE is_extreme_quantity OR is_extreme_price""",
)
query(
    "x11_demand_daily",
    lambda w: m.demand_target(_lines(w)),
    f"""SELECT stock_code, {day('bucket')}, sum(quantity)::BIGINT AS units
    FROM (SELECT stock_code, invoice_date::DATE AS bucket, quantity FROM core_rows WHERE is_valid_sale) AS d
    GROUP BY stock_code, d.bucket""",
)
query(
    "x11_demand_weekly",
    lambda w: m.demand_target(_lines(w), "Weekly"),
    f"""SELECT stock_code, {day('bucket')}, sum(quantity)::BIGINT AS units
    FROM (SELECT stock_code, invoice_date::DATE + ((8 - isodow(invoice_date)) % 7)::INTEGER AS bucket, quantity
        FROM core_rows WHERE is_valid_sale) AS d
    GROUP BY stock_code, d.bucket""",
)
query(
    "x12_date_dimension",
    lambda w: m.date_dimension(_lines(w)),
    """SELECT strftime(d, '%Y-%m-%d') AS calendar_day, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
        day(d) AS day_of_month, isodow(d) AS iso_weekday
    FROM (SELECT unnest(generate_series(min(invoice_date)::DATE::TIMESTAMP, max(invoice_date)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS d
        FROM core_rows) AS days""",
)
query(
    "x13_daily_returns_and_fees",
    lambda w: m.daily_returns_and_fees(_lines(w), w.table("invoices"), w.source_system),
    """SELECT strftime(h.invoice_date::DATE, '%Y-%m-%d') AS calendar_day, h.country,
        count(DISTINCT r.invoice_number) FILTER (r.is_cancellation AND NOT r.is_non_product) AS returned_orders_count,
        coalesce(sum(r.line_total) FILTER (r.is_non_product), 0)::DOUBLE AS service_fee_revenue
    FROM core_rows AS r JOIN core_invoices AS h USING (invoice_number)
    WHERE NOT r.is_inventory_adjustment GROUP BY h.invoice_date::DATE, h.country""",
)
query(
    "x13_customer_daily_items",
    lambda w: m.customer_daily_items(_lines(w), w.table("invoices"), w.source_system),
    f"""SELECT customer_id, {day('calendar_day')}, sum(quantity)::BIGINT AS daily_items_count
    FROM sales_lines WHERE is_valid_sale AND customer_id IS NOT NULL GROUP BY customer_id, sales_lines.calendar_day""",
)
query(
    "x13_lifetime_return_rate",
    lambda w: m.lifetime_return_rate(w.table("mart_customer_daily")),
    """SELECT customer_id, sum(gross_spend)::DOUBLE AS lifetime_gross_spend, sum(return_value)::DOUBLE AS lifetime_returned_value,
        CASE WHEN sum(gross_spend) > 0 THEN abs(sum(return_value))::DOUBLE / sum(gross_spend)::DOUBLE ELSE 0 END
            AS lifetime_return_rate FROM mart_buyer_day GROUP BY customer_id""",
)
query(
    "x14_varying_entities",
    lambda w: m.varying_entities(w.clean()),
    """SELECT 'multi_country_customers' AS what, count(*) AS entities, count_if(n > 1)::BIGINT AS varying
    FROM (SELECT count(DISTINCT country) AS n FROM led_clean WHERE customer_id IS NOT NULL GROUP BY customer_id) AS c
    UNION ALL SELECT 'multi_description_codes', count(*), count_if(n > 1)::BIGINT
    FROM (SELECT count(DISTINCT description) AS n FROM led_clean GROUP BY stock_code) AS c
    UNION ALL SELECT 'multi_timestamp_invoices', count(*), count_if(n > 1)::BIGINT
    FROM (SELECT count(DISTINCT invoice_date) AS n FROM led_clean GROUP BY invoice) AS c""",
)
