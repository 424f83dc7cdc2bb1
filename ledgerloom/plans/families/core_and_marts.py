"""B and M operators: core tables and marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ...operators import core, marts
from ..oracle import FLAGS, LINE_ID, SYSTEM
from ..registry import day, moment, query, real, whole

_PRINT = "(SELECT print FROM led_print)"

query(
    "b01_source_row_number",
    lambda w: core.number_rows(core.core_rows(w.clean())).select(
        F.concat_ws(":", F.lit(w.source_system), "source_sheet", F.col("source_row_number").cast("string")).alias("source_line_key"),
        "source_sheet", "source_row_number", "invoice_number", "stock_code",
    ),
    "SELECT source_line_key, source_sheet, source_row_number, invoice_number, stock_code FROM core_lines",
)
query(
    "b02_unit_price",
    lambda w: core.core_rows(w.clean()).groupBy("unit_price").agg(F.count(F.lit(1)).alias("line_count")),
    f"SELECT {real('unit_price')}, count(*) AS line_count FROM core_rows GROUP BY unit_price",
)
query(
    "b03_line_total",
    lambda w: core.core_rows(w.clean()).groupBy("quantity", "unit_price", "line_total").agg(
        F.count(F.lit(1)).alias("line_count")
    ),
    f"""SELECT quantity::BIGINT AS quantity, {real('unit_price', 'line_total')}, count(*) AS line_count
    FROM core_rows GROUP BY quantity, unit_price, line_total""",
)
query(
    "b04_customers",
    lambda w: core.build_customers(w.clean(), w.source_system, w.fingerprint()),
    f"""SELECT source_system, customer_id, primary_country,
        {moment('first_invoice_date', 'last_invoice_date')}, total_orders_lifetime,
        {real('total_merchandise_spend')}, {_PRINT} AS source_file_sha256 FROM core_customers""",
)
query(
    "b05_products",
    lambda w: core.build_products(w.clean(), w.source_system, w.fingerprint()),
    f"""SELECT source_system, stock_code, primary_description, product_type, is_physical_merchandise,
        {real('median_unit_price')}, {moment('first_seen_date', 'last_seen_date')},
        {_PRINT} AS source_file_sha256 FROM core_products""",
)
query(
    "b06_invoices",
    lambda w: core.build_invoices(w.clean(), w.source_system, w.fingerprint()),
    f"""SELECT source_system, invoice_number, customer_id, {moment('invoice_date')}, country,
        invoice_type, total_line_count, total_quantity, {real('total_invoice_amount')},
        {_PRINT} AS source_file_sha256 FROM core_invoices""",
)
query(
    "b07_invoice_type_counts",
    lambda w: w.table("invoices").groupBy("invoice_type").agg(
        F.count(F.lit(1)).alias("invoice_count"), F.sum("total_invoice_amount").alias("amount")
    ),
    """SELECT invoice_type, count(*) AS invoice_count, sum(total_invoice_amount)::DOUBLE AS amount
    FROM core_invoices GROUP BY invoice_type""",
)


def _description_mode(w):
    stats = core.core_rows(w.clean()).groupBy("stock_code", "description").agg(
        F.count(F.lit(1)).alias("n"), F.max("source_order").alias("last_order")
    )
    return stats.groupBy("stock_code").agg(core.attribute_mode(stats, "description").alias("mode_description"))


query(
    "b08_description_mode",
    _description_mode,
    """SELECT c.stock_code, m.description AS mode_description
    FROM (SELECT DISTINCT stock_code FROM core_rows) AS c
    LEFT JOIN (
        SELECT stock_code, description, count(*) AS n, max(pos) AS last_pos FROM core_rows
        WHERE description IS NOT NULL GROUP BY stock_code, description
        QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY n DESC, last_pos DESC) = 1
    ) AS m USING (stock_code)""",
)
query(
    "b09_first_known_customer",
    lambda w: core.build_invoices(w.clean(), w.source_system, "").select("invoice_number", "customer_id"),
    """SELECT i.invoice_number, f.customer_id
    FROM (SELECT DISTINCT invoice_number FROM core_rows) AS i
    LEFT JOIN (
        SELECT invoice_number, customer_id FROM core_rows WHERE customer_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY invoice_number ORDER BY pos) = 1
    ) AS f USING (invoice_number)""",
)
query(
    "b10_invoice_lines",
    lambda w: core.build_lines(w.clean(), w.source_system, w.fingerprint()),
    f"""SELECT {LINE_ID} AS line_id, source_system, source_line_key, source_sheet, source_row_number, source_file_sha256,
        invoice_number, stock_code, customer_id, description, {moment('invoice_date')},
        quantity::BIGINT AS quantity, {real('unit_price', 'line_total')}, {FLAGS} FROM core_lines""",
)


def _provenance(w):
    frames = [
        w.table(name).groupBy("source_file_sha256").agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("table_name", F.lit(name))
        for name in ("customers", "products", "invoices", "invoice_lines")
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


query(
    "b11_provenance",
    _provenance,
    f"""SELECT t.table_name, t.row_count, {_PRINT} AS source_file_sha256 FROM (
        SELECT 'customers' AS table_name, count(*) AS row_count FROM core_customers
        UNION ALL SELECT 'products', count(*) FROM core_products
        UNION ALL SELECT 'invoices', count(*) FROM core_invoices
        UNION ALL SELECT 'invoice_lines', count(*) FROM core_rows) AS t""",
)

query(
    "m01_eligible_lines",
    lambda w: marts.eligible_ledger(w.table("invoice_lines"), w.table("invoices")).select(
        "source_line_key", "invoice_number", "stock_code", "customer_id", "calendar_day", "country",
        "quantity", "line_total", "is_valid_sale", "is_cancellation", "is_non_product",
    ),
    f"""SELECT concat('{SYSTEM}:', source_sheet, ':', source_row_number) AS source_line_key, invoice_number,
        stock_code, customer_id, {day('calendar_day')}, header_country AS country, quantity::BIGINT AS quantity,
        {real('line_total')}, is_valid_sale, is_cancellation, is_non_product FROM sales_lines""",
)
query(
    "m02_daily_sales",
    lambda w: w.build_mart("mart_daily_sales"),
    f"""SELECT {day('calendar_day')}, country, is_physical_merchandise,
        {real('gross_sales')}, gross_sales::DOUBLE AS valid_sales_revenue, {real('return_value', 'net_sales')},
        distinct_invoices, units_sold, units_returned FROM mart_daily""",
)
query(
    "m03_customer_daily",
    lambda w: w.build_mart("mart_customer_daily"),
    f"""SELECT customer_id, {day('calendar_day')}, order_frequency,
        {real('gross_spend', 'return_value', 'net_spend')}, valid_transaction_count FROM mart_buyer_day""",
)
query(
    "m04_customer_snapshot",
    lambda w: w.build_mart("mart_customer_snapshot"),
    f"""SELECT customer_id, primary_country, {whole('recency_days', 'frequency')}, {real('monetary')},
        average_order_value, {whole('tenure_days')}, {day('first_purchase_date', 'last_purchase_date')}
    FROM mart_snapshot""",
)


def _sql_over_views(w):
    w.register_views()
    return w.spark.sql(
        """
        SELECT m.calendar_day, count(DISTINCT m.customer_id) AS buyers, sum(m.net_spend) AS net_spend
        FROM mart_customer_daily AS m
        JOIN customers AS c ON c.customer_id = m.customer_id AND c.source_system = :system
        WHERE m.calendar_day <= :as_of AND c.primary_country = :country AND m.order_frequency > 0
        GROUP BY m.calendar_day
        """,
        args={"system": w.source_system, "as_of": date(2000, 6, 30), "country": "NATION_3"},
    )


query(
    "m05_sql_over_views",
    _sql_over_views,
    """SELECT strftime(m.calendar_day, '%Y-%m-%d') AS calendar_day, count(DISTINCT m.customer_id) AS buyers,
        sum(m.net_spend)::DOUBLE AS net_spend
    FROM mart_buyer_day AS m JOIN core_customers AS c USING (customer_id)
    WHERE m.calendar_day <= DATE '2000-06-30' AND c.primary_country = 'NATION_3' AND m.order_frequency > 0
    GROUP BY m.calendar_day""",
)
