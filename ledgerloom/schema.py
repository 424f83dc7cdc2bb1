"""Column names, Spark schemas, table contracts and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

DEFAULT_SOURCE_SYSTEM = "LEDGER"

LEDGER_COLUMNS = [
    "Invoice",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "Price",
    "Customer ID",
    "Country",
]

TEXT_LEDGER_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in LEDGER_COLUMNS])

FLAG_COLUMNS = [
    "is_duplicate_within_sheet",
    "is_duplicate_cross_sheet",
    "is_cancellation",
    "is_bad_debt_adjustment",
    "is_negative_quantity",
    "is_return",
    "is_inventory_adjustment",
    "has_customer_id",
    "has_description",
    "has_valid_price",
    "is_price_zero",
    "is_price_negative",
    "is_non_product",
    "is_unknown_special_code",
    "is_valid_sale",
]

CLEAN_COLUMNS = LEDGER_COLUMNS + ["source_sheet"] + FLAG_COLUMNS + ["line_total"]

# The subset whose absence makes a cleaned ledger structurally invalid.
REQUIRED_CLEAN_FLAGS = [
    f for f in FLAG_COLUMNS
    if f not in ("is_return", "is_price_zero", "is_price_negative", "is_unknown_special_code")
]

# --- Fixed values: codes, labels and thresholds that results depend on -------------------

NON_PRODUCT_CODES = [
    "ADJUST", "ADJUST2", "AMAZONFEE", "BANK CHARGES", "C2", "CRUK", "D", "DOT",
    "GIFT VOUCHER", "M", "POST", "S", "TEST001", "TEST002",
]
NON_PRODUCT_PREFIX = "GIFT_0001_"

PHYSICAL = "PHYSICAL_MERCHANDISE"
PRODUCT_TYPES = {
    "ADJUST": "INVENTORY_ADJUSTMENT",
    "ADJUST2": "INVENTORY_ADJUSTMENT",
    "AMAZONFEE": "AMAZON_FEE",
    "BANK CHARGES": "BANK_CHARGE",
    "C2": "CARRIAGE",
    "CRUK": "SERVICE",
    "D": "DISCOUNT",
    "DOT": "DISCOUNT",
    "M": "MANUAL_FEE",
    "POST": "POSTAGE",
    "S": "SAMPLE",
    "TEST001": "TEST",
    "TEST002": "TEST",
}

INVOICE_TYPES = ["CANCELLATION", "BAD_DEBT_ADJUSTMENT", "INVENTORY_ADJUSTMENT", "SALE"]

# (upper bound inclusive, label); the first bin has no lower bound, the last no upper bound.
FREQUENCY_TIERS = [
    (0, "0 Orders (Registered/No Purchase)"),
    (1, "1 Order (One-Time)"),
    (4, "2-4 Orders (Occasional)"),
    (9, "5-9 Orders (Frequent)"),
    (None, "10+ Orders (VIP Power Buyers)"),
]
MONETARY_BRACKETS = [
    (0, "<= £0 (Net Negative)"),
    (500, "< £500 (Low Spend)"),
    (2_000, "£500 - £2,000 (Medium)"),
    (5_000, "£2,000 - £5,000 (High)"),
    (20_000, "£5,000 - £20,000 (Premium)"),
    (None, "£20,000+ (Enterprise VIP)"),
]

CRM_DEFAULT = "Standard automated engagement."
CRM_ACTIONS = {
    "Champions": "💎 **Reward & Retain:** VIP concierge service, early access to new product drops, personalized appreciation gifts, and referral advocate incentives.",
    "Loyal Customers": "🌟 **Upsell & Cross-Sell:** Recommend higher-tier bundles, invite to loyalty points tier, solicit product feedback and reviews.",
    "Potential Loyalists": "🚀 **Nurture Engagement:** Offer multi-buy discounts, category recommendations, and welcome-back series to increase purchase frequency.",
    "Promising": "🌱 **Encourage Habit:** Trial discounts on complementary items, personalized onboarding, and timely re-order reminders.",
    "At Risk": "⚠️ **Urgent Win-Back:** Send personalized reconnect offers, surveys to diagnose dissatisfaction, and aggressive limited-time renewal coupons.",
    "Need Attention": "🔔 **Re-Ignite Interest:** Highlight trending products, seasonal gift guides, and limited-time promotional bundles.",
    "About To Sleep": "💤 **Reactivate:** Low-cost automated email campaigns with steep clearance discounts before they drift into Lost.",
    "Hibernating": "❄️ **Cold Recovery:** Rebuild brand relevance with high-impact promotions; suppress from costly offline mailings.",
    "Lost": "🛑 **Sunset or Archive:** Attempt a final clearance win-back blast, otherwise exclude from ad retargeting spend to preserve marketing budget.",
    "Standard": "📦 **Standard Engagement:** Standard newsletters and seasonal catalog mailings.",
}

# --- Relational core -----------------------------------------------------------------------

_PRICE = T.DecimalType(12, 2)
_MONEY = T.DecimalType(14, 2)
# Totals of one invoice or customer may cover a large share of a very large ledger.
_TOTAL = T.DecimalType(24, 2)


def _table(*fields):
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


CORE_SCHEMAS = {
    "customers": _table(
        ("source_system", T.StringType(), False),
        ("customer_id", T.LongType(), False),
        ("primary_country", T.StringType(), False),
        ("first_invoice_date", T.TimestampNTZType(), False),
        ("last_invoice_date", T.TimestampNTZType(), False),
        ("total_orders_lifetime", T.LongType(), False),
        ("total_merchandise_spend", _TOTAL, False),
        ("source_file_sha256", T.StringType(), False),
    ),
    "products": _table(
        ("source_system", T.StringType(), False),
        ("stock_code", T.StringType(), False),
        ("primary_description", T.StringType(), True),
        ("product_type", T.StringType(), False),
        ("is_physical_merchandise", T.BooleanType(), False),
        ("median_unit_price", _PRICE, True),
        ("first_seen_date", T.TimestampNTZType(), False),
        ("last_seen_date", T.TimestampNTZType(), False),
        ("source_file_sha256", T.StringType(), False),
    ),
    "invoices": _table(
        ("source_system", T.StringType(), False),
        ("invoice_number", T.StringType(), False),
        ("customer_id", T.LongType(), True),
        ("invoice_date", T.TimestampNTZType(), False),
        ("country", T.StringType(), False),
        ("invoice_type", T.StringType(), False),
        ("total_line_count", T.LongType(), False),
        ("total_quantity", T.LongType(), False),
        ("total_invoice_amount", _TOTAL, False),
        ("source_file_sha256", T.StringType(), False),
    ),
    "invoice_lines": _table(
        ("line_id", T.LongType(), False),
        ("source_system", T.StringType(), False),
        ("source_line_key", T.StringType(), False),
        ("source_sheet", T.StringType(), False),
        ("source_row_number", T.LongType(), False),
        ("source_file_sha256", T.StringType(), False),
        ("invoice_number", T.StringType(), False),
        ("stock_code", T.StringType(), False),
        ("customer_id", T.LongType(), True),
        ("description", T.StringType(), True),
        ("invoice_date", T.TimestampNTZType(), False),
        ("quantity", T.IntegerType(), False),
        ("unit_price", _PRICE, False),
        ("line_total", _MONEY, False),
        *[(flag, T.BooleanType(), False) for flag in FLAG_COLUMNS],
    ),
}

# Load order: parents first, so that a reader never meets a child without its parent.
CORE_TABLES = list(CORE_SCHEMAS)

GRAINS = {
    "customers": ["source_system", "customer_id"],
    "products": ["source_system", "stock_code"],
    "invoices": ["source_system", "invoice_number"],
    "invoice_lines": ["source_system", "source_line_key"],
}

MONEY_PRECISION = {
    (table, f.name): f.dataType.precision
    for table, schema in CORE_SCHEMAS.items()
    for f in schema
    if isinstance(f.dataType, T.DecimalType)
}

# Line columns that carry source content (no surrogate, no derived total).
PAYLOAD_COLUMNS = [
    f.name for f in CORE_SCHEMAS["invoice_lines"] if f.name not in ("line_id", "line_total")
]

FEATURE_COLUMNS = [
    "customer_id",
    "primary_country",
    "reference_date",
    "recency_days",
    "frequency",
    "monetary",
    "average_order_value",
    "tenure_days",
]
