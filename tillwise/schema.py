"""Column names and types of the sales tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The five reporting dimensions, in reporting order.
DIMENSIONS = ("region", "channel", "customer_segment", "category", "product")

# Short labels used for the dimensions in rankings and ids.
DIMENSION_LABELS = {
    "region": "Region",
    "channel": "Channel",
    "customer_segment": "Segment",
    "category": "Category",
    "product": "Product",
}
FILTER_KEYS = {
    "region": "region",
    "channel": "channel",
    "customer_segment": "segment",
    "category": "category",
    "product": "product",
}

MONEY = T.DecimalType(18, 4)
MONEY_COLUMNS = ("gross_revenue", "discount_amount", "net_revenue", "cost", "gross_profit")

# Optional whole-number companions of the money columns, in ten-thousandths.
UNITS = {
    "gross_revenue": "gross_units",
    "discount_amount": "discount_units",
    "net_revenue": "net_units",
    "cost": "cost_units",
    "gross_profit": "profit_units",
}

# A raw sales line as delivered, one row per order line.
RAW_SALES = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("region", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("customer_segment", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("list_price", T.DecimalType(15, 2)),
        T.StructField("discount_rate", T.DecimalType(9, 6)),
        T.StructField("unit_cost", T.DecimalType(15, 2)),
    ]
)
RAW_COLUMNS = tuple(RAW_SALES.fieldNames())

# The columns of an exported fact, in their order.
FACT_COLUMNS = (
    "transaction_id",
    "order_id",
    "order_date",
    *DIMENSIONS,
    "quantity",
    "gross_revenue",
    "discount_amount",
    "discount_rate",
    "net_revenue",
    "cost",
    "gross_profit",
    "gross_margin",
    "month",
)

# Optional narrow stand-in for order_id: equal exactly when order_id is equal.
ORDER_KEY = "order_key"

# Versions of the batch tables and of accepted uploads.
SCHEMA_VERSION = "2.0.0"
UPLOAD_SCHEMA_VERSION = "3.0.0-user-data"
