"""Fixed column names, types and limits of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Payload columns of the raw layer, in file order, with the
# longest text each one accepts.
RAW_LIMITS = {
    "transaction_id": 50,
    "customer_id": 50,
    "transaction_date": 50,
    "product_id": 50,
    "product_name": 100,
    "quantity": 50,
    "price": 50,
    "tax": 50,
}
RAW_COLUMNS = tuple(RAW_LIMITS)

# Product names the fact table accepts.
ACCEPTED_PRODUCT_NAMES = ("Product A", "Product B", "Product C", "Product D", "Product E")

# Numeric text is kept as an exact decimal, the widest for which price * quantity + tax
# still fits 38 digits; MONEY holds rounded sums.
AMOUNT_SCALE = 10
AMOUNT_INTEGER_DIGITS = 16
AMOUNT = T.DecimalType(AMOUNT_INTEGER_DIGITS + AMOUNT_SCALE, AMOUNT_SCALE)
MONEY = T.DecimalType(38, 2)
RATE = T.DecimalType(29, 4)

RAW_CSV_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])
RAW_SCHEMA = T.StructType(
    RAW_CSV_SCHEMA.fields + [T.StructField("loaded_at", T.TimestampNTZType())]
)

FACT_MEASURES = (
    "quantity",
    "unit_price",
    "tax",
    "gross_amount",
    "total_amount",
    "tax_rate_pct",
)
