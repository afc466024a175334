"""Declared schemas of every layer (raw, bronze, silver, staged, gold).

Raw and silver keep the extract's own types (ids as int64, timestamps as
strings); staging fixes the conformed types the gold layer relies on.
"""

from __future__ import annotations

from pyspark.sql import types as T

_ID = T.LongType()
_PRICE = T.DecimalType(12, 2)
_AMOUNT = T.DecimalType(14, 2)

RAW = {
    "customers": T.StructType([
        T.StructField("customer_id", _ID),
        T.StructField("name", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("updated_at", T.StringType()),
    ]),
    "products": T.StructType([
        T.StructField("product_id", _ID),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("unit_price", _PRICE),
    ]),
    "orders": T.StructType([
        T.StructField("order_id", _ID),
        T.StructField("customer_id", _ID),
        T.StructField("order_ts", T.StringType()),
        T.StructField("status", T.StringType()),
    ]),
    "order_items": T.StructType([
        T.StructField("order_item_id", _ID),
        T.StructField("order_id", _ID),
        T.StructField("product_id", _ID),
        T.StructField("quantity", _ID),
        T.StructField("unit_price", _PRICE),
    ]),
}

# Lineage columns added by the bronze ingest.
EXTRACT_DATE = "_extract_date"
INGESTED_AT = "_ingested_at"
LINEAGE = (
    T.StructField(EXTRACT_DATE, T.DateType()),
    T.StructField(INGESTED_AT, T.TimestampNTZType()),
)

BRONZE = {t: T.StructType(list(s.fields) + list(LINEAGE)) for t, s in RAW.items()}

# Silver keeps the raw columns (cleaned values, raw types).
SILVER = RAW

# Natural key of every table.
KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "order_item_id",
}

# Conformed types applied by staging (P4).  Ids stay 64-bit on purpose.
STAGED_TYPES = {
    "customers": {"customer_id": "bigint", "name": "string", "segment": "string",
                  "city": "string", "updated_at": "timestamp_ntz"},
    "products": {"product_id": "bigint", "name": "string", "category": "string",
                 "unit_price": "decimal(12,2)"},
    "orders": {"order_id": "bigint", "customer_id": "bigint",
               "order_ts": "timestamp_ntz", "status": "string"},
    "order_items": {"order_item_id": "bigint", "order_id": "bigint",
                    "product_id": "bigint", "quantity": "int",
                    "unit_price": "decimal(12,2)"},
}

DIM_CUSTOMER = T.StructType([
    T.StructField("customer_sk", T.StringType()),
    T.StructField("customer_id", _ID),
    T.StructField("name", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("valid_from", T.TimestampNTZType()),
    T.StructField("valid_to", T.TimestampNTZType()),
    T.StructField("is_current", T.BooleanType()),
])

FACT_SALES_AMOUNT = _AMOUNT

# Stored gold tables, declared so reading them back needs no schema inference.
GOLD = {
    "dim_customer": DIM_CUSTOMER,
    "dim_product": T.StructType([
        T.StructField("product_sk", _ID),
        T.StructField("product_id", _ID),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("unit_price", _PRICE),
    ]),
    "dim_date": T.StructType([
        T.StructField("date_day", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("weekday", T.StringType()),
    ]),
    "fact_sales": T.StructType([
        T.StructField("order_item_id", _ID),
        T.StructField("order_id", _ID),
        T.StructField("customer_sk", T.StringType()),
        T.StructField("product_sk", _ID),
        T.StructField("date_day", T.DateType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", _PRICE),
        T.StructField("amount", _AMOUNT),
        T.StructField("status", T.StringType()),
    ]),
}
