"""Explicit schemas of the retail, quotes and sales data (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("registration_date", T.DateType()),
    T.StructField("customer_type", T.StringType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("stock_quantity", T.IntegerType()),
    T.StructField("is_active", T.BooleanType()),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("discount_amount", T.DoubleType()),
    T.StructField("shipping_cost", T.DoubleType()),
])

QUOTES = T.StructType([
    T.StructField("quote_text", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("page_number", T.LongType()),
    T.StructField("scraped_at", T.StringType()),
])

# Raw sales text of the cookbook pipeline: everything is text until parsed.
SALES_TEXT = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("amount", T.StringType()),
    T.StructField("date_string", T.StringType()),
])

PURCHASES = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("purchases", T.ArrayType(T.LongType())),
])
