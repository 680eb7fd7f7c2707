"""Driver tables presented as the retail and quotes data the pipelines expect.

The derivations are plain projections and one equi-join each, so they stay in
the same scan stage as the pipeline that reads them.  Dirty cases (null
emails, null customers, non-positive prices, duplicate order ids with a
different payload) are derived from the keys by arithmetic, so they are
reproducible and present at every scale.  The matching SQL text used by the
oracle lives in ``tessera.queries.sqlbits``; the two must stay equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import fan_out, table

# Fixed values of the adapters (dirty-row rules and derived constants).
NULL_EMAIL_EVERY = 97        # c_custkey % 97 = 0 -> email is null
NULL_CUSTOMER_EVERY = 10     # o_custkey % 10 = 0 -> order has no customer
NEGATIVE_PRICE_EVERY = 89    # p_partkey % 89 = 0 -> unit_price = -10
ZERO_PRICE_EVERY = 211       # p_partkey % 211 = 0 -> unit_price = 0
ZERO_STOCK_EVERY = 53        # p_partkey % 53 = 0 -> stock_quantity = 0
INACTIVE_EVERY = 20          # p_partkey % 20 = 0 -> is_active = false
REFUND_EVERY = 31            # l_partkey % 31 = 0 -> total_amount is negative
NULL_TAGS_EVERY = 50         # doc_id % 50 = 0 -> tags is null
REGISTRATION_START = "2021-01-01"
REGISTRATION_DAYS = 1095


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer x nation -> customers schema (Spark broadcasts ``nation`` by
    its measured size)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .select(
                key.alias("customer_id"),
                F.col("c_name").alias("first_name"),
                F.concat(F.lit("Family"), F.lpad((key % 1000).cast("string"), 3, "0")).alias("last_name"),
                F.when(key % NULL_EMAIL_EVERY == 0, F.lit(None).cast("string"))
                 .otherwise(F.concat(F.lit("customer"), key.cast("string"), F.lit("@example.com")))
                 .alias("email"),
                F.concat(F.lit("555-"), F.lpad((key % 10000).cast("string"), 4, "0")).alias("phone"),
                F.col("n_name").alias("city"),
                F.date_add(F.lit(REGISTRATION_START).cast("date"),
                           (key % REGISTRATION_DAYS).cast("int")).alias("registration_date"),
                F.col("c_mktsegment").alias("customer_type"),
            ))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> products schema."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        key.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.when(key % NEGATIVE_PRICE_EVERY == 0, F.lit(-10.0))
         .when(key % ZERO_PRICE_EVERY == 0, F.lit(0.0))
         .otherwise(F.col("p_retailprice")).alias("unit_price"),
        F.when(key % ZERO_STOCK_EVERY == 0, F.lit(0))
         .otherwise(F.col("p_size") * 20).cast("int").alias("stock_quantity"),
        (key % INACTIVE_EVERY != 0).alias("is_active"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders -> orders schema, one row per line.

    ``order_id`` is ``l_orderkey * 10 + l_linenumber``; the driver data
    repeats that pair with a different payload, which is the dedup case.
    """
    li = fan_out(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax"))
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    cust = F.col("o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
                F.when(cust % NULL_CUSTOMER_EVERY == 0, F.lit(None).cast("long"))
                 .otherwise(cust).alias("customer_id"),
                F.col("l_partkey").alias("product_id"),
                F.col("l_quantity").cast("int").alias("quantity"),
                F.col("o_orderdate").cast("date").alias("order_date"),
                F.col("o_orderstatus").alias("order_status"),
                F.col("o_orderpriority").alias("payment_method"),
                F.when(F.col("l_partkey") % REFUND_EVERY == 0, -F.col("l_extendedprice"))
                 .otherwise(F.col("l_extendedprice")).alias("total_amount"),
                F.col("l_discount").alias("discount_amount"),
                F.col("l_tax").alias("shipping_cost"),
            ))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> quotes schema (text, author, tags, page, scrape time)."""
    d = fan_out(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return d.select(
        F.col("text").alias("quote_text"),
        F.col("source").alias("author"),
        F.when(F.col("doc_id") % NULL_TAGS_EVERY == 0, F.lit(None).cast("array<string>"))
         .otherwise(F.array(F.col("lang"), F.col("source"))).alias("tags"),
        F.col("doc_id").alias("page_number"),
        F.concat(F.lit("2024-01-01T00:00:"),
                 F.lpad((F.col("doc_id") % 60).cast("string"), 2, "0")).alias("scraped_at"),
    )


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer with nulls by key: name every 6th, segment every 10th,
    balance every 15th key, so every 30th row is null in all columns.
    No key column (the all-null case must be possible)."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        F.when(key % 6 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("name"),
        F.when(key % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(key % 15 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("balance"),
    )
