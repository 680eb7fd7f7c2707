"""Synthetic retail tables of any size, generated on the executors.

Every value is drawn from the row id, never from ``rand()``: a regenerated
partition gives the same rows, and the same tables come out at any
partitioning.  Each value of a customer or order has a digest of its own
(``tessera.functions.hashing.draw``); products take several draws from a digest
(``numbers``).  Ids come from ``spark.range(n)`` or from any DataFrame with an
``id`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import as_of_date
from tessera.functions.hashing import draw, draw_below, numbers, split_draw, threshold
from tessera.sinks.files import write_parquet

# Fixed values of the generator (reference lists and rates).
CITIES = ["Columbus", "Cleveland", "Cincinnati", "Toledo", "Akron",
          "Dayton", "Parma", "Canton", "Youngstown", "Lorain"]
CUSTOMER_TYPES = ["Premium", "Standard", "Basic"]
CATEGORIES = ["Electronics", "Books", "Clothing", "Home & Garden",
              "Toys", "Sports", "Automotive", "Health", "Grocery"]
BRANDS = ["BrandA", "BrandB", "BrandC", "BrandD", "BrandE",
          "BrandF", "BrandG", "BrandH", "BrandI", "BrandJ"]
ORDER_STATUSES = ["Completed", "Pending", "Shipped", "Cancelled", "Processing"]
PAYMENT_METHODS = ["Credit Card", "Debit Card", "PayPal", "Cash", "Bank Transfer"]
NULL_EMAIL_PER_100K = 100        # 0.1%
NEGATIVE_PRICE_PER_100K = 50     # 0.05%
NULL_CUSTOMER_PER_100K = 50      # 0.05%
INACTIVE_PER_100 = 5             # 5% inactive
DUPLICATE_FRACTION = 0.001       # 0.1% duplicated orders
PER = 100_000
MIN_CUSTOMERS, CUSTOMERS_PER_ORDER_DIV = 10000, 5
MIN_PRODUCTS, PRODUCTS_PER_ORDER_DIV = 1000, 100


def _pick(values: list[str], drawn: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), drawn.cast("int"))


def _drawn(values: list[str], stream: int) -> Column:
    return _pick(values, draw_below("id", stream, len(values)))


def _cents(drawn: Column, low_cents: int) -> Column:
    """low + round(u * span) in cents, u uniform in [0, 1); ``drawn`` is below
    :func:`cent_steps` of the span."""
    return F.lit(low_cents) + F.call_function("div", drawn + 1, F.lit(2))


def cent_steps(span_cents: int) -> int:
    return span_cents * 2 + 1


def _drawn_cents(stream: int, low_cents: int, span_cents: int) -> Column:
    return _cents(draw_below("id", stream, cent_steps(span_cents)), low_cents) / F.lit(100.0)


def _with_numbers(id_df: DataFrame, n: int) -> DataFrame:
    """``id`` and the columns _n0, _n1, ... every draw of a row is made from."""
    return id_df.select("id", *[c.alias(f"_n{i}") for i, c in enumerate(numbers("id", n))])


def ids(spark: SparkSession, n: int) -> DataFrame:
    """Row ids 0..n-1 (``spark.range``), split over the default parallelism."""
    return spark.range(n)


def table_sizes(n_orders) -> tuple[Column, Column]:
    """The scale rule: customers = max(10000, n/5), products = max(1000, n/100)."""
    n = n_orders if isinstance(n_orders, Column) else F.lit(n_orders)
    return (F.greatest(F.lit(MIN_CUSTOMERS), F.call_function("div", n, F.lit(CUSTOMERS_PER_ORDER_DIV))),
            F.greatest(F.lit(MIN_PRODUCTS), F.call_function("div", n, F.lit(PRODUCTS_PER_ORDER_DIV))))


# Sizes of the draws that share one number (see ``split_draw``).
PRODUCT_DRAWS = (len(CATEGORIES), len(BRANDS), cent_steps(49500), PER)
STOCK_DRAWS = (1000, 100)


def generate_customers(id_df: DataFrame, as_of: str | None = None) -> DataFrame:
    cid = (F.col("id") + 1).cast("long")
    email = F.concat(F.lit("customer"), cid.cast("string"), F.lit("@example.com"))
    return id_df.select(
        cid.alias("customer_id"),
        F.concat(F.lit("FirstName"), cid.cast("string")).alias("first_name"),
        F.concat(F.lit("LastName"), cid.cast("string")).alias("last_name"),
        F.when(draw_below("id", 0, PER) < NULL_EMAIL_PER_100K, F.lit(None).cast("string")).otherwise(email).alias("email"),
        F.concat(F.lit("614-555-"), F.lpad(draw_below("id", 1, 10000).cast("string"), 4, "0")).alias("phone"),
        _drawn(CITIES, 2).alias("city"),
        F.date_sub(as_of_date(as_of), draw_below("id", 3, 1095).cast("int")).alias("registration_date"),
        _drawn(CUSTOMER_TYPES, 4).alias("customer_type"),
    )


def generate_products(id_df: DataFrame) -> DataFrame:
    pid = (F.col("id") + 1).cast("long")
    category, brand, steps, negative = split_draw(F.col("_n0"), *PRODUCT_DRAWS)
    stock, inactive = split_draw(F.col("_n1"), *STOCK_DRAWS)
    price = _cents(steps, 500) / F.lit(100.0)        # 5.00 .. 500.00
    return _with_numbers(id_df, 2).select(
        pid.alias("product_id"),
        F.concat(F.lit("Product_"), pid.cast("string")).alias("product_name"),
        _pick(CATEGORIES, category).alias("category"),
        _pick(BRANDS, brand).alias("brand"),
        F.when(negative < NEGATIVE_PRICE_PER_100K, F.lit(-10.0)).otherwise(price).alias("unit_price"),
        stock.cast("int").alias("stock_quantity"),
        (inactive >= INACTIVE_PER_100).alias("is_active"),
    )


def generate_orders(id_df: DataFrame, max_customer_id, max_product_id,
                    as_of: str | None = None) -> DataFrame:
    """Orders over customer ids 1..max_customer_id and product ids
    1..max_product_id (ints or Columns, e.g. scalar subqueries); 0.05% have
    no customer and 0.1% are duplicated.  One pass: a duplicated order comes
    out of its own row twice."""
    order_id = (F.col("id") + 1).cast("long")
    copies = (F.when(draw(order_id, 9) < threshold(DUPLICATE_FRACTION), F.array(F.lit(1), F.lit(2)))
              .otherwise(F.array(F.lit(1))))
    return id_df.select(
        order_id.alias("order_id"),
        F.when(draw_below("id", 11, PER) < NULL_CUSTOMER_PER_100K, F.lit(None).cast("long"))
         .otherwise(draw_below("id", 0, max_customer_id) + 1).alias("customer_id"),
        (draw_below("id", 1, max_product_id) + 1).alias("product_id"),
        (draw_below("id", 2, 5) + 1).cast("int").alias("quantity"),
        F.date_sub(as_of_date(as_of), draw_below("id", 3, 365).cast("int")).alias("order_date"),
        _drawn(ORDER_STATUSES, 4).alias("order_status"),
        _drawn(PAYMENT_METHODS, 5).alias("payment_method"),
        _drawn_cents(6, 1000, 49500).alias("total_amount"),
        _drawn_cents(7, 0, 5000).alias("discount_amount"),
        _drawn_cents(8, 500, 2000).alias("shipping_cost"),
        copies.alias("_copies"),
    ).withColumn("_copy", F.explode_outer("_copies")).drop("_copies", "_copy")    # outer: no filter that draws again


def generate_all(spark: SparkSession, n_orders: int, out: str, as_of: str | None = None) -> dict:
    """Write customers, products and orders (partitioned by order_date) for
    ``n_orders`` orders with the scale rule; returns the paths."""
    n_c = max(MIN_CUSTOMERS, n_orders // CUSTOMERS_PER_ORDER_DIV)
    n_p = max(MIN_PRODUCTS, n_orders // PRODUCTS_PER_ORDER_DIV)
    paths = {k: f"{out.rstrip('/')}/{k}" for k in ("customers", "products", "orders")}
    write_parquet(generate_customers(ids(spark, n_c), as_of), paths["customers"])
    write_parquet(generate_products(ids(spark, n_p)), paths["products"])
    write_parquet(generate_orders(ids(spark, n_orders), n_c, n_p, as_of), paths["orders"],
                  partition_by=["order_date"])
    return paths
