"""Synthetic retail tables (PIP-26..29).  Ids come from the driver tables, so
the generated volume grows with them; every value is reproduced by the
oracle from the same integer draws."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import threshold
from tessera.plans import synth as G
from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.sources.tables import table as T

AS_OF = "2024-12-31"


def _ids(spark, sf, name, key):
    return T(spark, sf, name).select((F.col(key) - 1).alias("id"))


def _date_sub(n: str) -> str:
    return f"CAST(DATE '{AS_OF}' - CAST({n} AS INTEGER) AS DATE)"


_GEN_CUSTOMERS = f"""WITH i AS (SELECT c_custkey - 1 AS id FROM customer)
SELECT CAST(id + 1 AS BIGINT) AS customer_id, 'FirstName' || CAST(id + 1 AS VARCHAR) AS first_name,
  'LastName' || CAST(id + 1 AS VARCHAR) AS last_name,
  CASE WHEN {S.draw_below('id', 0, 100000)} < {G.NULL_EMAIL_PER_100K} THEN NULL
       ELSE 'customer' || CAST(id + 1 AS VARCHAR) || '@example.com' END AS email,
  '614-555-' || lpad(CAST({S.draw_below('id', 1, 10000)} AS VARCHAR), 4, '0') AS phone,
  {S.drawn_pick(G.CITIES, 'id', 2)} AS city,
  {_date_sub(S.draw_below('id', 3, 1095))} AS registration_date,
  {S.drawn_pick(G.CUSTOMER_TYPES, 'id', 4)} AS customer_type FROM i"""


@register("gen_customers", _GEN_CUSTOMERS)
def gen_customers(spark, sf):
    return G.generate_customers(_ids(spark, sf, "customer", "c_custkey"), AS_OF)


_P = S.split_draw("n0", *G.PRODUCT_DRAWS) + S.split_draw("n1", *G.STOCK_DRAWS)
_GEN_PRODUCTS = f"""WITH i AS (SELECT p_partkey - 1 AS id FROM part),
n AS (SELECT id, {S.number('id', 0)} AS n0, {S.number('id', 1)} AS n1 FROM i)
SELECT CAST(id + 1 AS BIGINT) AS product_id, 'Product_' || CAST(id + 1 AS VARCHAR) AS product_name,
  {S.pick(G.CATEGORIES, _P[0])} AS category, {S.pick(G.BRANDS, _P[1])} AS brand,
  CASE WHEN {_P[3]} < {G.NEGATIVE_PRICE_PER_100K} THEN CAST(-10 AS DOUBLE)
       ELSE {S.drawn_cents(_P[2], 500)} END AS unit_price,
  CAST({_P[4]} AS INTEGER) AS stock_quantity, {_P[5]} >= {G.INACTIVE_PER_100} AS is_active FROM n"""


@register("gen_products", _GEN_PRODUCTS)
def gen_products(spark, sf):
    return G.generate_products(_ids(spark, sf, "part", "p_partkey"))


_N_CUST = f"(SELECT greatest({G.MIN_CUSTOMERS}, COUNT(*) // {G.CUSTOMERS_PER_ORDER_DIV}) FROM orders)"
_N_PROD = f"(SELECT greatest({G.MIN_PRODUCTS}, COUNT(*) // {G.PRODUCTS_PER_ORDER_DIV}) FROM orders)"

_GEN_ORDERS = f"""WITH i AS (SELECT o_orderkey - 1 AS id FROM orders),
g AS (SELECT CAST(id + 1 AS BIGINT) AS order_id,
  CASE WHEN {S.draw_below('id', 11, 100000)} < {G.NULL_CUSTOMER_PER_100K} THEN NULL
       ELSE {S.draw_below('id', 0, _N_CUST)} + 1 END AS customer_id,
  {S.draw_below('id', 1, _N_PROD)} + 1 AS product_id,
  CAST({S.draw_below('id', 2, 5)} + 1 AS INTEGER) AS quantity,
  {_date_sub(S.draw_below('id', 3, 365))} AS order_date,
  {S.drawn_pick(G.ORDER_STATUSES, 'id', 4)} AS order_status,
  {S.drawn_pick(G.PAYMENT_METHODS, 'id', 5)} AS payment_method,
  CAST({S.cents_between('id', 6, 1000, 49500)} AS DOUBLE) / 100 AS total_amount,
  CAST({S.cents_between('id', 7, 0, 5000)} AS DOUBLE) / 100 AS discount_amount,
  CAST({S.cents_between('id', 8, 500, 2000)} AS DOUBLE) / 100 AS shipping_cost FROM i)
SELECT * FROM g UNION ALL SELECT * FROM g WHERE {S.draw('order_id', 9)} < {threshold(G.DUPLICATE_FRACTION)}"""


@register("gen_orders", _GEN_ORDERS)
def gen_orders(spark, sf):
    ids = _ids(spark, sf, "orders", "o_orderkey")
    # The scale rule needs one number, the order count, as a scalar subquery.
    n_c, n_p = G.table_sizes(ids.agg(F.count(F.lit(1)).alias("n")).scalar())
    return G.generate_orders(ids, n_c, n_p, AS_OF)


@register("gen_table_sizes", f"""SELECT COUNT(*) AS n_orders,
  greatest({G.MIN_CUSTOMERS}, COUNT(*) // {G.CUSTOMERS_PER_ORDER_DIV}) AS n_customers,
  greatest({G.MIN_PRODUCTS}, COUNT(*) // {G.PRODUCTS_PER_ORDER_DIV}) AS n_products FROM orders""")
def gen_table_sizes(spark, sf):
    n = F.count(F.lit(1))
    n_c, n_p = G.table_sizes(n)
    return T(spark, sf, "orders").agg(n.alias("n_orders"), n_c.cast("long").alias("n_customers"),
                                      n_p.cast("long").alias("n_products"))
