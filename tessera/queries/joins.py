"""JON: joins over whole tables.  For the outer and semi joins some keys are
moved out of range or set to null, so that every branch (matched, unmatched on
either side, null key) occurs in the driver data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.joins import lookup_join, skew_join
from tessera.plans import retail as R
from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.sources import adapters as A
from tessera.sources.tables import table as T

STRAY_EVERY = 7       # orders of o_custkey % 7 = 0 point at a customer that does not exist
NULL_EVERY = 11       # orders of o_orderkey % 11 = 0 have no customer
NATIONS = 25  # fixed size of the nation table


def _cust(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")


def _strays(spark, sf):
    k = F.col("o_custkey")
    key = (F.when(F.col("o_orderkey") % NULL_EVERY == 0, F.lit(None).cast("long"))
           .when(k % STRAY_EVERY == 0, -k).otherwise(k))
    return T(spark, sf, "orders").select(key.alias("c_custkey"), "o_orderkey", "o_totalprice")


_STRAYS = f"""b AS (SELECT CASE WHEN o_orderkey % {NULL_EVERY} = 0 THEN NULL WHEN o_custkey % {STRAY_EVERY} = 0 THEN -o_custkey
  ELSE o_custkey END AS c_custkey, o_orderkey, o_totalprice FROM orders)"""


@register("join_inner", """SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
  FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey""")
def join_inner(spark, sf):
    o = T(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey",
                                      "o_totalprice")
    return T(spark, sf, "customer").select("c_custkey", "c_name").join(o, "c_custkey", "inner")


@register("join_left", S.with_ctes(
    "SELECT c.c_custkey, c.c_name, c.c_acctbal, b.o_orderkey, b.o_totalprice "
    "FROM customer c LEFT JOIN b ON c.c_custkey = b.c_custkey", _STRAYS))
def join_left(spark, sf):
    return _cust(spark, sf).join(_strays(spark, sf), "c_custkey", "left")


@register("join_right", S.with_ctes(
    "SELECT b.c_custkey, r.c_name, r.c_acctbal, b.o_orderkey, b.o_totalprice "
    "FROM customer r RIGHT JOIN b ON r.c_custkey = b.c_custkey", _STRAYS))
def join_right(spark, sf):
    return _cust(spark, sf).join(_strays(spark, sf), "c_custkey", "right")


@register("join_full", S.with_ctes(
    "SELECT COALESCE(r.c_custkey, b.c_custkey) AS c_custkey, r.c_name, r.c_acctbal, "
    "b.o_orderkey, b.o_totalprice FROM customer r FULL OUTER JOIN b ON r.c_custkey = b.c_custkey",
    _STRAYS))
def join_full(spark, sf):
    # AQE cannot split a skewed key of a full outer join: the salted
    # skew_join spreads customers with very many orders over several tasks.
    return skew_join(_strays(spark, sf), _cust(spark, sf), "c_custkey", "full").select(
        "c_custkey", "c_name", "c_acctbal", "o_orderkey", "o_totalprice")


@register("join_semi", S.with_ctes(
    "SELECT c.c_custkey, c.c_name, c.c_acctbal FROM customer c "
    "WHERE EXISTS (SELECT 1 FROM b WHERE b.c_custkey = c.c_custkey)", _STRAYS))
def join_semi(spark, sf):
    return _cust(spark, sf).join(_strays(spark, sf), "c_custkey", "left_semi")


@register("join_anti", """SELECT o.* FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def join_anti(spark, sf):
    # left_anti is NOT EXISTS: a null key on the left is kept.
    li = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return T(spark, sf, "orders").join(li, "o_orderkey", "left_anti")


@register("join_multi_key", """WITH st AS (SELECT o_custkey, o_orderstatus, COUNT(*) AS n_same
    FROM orders GROUP BY o_custkey, o_orderstatus)
  SELECT o.o_custkey, o.o_orderstatus, o.o_orderkey, st.n_same FROM orders o
  JOIN st ON o.o_custkey = st.o_custkey AND o.o_orderstatus = st.o_orderstatus""")
def join_multi_key(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderkey")
    st = o.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_same"))
    return o.join(st, ["o_custkey", "o_orderstatus"])


@register("join_expr", """SELECT c.c_custkey, o.o_custkey, c.c_name, o.o_orderkey
  FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey""")
def join_expr(spark, sf):
    c = T(spark, sf, "customer")
    o = T(spark, sf, "orders")
    return c.join(o, c.c_custkey == o.o_custkey).select("c_custkey", "o_custkey", "c_name",
                                                         "o_orderkey")


@register("join_compound", """SELECT l.l_orderkey, l.l_linenumber, o.o_orderstatus
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey AND l.l_linestatus = o.o_orderstatus""")
def join_compound(spark, sf):
    li = T(spark, sf, "lineitem")
    o = T(spark, sf, "orders")
    cond = (li.l_orderkey == o.o_orderkey) & (li.l_linestatus == o.o_orderstatus)
    return li.join(o, cond).select("l_orderkey", "l_linenumber", "o_orderstatus")


@register("join_alias", """SELECT c.c_name, n.n_name FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def join_alias(spark, sf):
    c = T(spark, sf, "customer").alias("c")
    n = T(spark, sf, "nation").alias("n")
    return (c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey"))
            .select("c.c_name", "n.n_name"))


@register("join_broadcast", """SELECT c.c_nationkey, c.c_custkey, c.c_name, n.n_name
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def join_broadcast(spark, sf):
    c = T(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_name")
    n = T(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookup_join(c, n, "c_nationkey", how="inner", bounded_rows=NATIONS)


@register("join_lookup", S.with_retail("""SELECT o.product_id, o.order_id, o.quantity,
  p.category, p.unit_price FROM c_orders o LEFT JOIN c_products p ON o.product_id = p.product_id"""))
def join_lookup(spark, sf):
    o = R.clean_orders(A.orders(spark, sf)).select("product_id", "order_id", "quantity")
    p = R.clean_products(A.products(spark, sf))
    return lookup_join(o, p, "product_id", "left", columns=["category", "unit_price"])
