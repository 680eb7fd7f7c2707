"""SRT: sorts and top-k.  Full sorts are range-partitioned by Spark (no
single-task sort); the comparison with the oracle is order-insensitive, so
order itself is asserted by the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.sources import adapters as A
from tessera.sources.tables import table as T


@register("srt_asc", S.with_retail(
    "SELECT customer_id, email FROM r_customers ORDER BY email ASC NULLS FIRST, customer_id"))
def srt_asc(spark, sf):
    return A.customers(spark, sf).select("customer_id", "email").orderBy("email", "customer_id")


@register("srt_desc", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def srt_desc(spark, sf):
    return (T(spark, sf, "customer").select("c_custkey", "c_acctbal")
            .orderBy(F.desc("c_acctbal"), "c_custkey"))


@register("srt_multi", """SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
  ORDER BY c_mktsegment ASC, c_acctbal DESC, c_custkey""")
def srt_multi(spark, sf):
    c = F.col
    return (T(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
            .orderBy(c("c_mktsegment").asc(), c("c_acctbal").desc(), "c_custkey"))


@register("srt_nulls", S.with_retail(
    "SELECT customer_id, email FROM r_customers ORDER BY email ASC NULLS LAST, customer_id DESC NULLS FIRST"))
def srt_nulls(spark, sf):
    c = F.col
    return (A.customers(spark, sf).select("customer_id", "email")
            .orderBy(c("email").asc_nulls_last(), c("customer_id").desc_nulls_first()))


@register("top_k", """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
  ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10""")
def top_k(spark, sf):
    # TakeOrderedAndProject: each task keeps its own top 10.
    return (T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
            .orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(10))


@register("take_n", "SELECT * FROM nation ORDER BY n_nationkey LIMIT 5")
def take_n(spark, sf):
    # first() / take(n) as a DataFrame: ordered, limited, never collected here.
    return T(spark, sf, "nation").orderBy("n_nationkey").limit(5)
