"""PRJ: projections and column shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.sources import adapters as A
from tessera.sources.tables import table as T


@register("prj_select", "SELECT c_custkey, c_name FROM customer")
def prj_select(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", F.col("c_name"))


@register("prj_alias", "SELECT c_name AS name, c_acctbal AS balance FROM customer")
def prj_alias(spark, sf):
    return T(spark, sf, "customer").select(F.col("c_name").alias("name"),
                                           F.col("c_acctbal").alias("balance"))


@register("prj_star", "SELECT * FROM part")
def prj_star(spark, sf):
    return T(spark, sf, "part").select("*")


@register("prj_drop", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def prj_drop(spark, sf):
    return T(spark, sf, "customer").drop("c_acctbal")


@register("prj_const", "SELECT c_custkey, 'retail' AS channel, CAST(1 AS INTEGER) AS version FROM customer")
def prj_const(spark, sf):
    return (T(spark, sf, "customer").select("c_custkey")
            .withColumns({"channel": F.lit("retail"), "version": F.lit(1)}))


@register("prj_computed", """SELECT l_orderkey, l_linenumber,
  l_extendedprice * (1 - l_discount) AS net_price, l_quantity * 2 + 1 AS q2 FROM lineitem""")
def prj_computed(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"),
                     (F.col("l_quantity") * 2 + 1).alias("q2"))


@register("prj_case", """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'negative'
  WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band FROM customer""")
def prj_case(spark, sf):
    b = F.col("c_acctbal")
    return T(spark, sf, "customer").select(
        "c_custkey",
        F.when(b < 0, "negative").when(b < 5000, "low").otherwise("high").alias("band"))


@register("prj_case_compound", """SELECT c_custkey, CASE
  WHEN c_acctbal > 5000 AND c_mktsegment = 'BUILDING' THEN 'rich_builder'
  WHEN c_acctbal > 5000 OR c_nationkey < 5 THEN 'rich_or_early' ELSE 'other' END AS tag FROM customer""")
def prj_case_compound(spark, sf):
    c = F.col
    return T(spark, sf, "customer").select(
        "c_custkey",
        F.when((c("c_acctbal") > 5000) & (c("c_mktsegment") == "BUILDING"), "rich_builder")
         .when((c("c_acctbal") > 5000) | (c("c_nationkey") < 5), "rich_or_early")
         .otherwise("other").alias("tag"))


@register("prj_null_default", S.with_retail(
    "SELECT customer_id, COALESCE(email, 'unknown') AS email FROM r_customers"))
def prj_null_default(spark, sf):
    return A.customers(spark, sf).select(
        "customer_id", F.coalesce(F.col("email"), F.lit("unknown")).alias("email"))


@register("prj_rename", "SELECT c_custkey AS customer_id, c_name AS name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def prj_rename(spark, sf):
    return T(spark, sf, "customer").withColumnsRenamed({"c_custkey": "customer_id",
                                                        "c_name": "name"})


@register("prj_todf", "SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation")
def prj_todf(spark, sf):
    return T(spark, sf, "nation").toDF("key", "name", "region")


@register("prj_cast", """SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS key_text,
  CAST(c_nationkey AS BIGINT) AS nation_long, CAST(trunc(c_acctbal) AS INTEGER) AS balance_int,
  TRY_CAST(split_part(c_name, '#', 2) AS INTEGER) AS name_number FROM customer""")
def prj_cast(spark, sf):
    return T(spark, sf, "customer").select(
        "c_custkey",
        F.col("c_custkey").cast("string").alias("key_text"),
        F.col("c_nationkey").cast("long").alias("nation_long"),
        F.col("c_acctbal").cast("int").alias("balance_int"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).try_cast("int").alias("name_number"))
