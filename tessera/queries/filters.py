"""FLT: filters and predicates (all push into the parquet scan)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.sources import adapters as A
from tessera.sources.tables import table as T


@register("flt_cmp", "SELECT * FROM customer WHERE c_acctbal > 3000")
def flt_cmp(spark, sf):
    return T(spark, sf, "customer").filter(F.col("c_acctbal") > 3000)


@register("flt_eq", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def flt_eq(spark, sf):
    return T(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")


@register("flt_and", "SELECT * FROM lineitem WHERE l_quantity > 30 AND l_discount < 0.05")
def flt_and(spark, sf):
    c = F.col
    return T(spark, sf, "lineitem").filter((c("l_quantity") > 30) & (c("l_discount") < 0.05))


@register("flt_or", "SELECT * FROM customer WHERE c_nationkey = 1 OR c_acctbal < 0")
def flt_or(spark, sf):
    c = F.col
    return T(spark, sf, "customer").filter((c("c_nationkey") == 1) | (c("c_acctbal") < 0))


@register("flt_sql_text", "SELECT * FROM customer WHERE c_acctbal > 5000 AND c_name IS NOT NULL")
def flt_sql_text(spark, sf):
    return T(spark, sf, "customer").where("c_acctbal > 5000 and c_name is not null")


@register("flt_not", S.with_retail(
    "SELECT * FROM r_customers WHERE NOT (email LIKE '%1%')"))
def flt_not(spark, sf):
    return A.customers(spark, sf).filter(~F.col("email").like("%1%"))


@register("flt_in", "SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def flt_in(spark, sf):
    return T(spark, sf, "customer").filter(F.col("c_mktsegment").isin(["BUILDING", "MACHINERY"]))


@register("flt_like", "SELECT * FROM part WHERE p_name LIKE '%re%'")
def flt_like(spark, sf):
    return T(spark, sf, "part").filter(F.col("p_name").like("%re%"))


@register("flt_null", S.with_retail("SELECT * FROM r_customers WHERE email IS NULL"))
def flt_null(spark, sf):
    return A.customers(spark, sf).filter(F.col("email").isNull())


@register("flt_not_null", S.with_retail("SELECT * FROM r_customers WHERE email IS NOT NULL"))
def flt_not_null(spark, sf):
    return A.customers(spark, sf).filter(F.col("email").isNotNull())


@register("flt_bool", S.with_retail("SELECT * FROM r_products WHERE is_active"))
def flt_bool(spark, sf):
    return A.products(spark, sf).filter(F.col("is_active"))
