"""MTH: arithmetic and math functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import hash_unit
from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.sources.tables import table as T


@register("mth_arith", """SELECT l_orderkey, l_linenumber, l_extendedprice * 0.3 AS share,
  l_quantity + l_tax - 1 AS adj, CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity / l_discount END AS ratio
  FROM lineitem""")
def mth_arith(spark, sf):
    c = F.col
    return T(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (c("l_extendedprice") * 0.3).alias("share"),
        (c("l_quantity") + c("l_tax") - 1).alias("adj"),
        F.try_divide(c("l_quantity"), c("l_discount")).alias("ratio"))


@register("mth_round", """SELECT l_orderkey, l_linenumber,
  CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DOUBLE)
  AS discount_value FROM lineitem""")
def mth_round(spark, sf):
    # Rounded on exact decimals: half-up on the true product, not on its
    # binary approximation.
    v = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(4,2)")
    return T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                           F.round(v, 2).cast("double").alias("discount_value"))


@register("mth_greatest", """SELECT c_custkey, greatest(c_acctbal, 0.0) AS floored,
  greatest(CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE c_acctbal END, 1.0) AS with_null FROM customer""")
def mth_greatest(spark, sf):
    bal = F.col("c_acctbal")
    nullable = F.when(F.col("c_custkey") % 15 == 0, F.lit(None).cast("double")).otherwise(bal)
    return T(spark, sf, "customer").select(
        "c_custkey", F.greatest(bal, F.lit(0.0)).alias("floored"),
        F.greatest(nullable, F.lit(1.0)).alias("with_null"))


@register("mth_floor", """SELECT l_orderkey, l_linenumber,
  CAST(floor(l_extendedprice / 1000) AS BIGINT) AS k FROM lineitem""")
def mth_floor(spark, sf):
    return T(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.floor(F.col("l_extendedprice") / 1000).alias("k"))


@register("mth_hash_uniform", f"""SELECT c_custkey, CAST({S.draw('c_custkey', 3)} AS DOUBLE) / {2**60} AS u
  FROM customer""")
def mth_hash_uniform(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", hash_unit("c_custkey", 3).alias("u"))
