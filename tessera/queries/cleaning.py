"""CLN / SET / PRF: nulls, duplicates, sampling, unions, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import threshold
from tessera.operators.clean import dedup_by_key
from tessera.operators.profile import describe
from tessera.operators.sample import sample_by_hash, sample_random, split_by_hash
from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.sources import adapters as A
from tessera.sources.tables import table as T


@register("cln_dropna_any", S.with_ctes(
    "SELECT * FROM sparse WHERE name IS NOT NULL AND segment IS NOT NULL AND balance IS NOT NULL",
    S.SPARSE))
def cln_dropna_any(spark, sf):
    return A.sparse(spark, sf).dropna()


@register("cln_dropna_all", S.with_ctes(
    "SELECT * FROM sparse WHERE name IS NOT NULL OR segment IS NOT NULL OR balance IS NOT NULL",
    S.SPARSE))
def cln_dropna_all(spark, sf):
    return A.sparse(spark, sf).dropna(how="all")


@register("cln_dropna_subset", S.with_ctes("SELECT * FROM sparse WHERE name IS NOT NULL", S.SPARSE))
def cln_dropna_subset(spark, sf):
    return A.sparse(spark, sf).dropna(subset=["name"])


@register("cln_fillna_scalar", S.with_ctes(
    "SELECT name, segment, COALESCE(balance, 0) AS balance FROM sparse", S.SPARSE))
def cln_fillna_scalar(spark, sf):
    # fillna(0) touches numeric columns only; strings keep their nulls.
    return A.sparse(spark, sf).fillna(0)


@register("cln_fillna_map", S.with_ctes(
    "SELECT COALESCE(name, 'unknown') AS name, segment, COALESCE(balance, 0.0) AS balance FROM sparse",
    S.SPARSE))
def cln_fillna_map(spark, sf):
    return A.sparse(spark, sf).fillna({"name": "unknown", "balance": 0.0})


@register("cln_replace", S.with_ctes(
    "SELECT name, CASE WHEN segment = 'BUILDING' THEN 'CONSTRUCTION' ELSE segment END AS segment, "
    "balance FROM sparse", S.SPARSE))
def cln_replace(spark, sf):
    return A.sparse(spark, sf).replace("BUILDING", "CONSTRUCTION", subset=["segment"])


@register("cln_distinct", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def cln_distinct(spark, sf):
    return T(spark, sf, "customer").select("c_mktsegment", "c_nationkey").distinct()


@register("cln_dedup_key", S.with_retail(S.dedup("r_orders", ["order_id"], S.ORDER_COLS)))
def cln_dedup_key(spark, sf):
    return dedup_by_key(A.orders(spark, sf), ["order_id"])


@register("smp_hash", f"SELECT * FROM orders WHERE {S.draw('o_orderkey', 5)} < {threshold(0.1)}")
def smp_hash(spark, sf):
    return sample_by_hash(T(spark, sf, "orders"), "o_orderkey", 0.1, salt=5)


_SIZE_SQL = """SELECT TRUE AS size_fits, TRUE AS distinct_rows, COUNT(*) AS n_orders FROM orders"""


def _about(n, total, share: float):
    """Whether n is within five standard deviations of total * share."""
    return F.abs(n - total * share) <= F.sqrt(total * (share * (1 - share))) * 5 + 1


@register("smp_random", _SIZE_SQL)
def smp_random(spark, sf):
    # Bernoulli sample: membership is random, so its size is what is checked.
    o = T(spark, sf, "orders")
    n = F.count(F.lit(1))
    total = o.select(n).scalar()
    return sample_random(o, 0.5, seed=42).agg(
        _about(n, total, 0.5).alias("size_fits"), (n == F.count_distinct("o_orderkey")).alias("distinct_rows"),
        total.alias("n_orders"))


@register("smp_split_hash", f"""SELECT o_orderkey, o_custkey,
  CASE WHEN {S.draw('o_orderkey', 42)} < {threshold(0.8)} THEN 0 ELSE 1 END AS part FROM orders""")
def smp_split_hash(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return split_by_hash(o, "o_orderkey", [0.8, 0.2], salt=42, column="part")


@register("smp_split_random", _SIZE_SQL)
def smp_split_random(spark, sf):
    train, test = T(spark, sf, "orders").randomSplit([0.8, 0.2], seed=42)
    n = F.count(F.lit(1))
    return train.withColumn("part", F.lit(0)).unionByName(test.withColumn("part", F.lit(1))).agg(
        _about(F.count_if(F.col("part") == 1), n, 0.2).alias("size_fits"),
        (n == F.count_distinct("o_orderkey")).alias("distinct_rows"), n.alias("n_orders"))


@register("set_union_by_name", """SELECT n_nationkey, n_name FROM nation
  UNION ALL SELECT r_regionkey AS n_nationkey, r_name AS n_name FROM region""")
def set_union_by_name(spark, sf):
    n = T(spark, sf, "nation").select("n_nationkey", "n_name")
    r = T(spark, sf, "region").select(F.col("r_name").alias("n_name"),
                                      F.col("r_regionkey").alias("n_nationkey"))
    return n.unionByName(r)


_DESCRIBE_COLS = ("l_quantity", "l_extendedprice", "l_discount")


def _describe_sql() -> str:
    parts = []
    for stat, fn in (("count", "CAST(COUNT({c}) AS DOUBLE)"), ("mean", "AVG({c})"),
                     ("stddev", "STDDEV_SAMP({c})"), ("min", "MIN({c})"), ("max", "MAX({c})")):
        cols = ", ".join(f"ROUND({fn.format(c=c)}, 4) AS {c}" for c in _DESCRIBE_COLS)
        parts.append(f"SELECT '{stat}' AS summary, {cols} FROM lineitem")
    return "\nUNION ALL ".join(parts)


@register("prf_describe", _describe_sql())
def prf_describe(spark, sf):
    return describe(T(spark, sf, "lineitem"), _DESCRIBE_COLS, digits=4)
