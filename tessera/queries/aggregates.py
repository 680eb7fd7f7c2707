"""AGG: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import avg_money, sum_money
from tessera.operators.aggregate import agg_dict, pivot_count, sorted_list
from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.sources.tables import table as T


@register("agg_global", f"""SELECT COUNT(*) AS n, CAST(SUM(l_quantity) AS DOUBLE) AS sum_qty,
  {S.avg_money('l_extendedprice')} AS avg_price, MIN(l_extendedprice) AS min_price,
  MAX(l_extendedprice) AS max_price FROM lineitem""")
def agg_global(spark, sf):
    return T(spark, sf, "lineitem").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty"),
        avg_money("l_extendedprice").alias("avg_price"),
        F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"))


_GROUP_AGGS = f"""COUNT(*) AS n, {S.sum_money('l_extendedprice')} AS revenue,
  {S.avg_money('l_extendedprice')} AS avg_price, MIN(l_quantity) AS min_qty, MAX(l_quantity) AS max_qty"""


def _group_aggs():
    return [F.count(F.lit(1)).alias("n"), sum_money("l_extendedprice").alias("revenue"),
            avg_money("l_extendedprice").alias("avg_price"),
            F.min("l_quantity").alias("min_qty"), F.max("l_quantity").alias("max_qty")]


@register("agg_group", f"SELECT l_returnflag, {_GROUP_AGGS} FROM lineitem GROUP BY l_returnflag")
def agg_group(spark, sf):
    return T(spark, sf, "lineitem").groupBy("l_returnflag").agg(*_group_aggs())


@register("agg_group_multi", f"""SELECT l_returnflag, l_linestatus, {_GROUP_AGGS}
  FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_group_multi(spark, sf):
    return T(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(*_group_aggs())


@register("agg_count", 'SELECT o_orderstatus, COUNT(*) AS "count" FROM orders GROUP BY o_orderstatus')
def agg_count(spark, sf):
    return T(spark, sf, "orders").groupBy("o_orderstatus").count()


@register("agg_avg", 'SELECT c_mktsegment, AVG(c_nationkey) AS "avg(c_nationkey)" FROM customer GROUP BY c_mktsegment')
def agg_avg(spark, sf):
    return T(spark, sf, "customer").groupBy("c_mktsegment").avg("c_nationkey")


@register("agg_dict", """SELECT l_returnflag, SUM(l_quantity) AS total_quantity,
  MAX(l_partkey) AS "max(l_partkey)" FROM lineitem GROUP BY l_returnflag""")
def agg_dict_q(spark, sf):
    return agg_dict(T(spark, sf, "lineitem"), ["l_returnflag"],
                    {"l_quantity": "sum", "l_partkey": "max"},
                    rename={"sum(l_quantity)": "total_quantity"})


@register("agg_count_distinct", """SELECT o_orderstatus, COUNT(DISTINCT o_custkey) AS customers
  FROM orders GROUP BY o_orderstatus""")
def agg_count_distinct(spark, sf):
    return T(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.count_distinct("o_custkey").alias("customers"))


@register("agg_approx_within_bound", """SELECT (SELECT COUNT(*) FROM part) AS parts,
  abs(COUNT(DISTINCT l_partkey) - (SELECT COUNT(*) FROM part)) <= 0.2 * (SELECT COUNT(*) FROM part) AS within_bound
  FROM lineitem""")
def agg_approx_within_bound(spark, sf):
    li = T(spark, sf, "lineitem")
    approx = F.approx_count_distinct("l_partkey", rsd=0.05)
    # The catalogue's row count (file metadata) stands in for the exact number,
    # which only the oracle computes.
    parts = T(spark, sf, "part").select(F.count(F.lit(1))).scalar()
    return li.agg(approx.alias("approx")).select(
        parts.alias("parts"), (F.abs(F.col("approx") - parts) <= parts * 0.2).alias("within_bound"))


@register("agg_collect_list", """SELECT o_custkey, array_to_string(list_sort(list(o_orderstatus)), ',')
  AS statuses FROM orders GROUP BY o_custkey""")
def agg_collect_list(spark, sf):
    # Sorted so the result does not depend on task order; built from
    # (value, count) pairs so a hot customer's buffer stays small.
    lists = sorted_list(T(spark, sf, "orders"), "o_custkey", "o_orderstatus", "statuses")
    return lists.select("o_custkey", F.array_join("statuses", ",").alias("statuses"))


@register("agg_collect_set", """SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',')
  AS statuses FROM orders GROUP BY o_custkey""")
def agg_collect_set(spark, sf):
    return T(spark, sf, "orders").groupBy("o_custkey").agg(
        F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"))


@register("agg_first_last", """SELECT o_custkey,
  first(o_orderstatus ORDER BY o_orderdate, o_orderkey) AS first_status,
  first(o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS last_status
  FROM orders GROUP BY o_custkey""")
def agg_first_last(spark, sf):
    # first()/last() are arbitrary without an order; min_by/max_by on a
    # unique order key define them (and aggregate partially, map-side).
    order = F.struct("o_orderdate", "o_orderkey")
    return T(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min_by("o_orderstatus", order).alias("first_status"),
        F.max_by("o_orderstatus", order).alias("last_status"))


@register("agg_pivot_auto", """SELECT o_orderpriority,
  NULLIF(COUNT(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS "F",
  NULLIF(COUNT(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS "O",
  NULLIF(COUNT(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS "P"
  FROM orders GROUP BY o_orderpriority""")
def agg_pivot_auto(spark, sf):
    return pivot_count(T(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")


@register("agg_pivot", """SELECT o_orderpriority,
  NULLIF(COUNT(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS "F",
  NULLIF(COUNT(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS "O",
  CAST(NULL AS BIGINT) AS "X"
  FROM orders GROUP BY o_orderpriority""")
def agg_pivot(spark, sf):
    return pivot_count(T(spark, sf, "orders"), "o_orderpriority", "o_orderstatus",
                       ["F", "O", "X"])
