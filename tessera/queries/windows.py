"""WIN: window functions over monthly sales per customer (pre-aggregated,
so each window partition holds at most one row per month)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.plans.sales import monthly_sales, sales_trend
from tessera.queries import register
from tessera.sources.tables import table as T

MONTHLY = """WITH m AS (SELECT o_custkey AS customer, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
  SUM(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS sales_cents
  FROM orders GROUP BY 1, 2)
"""


def _monthly(spark, sf):
    return monthly_sales(T(spark, sf, "orders"))


def _sales():
    return F.col("sales_cents") / F.lit(100.0)


@register("win_row_number", MONTHLY + """SELECT customer, month, CAST(row_number() OVER (PARTITION BY customer ORDER BY sales_cents DESC, month ASC) AS INTEGER) AS rn FROM m""")
def win_row_number(spark, sf):
    w = Window.partitionBy("customer").orderBy(F.desc("sales_cents"), F.asc("month"))
    return _monthly(spark, sf).select("customer", "month", F.row_number().over(w).alias("rn"))


@register("win_rank", MONTHLY + """SELECT customer, month, CAST(rank() OVER (PARTITION BY customer ORDER BY sales_cents DESC) AS INTEGER) AS rnk FROM m""")
def win_rank(spark, sf):
    w = Window.partitionBy("customer").orderBy(F.desc("sales_cents"))
    return _monthly(spark, sf).select("customer", "month", F.rank().over(w).alias("rnk"))


@register("win_dense_rank", MONTHLY + """SELECT customer, month, CAST(dense_rank() OVER (PARTITION BY customer ORDER BY sales_cents DESC) AS INTEGER) AS drnk FROM m""")
def win_dense_rank(spark, sf):
    w = Window.partitionBy("customer").orderBy(F.desc("sales_cents"))
    return _monthly(spark, sf).select("customer", "month", F.dense_rank().over(w).alias("drnk"))


@register("win_running_sum", MONTHLY + """SELECT customer, month, CAST(SUM(sales_cents) OVER
  (PARTITION BY customer ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 100
  AS running_total FROM m""")
def win_running_sum(spark, sf):
    w = (Window.partitionBy("customer").orderBy("month")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return _monthly(spark, sf).select(
        "customer", "month", (F.sum("sales_cents").over(w) / F.lit(100.0)).alias("running_total"))


@register("win_moving_avg", MONTHLY + """SELECT customer, month, AVG(sales_cents) OVER
  (PARTITION BY customer ORDER BY month ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) / 100
  AS moving_avg FROM m""")
def win_moving_avg(spark, sf):
    w = Window.partitionBy("customer").orderBy("month").rowsBetween(-1, 0)
    return _monthly(spark, sf).select(
        "customer", "month", (F.avg("sales_cents").over(w) / F.lit(100.0)).alias("moving_avg"))


@register("win_lag_lead", MONTHLY + """SELECT customer, month,
  CAST(lag(sales_cents, 1) OVER (PARTITION BY customer ORDER BY month) AS DOUBLE) / 100 AS prev_sales,
  CAST(lead(sales_cents, 1) OVER (PARTITION BY customer ORDER BY month) AS DOUBLE) / 100 AS next_sales,
  CAST(sales_cents - lag(sales_cents, 1) OVER (PARTITION BY customer ORDER BY month) AS DOUBLE) / 100
  AS change FROM m""")
def win_lag_lead(spark, sf):
    w = Window.partitionBy("customer").orderBy("month")
    prev = F.lag("sales_cents", 1).over(w)
    return _monthly(spark, sf).select(
        "customer", "month", (prev / F.lit(100.0)).alias("prev_sales"),
        (F.lead("sales_cents", 1).over(w) / F.lit(100.0)).alias("next_sales"),
        ((F.col("sales_cents") - prev) / F.lit(100.0)).alias("change"))


@register("sales_trend", MONTHLY + """SELECT customer, month, CAST(sales_cents AS DOUBLE) / 100 AS sales,
  CAST(row_number() OVER (PARTITION BY customer ORDER BY sales_cents DESC, month ASC) AS INTEGER) AS row_number,
  CAST(rank() OVER (PARTITION BY customer ORDER BY sales_cents DESC) AS INTEGER) AS rank,
  CAST(dense_rank() OVER (PARTITION BY customer ORDER BY sales_cents DESC) AS INTEGER) AS dense_rank,
  CAST(SUM(sales_cents) OVER (PARTITION BY customer ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING
    AND CURRENT ROW) AS DOUBLE) / 100 AS running_total,
  AVG(sales_cents) OVER (PARTITION BY customer ORDER BY month ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)
    / 100 AS moving_avg,
  CAST(lag(sales_cents, 1) OVER (PARTITION BY customer ORDER BY month) AS DOUBLE) / 100 AS prev_sales,
  CAST(lead(sales_cents, 1) OVER (PARTITION BY customer ORDER BY month) AS DOUBLE) / 100 AS next_sales,
  CAST(sales_cents - lag(sales_cents, 1) OVER (PARTITION BY customer ORDER BY month) AS DOUBLE) / 100
    AS change FROM m""", headline=True)
def sales_trend_q(spark, sf):
    return sales_trend(_monthly(spark, sf))
