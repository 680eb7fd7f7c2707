"""Sales analytics: monthly series per customer and their window metrics,
the cookbook's monthly summary, and the small report pipelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import cents

# Fixed values of the cookbook summary (revenue classes).
HIGH_REVENUE = 1000.0      # above: High
MEDIUM_REVENUE = 500.0     # above: Medium, else Low


def monthly_sales(orders: DataFrame, customer: str = "o_custkey",
                  date: str = "o_orderdate", amount: str = "o_totalprice") -> DataFrame:
    """One row per (customer, month) with exact sales cents.

    Pre-aggregating before any window bounds every window partition by the
    number of months, however many orders a hot customer has.
    """
    return (orders.groupBy(F.col(customer).alias("customer"),
                           F.trunc(F.col(date).cast("date"), "month").alias("month"))
            .agg(F.sum(cents(amount)).alias("sales_cents")))


def sales_trend(monthly: DataFrame) -> DataFrame:
    """Row number, ranks, running total, 2-month moving average, previous /
    next month and change per customer, ordered by month."""
    by_month = Window.partitionBy("customer").orderBy("month")
    by_sales = Window.partitionBy("customer").orderBy(F.desc("sales_cents"), F.asc("month"))
    rank_w = Window.partitionBy("customer").orderBy(F.desc("sales_cents"))
    sales = F.col("sales_cents") / F.lit(100.0)
    prev = F.lag("sales_cents", 1).over(by_month)
    return monthly.select(
        "customer", "month", sales.alias("sales"),
        F.row_number().over(by_sales).alias("row_number"),
        F.rank().over(rank_w).alias("rank"),
        F.dense_rank().over(rank_w).alias("dense_rank"),
        (F.sum("sales_cents").over(by_month.rowsBetween(Window.unboundedPreceding,
                                                        Window.currentRow)) / F.lit(100.0))
        .alias("running_total"),
        (F.avg("sales_cents").over(by_month.rowsBetween(-1, 0)) / F.lit(100.0))
        .alias("moving_avg"),
        (prev / F.lit(100.0)).alias("prev_sales"),
        (F.lead("sales_cents", 1).over(by_month) / F.lit(100.0)).alias("next_sales"),
        ((F.col("sales_cents") - prev) / F.lit(100.0)).alias("change"),
    )


def revenue_category(amount: Column) -> Column:
    return (F.when(amount > HIGH_REVENUE, "High").when(amount > MEDIUM_REVENUE, "Medium")
            .otherwise("Low"))


def enriched_sales(raw: DataFrame) -> DataFrame:
    """Cookbook sales rows from raw text ``customer_id, amount,
    date_string``: rows without id or amount go, amount and date are parsed
    (malformed -> null, ANSI-safe), amount > 0 stays; adds year, month,
    quarter (null without a readable date) and the revenue category."""
    amount = F.col("amount").try_cast("double")
    parsed = (raw.dropna(subset=["customer_id", "amount"])
              .withColumn("amount", amount)
              .withColumn("date", F.try_to_date(F.col("date_string"), "yyyy-MM-dd"))
              .where(F.col("amount") > 0)
              .withColumn("year", F.year("date"))
              .withColumn("month", F.month("date"))
              .withColumn("quarter", F.quarter("date"))
              .withColumn("revenue_category", revenue_category(F.col("amount"))))
    return parsed


def monthly_summary(raw: DataFrame) -> DataFrame:
    """Per year and month of :func:`enriched_sales`: transactions, revenue,
    average and distinct customers.  Rows without a readable date are one
    group, under a null year and month (first in the order)."""
    parsed = enriched_sales(raw)
    n = F.count(F.lit(1))
    total_c = F.sum(cents("amount"))
    return (parsed.groupBy("year", "month").agg(
        n.alias("num_transactions"),
        (total_c / F.lit(100.0)).alias("total_revenue"),
        (total_c / n / F.lit(100.0)).alias("avg_transaction"),
        F.count_distinct("customer_id").alias("unique_customers"))
        .orderBy("year", "month"))


def run_monthly_summary(spark, csv_paths, out: str) -> DataFrame:
    """Cookbook job: raw sales CSV -> monthly summary, written by year."""
    from tessera import schemas
    from tessera.sinks.files import write_parquet
    from tessera.sources.files import read_csv
    summary = monthly_summary(read_csv(spark, csv_paths, schemas.SALES_TEXT))
    write_parquet(summary, out, partition_by=["year"])
    return spark.read.parquet(out)
