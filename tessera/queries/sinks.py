"""SNK: sinks, checked by writing to the shared scratch folder and reading
the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.silver import write_silver
from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.queries.retail import cleaned, DAILY_SQL
from tessera.queries.sources import CUSTOMER_DDL, ORDERS_DDL
from tessera.session import scratch_path
from tessera.sinks.files import write_csv, write_json, write_parquet
from tessera.sources.files import read_csv, read_json, read_parquet
from tessera.sources.tables import table as T


@register("snk_csv", "SELECT * FROM customer")
def snk_csv(spark, sf):
    path = scratch_path(spark, "snk_csv")
    write_csv(T(spark, sf, "customer"), path, mode="overwrite")
    return read_csv(spark, path, CUSTOMER_DDL)


@register("snk_csv_pipe", "SELECT * FROM customer")
def snk_csv_pipe(spark, sf):
    path = scratch_path(spark, "snk_csv_pipe")
    write_csv(T(spark, sf, "customer"), path, sep="|")
    return read_csv(spark, path, CUSTOMER_DDL, sep="|")


@register("snk_json", "SELECT * FROM orders")
def snk_json(spark, sf):
    path = scratch_path(spark, "snk_json")
    write_json(T(spark, sf, "orders"), path, compression="none")
    return read_json(spark, path, ORDERS_DDL)


@register("snk_parquet", "SELECT * FROM lineitem")
def snk_parquet(spark, sf):
    path = scratch_path(spark, "snk_parquet")
    write_parquet(T(spark, sf, "lineitem"), path, compression="snappy")
    return read_parquet(spark, path)


@register("snk_parquet_partitioned", S.with_retail("SELECT * FROM c_orders"))
def snk_parquet_partitioned(spark, sf):
    _, _, o = cleaned(spark, sf)
    path = scratch_path(spark, "snk_parquet_partitioned")
    write_parquet(o, path, partition_by=["order_date"])
    # The partition column comes back from the directory names as a date.
    return read_parquet(spark, path).select(*o.columns)


@register("snk_dynamic_overwrite", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders
  WHERE o_orderstatus <> 'F'
  UNION ALL SELECT o_orderkey, o_custkey, o_totalprice * 2, o_orderstatus FROM orders
  WHERE o_orderstatus = 'F'""")
def snk_dynamic_overwrite(spark, sf):
    path = scratch_path(spark, "snk_dynamic_overwrite")
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    write_parquet(o, path, partition_by=["o_orderstatus"])
    redo = o.where(F.col("o_orderstatus") == "F").withColumn("o_totalprice",
                                                             F.col("o_totalprice") * 2)
    # Replaces the F partition only; O and P stay as written before.
    write_parquet(redo, path, partition_by=["o_orderstatus"], dynamic=True)
    return read_parquet(spark, path).select(*o.columns)


@register("snk_append", """SELECT n_nationkey, n_name FROM nation
  UNION ALL SELECT r_regionkey, r_name FROM region""")
def snk_append(spark, sf):
    path = scratch_path(spark, "snk_append")
    write_parquet(T(spark, sf, "nation").select("n_nationkey", "n_name"), path)
    r = T(spark, sf, "region").select(F.col("r_regionkey").alias("n_nationkey"),
                                      F.col("r_name").alias("n_name"))
    write_parquet(r, path, mode="append")
    return read_parquet(spark, path)


@register("snk_single_file", """SELECT s_nationkey, COUNT(*) AS suppliers, MAX(s_acctbal) AS best
  FROM supplier GROUP BY s_nationkey""")
def snk_single_file(spark, sf):
    # One file is for results that an aggregate has made small (25 nations).
    path = scratch_path(spark, "snk_single_file")
    report = T(spark, sf, "supplier").groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("suppliers"), F.max("s_acctbal").alias("best"))
    write_csv(report, path, num_files=1)
    return read_csv(spark, path, "s_nationkey INT, suppliers BIGINT, best DOUBLE")


@register("silver_daily_metrics", DAILY_SQL)
def silver_daily_metrics(spark, sf):
    c, p, o = cleaned(spark, sf)
    root = scratch_path(spark, "silver")
    write_silver(c, p, o, root)
    return read_parquet(spark, f"{root}/daily_metrics").select(
        "product_id", "order_date", "category", "quantity_sold", "revenue", "num_orders",
        "avg_order_value", "profit")
