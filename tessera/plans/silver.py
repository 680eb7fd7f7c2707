"""Silver layer of the retail pipeline: four Parquet outputs, the two
date-keyed ones partitioned by ``order_date``, optional JDBC publish.

Cleaned orders are written first and re-read by the metrics: the written
table cuts the lineage (a lost executor recomputes from files, not from the
raw scan + dedup) and is read by two downstream aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation

from tessera.plans import retail as R
from tessera.sinks.files import write_parquet
from tessera.sinks.jdbc import publish

# Configuration keys of the published tables.
PUBLISH_KEYS = {"customers_analytics": "table_customers", "products_metrics": "table_products",
                "daily_metrics": "table_daily_metrics"}
OUTPUTS = ("orders_clean", "customers_analytics", "products_metrics", "daily_metrics")


def write_silver(customers: DataFrame, products: DataFrame, orders: DataFrame, root: str,
                 segments=R.DEFAULT_SEGMENTS, jdbc: Mapping[str, str] | None = None) -> dict:
    """Write the silver tables below ``root``; returns their paths.  Inputs
    are the cleaned tables.  With ``jdbc`` the three analytics tables are
    published under the configuration keys of ``PUBLISH_KEYS``."""
    spark = orders.sparkSession
    paths = {name: f"{root.rstrip('/')}/{name}" for name in OUTPUTS}
    write_parquet(orders, paths["orders_clean"], partition_by=["order_date"], dynamic=True)
    orders_w = spark.read.parquet(paths["orders_clean"]).select(*orders.columns)
    outputs = {
        "customers_analytics": R.customer_analytics(customers, orders_w, products, segments),
        "products_metrics": R.product_metrics(products, orders_w),
        "daily_metrics": R.daily_metrics(orders_w, products),
    }
    for name, df in outputs.items():
        if name == "daily_metrics":
            write_parquet(df, paths[name], partition_by=["order_date"], dynamic=True)
        else:
            write_parquet(df, paths[name])
    if jdbc is not None:
        for name, key in PUBLISH_KEYS.items():
            publish(spark.read.parquet(paths[name]), jdbc, key)
    return paths


class BatchResult(dict):
    """Paths by output name, and ``rows_read``: the rows of each input entity."""

    def __init__(self, paths: Mapping[str, str], rows_read: Mapping[str, int]) -> None:
        super().__init__(paths)
        self.rows_read = dict(rows_read)


def run_batch(spark, input_root: str, out_root: str, segments=R.DEFAULT_SEGMENTS,
              jdbc: Mapping[str, str] | None = None) -> BatchResult:
    """The whole retail batch job: fail-fast reads of the three entities
    (``customers``, ``products``, ``orders`` below ``input_root``),
    cleaning, analytics, silver outputs and optional publish.

    The rows of each entity are observed by the first write that reads it
    (``Observation``), so counting them runs no job of its own."""
    from tessera import schemas
    from tessera.sources.files import read_entity
    root = input_root.rstrip("/")
    seen = {entity: Observation(f"{entity} read") for entity in ("customers", "products", "orders")}

    def read(entity: str, schema) -> DataFrame:
        return read_entity(spark, f"{root}/{entity}", entity, schema, observation=seen[entity])

    customers = read("customers", schemas.CUSTOMERS)
    products = read("products", schemas.PRODUCTS)
    orders = read("orders", schemas.ORDERS)
    paths = write_silver(R.clean_customers(customers), R.clean_products(products),
                         R.clean_orders(orders), out_root, segments, jdbc)
    return BatchResult(paths, {entity: o.get["rows"] for entity, o in seen.items()})
