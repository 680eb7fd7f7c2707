"""Retail batch pipeline: cleaning, customer analytics, product metrics,
daily metrics, and the silver-layer outputs.

Every function is lazy.  Money is summed exactly (``tessera.functions.money``)
and every tie has a defined winner, so a run gives the same rows at any
partitioning and on task retries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import cents, draw_below, half_up_div, round_ratio, sum_money
from tessera.operators.clean import dedup_by_key, quality_report

# Fixed values of the pipeline (reference behaviour).
DEFAULT_SEGMENTS = (1000.0, 500.0, 100.0)   # Premium, Gold, Silver lower bounds
PROFIT_RATE_TENTHS = 3                      # profit = 30% of revenue
COST_SALT = 17                              # salt of the simulated cost draw
COST_STEPS = 1_000_000                      # values that draw can take
TOP_PRODUCTS = 10

CUSTOMER_FILL = {"lifetime_value": 0.0, "total_orders": 0, "active_days": 0,
                 "activity_score": 0.0, "segment": "New",
                 "preferred_category": "Unknown"}


# --------------------------------------------------------------------------
# Cleaning
# --------------------------------------------------------------------------

def clean_customers(customers: DataFrame) -> DataFrame:
    """Drop rows without email; one row per customer_id."""
    return dedup_by_key(customers.where(F.col("email").isNotNull()), ["customer_id"])


def clean_products(products: DataFrame) -> DataFrame:
    """Keep unit_price > 0 (drops negative, zero and null); one row per
    product_id, the survivor has the smallest row digest."""
    return dedup_by_key(products.where(F.col("unit_price") > 0), ["product_id"], ties="digest")


def clean_orders(orders: DataFrame) -> DataFrame:
    """Drop orders without customer; one row per order_id, the survivor is
    the smallest by product and quantity, then by row digest.  What a metric
    does not use is not shuffled."""
    return dedup_by_key(orders.where(F.col("customer_id").isNotNull()), ["order_id"],
                        order=["product_id", "quantity"], ties="digest")


def quality_reports(customers: DataFrame, products: DataFrame,
                    orders: DataFrame) -> DataFrame:
    """Before / after / removed counts of the three cleaning steps."""
    return (quality_report("customers", customers, F.col("email").isNotNull(), "customer_id")
            .unionByName(quality_report("products", products,
                                        F.coalesce(F.col("unit_price") > 0, F.lit(False)),
                                        "product_id"))
            .unionByName(quality_report("orders", orders, F.col("customer_id").isNotNull(),
                                        "order_id")))


# --------------------------------------------------------------------------
# Customer analytics
# --------------------------------------------------------------------------

def segment_of(value: F.Column, thresholds: Sequence[float] = DEFAULT_SEGMENTS) -> F.Column:
    premium, gold, silver = thresholds
    return (F.when(value >= premium, "Premium").when(value >= gold, "Gold")
            .when(value >= silver, "Silver").otherwise("Bronze"))


def _customer_metrics(enriched: DataFrame) -> DataFrame:
    """customer_id, lifetime_value, total_orders, active_days and
    preferred_category from order rows with their category.

    A row counts towards its day and towards its category, so one hash
    aggregate gives the amount and orders per (customer, day) and the rows per
    (customer, category), combined in each task before the shuffle.  What is
    left of a customer is as many rows as it has days and categories, however
    many orders; the most frequent category is the first of those in order.
    """
    null = lambda c: F.lit(None).cast(enriched.schema[c].dataType)
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("order_date").alias("day"), null("category").alias("group")),
                    F.struct(F.lit(1).alias("side"), null("order_date").alias("day"), F.col("category").alias("group")))
    both = enriched.select("customer_id", "order_id", cents("total_amount").alias("_cents"), F.inline(sides))
    dated = F.col("side") == 0
    counted = both.groupBy("customer_id", "side", "day", "group").agg(
        F.sum(F.when(dated, F.col("_cents"))).alias("_cents"),
        F.count(F.when(dated, F.col("order_id"))).alias("_orders"),
        F.count(F.lit(1)).alias("_rows"))
    # Categories come first, the most frequent before ties by name; a null
    # category is none.
    order = Window.partitionBy("customer_id").orderBy(
        F.col("group").isNull().asc(), F.col("_rows").desc(), F.col("group").asc())
    first = F.first("group").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (counted.withColumn("preferred_category", first)
            .groupBy("customer_id", "preferred_category").agg(
                (F.sum("_cents") / F.lit(100.0)).alias("lifetime_value"),
                F.sum("_orders").alias("total_orders"),
                F.count("day").alias("active_days")))


def customer_analytics(customers: DataFrame, orders: DataFrame, products: DataFrame,
                       thresholds: Sequence[float] = DEFAULT_SEGMENTS) -> DataFrame:
    """Customers extended with lifetime value, order count, active days,
    activity score, segment and preferred category.

    Inputs are the cleaned tables.  Customers without orders get segment
    ``New`` and zeros; ``preferred_category`` is the non-null category with
    the most order rows (ties: smallest name), else ``Unknown``.
    """
    facts = orders.select("customer_id", "product_id", "order_id", "order_date",
                          "total_amount")
    # Dimension lookup: Catalyst / AQE broadcast the product side when its
    # measured size is under the broadcast threshold and sort-merge it
    # otherwise; AQE splits a skewed product key.
    enriched = facts.join(products.select("product_id", "category"), "product_id", "left")
    metrics = _customer_metrics(enriched)
    metrics = (metrics
               .withColumn("activity_score",
                           round_ratio("total_orders", F.greatest("active_days", F.lit(1)), 2))
               .withColumn("segment", segment_of(F.col("lifetime_value"), thresholds)))
    out = customers.join(metrics, "customer_id", "left").fillna(CUSTOMER_FILL)
    return out.select(*customers.columns, "lifetime_value", "total_orders", "active_days",
                      "preferred_category", "activity_score", "segment")


def segment_distribution(customer_analytics_df: DataFrame) -> DataFrame:
    """Customers per segment, most common first."""
    return (customer_analytics_df.groupBy("segment").count()
            .orderBy(F.desc("count"), F.asc("segment")))


# --------------------------------------------------------------------------
# Product metrics
# --------------------------------------------------------------------------

def _with_sales(products: DataFrame, orders: DataFrame, *sales: F.Column) -> tuple[DataFrame, F.Column]:
    """Products left-joined with aggregates of their orders (0 without
    orders), and the largest ``times_ordered`` (at least 1) as a scalar
    subquery.

    The subquery reads whole rows of the same plan, so its exchanges are those
    of the rows: catalogue and orders are cleaned and shuffled once
    (``ReusedExchange``), without a checkpoint or a job while the plan is
    built.
    """
    totals = orders.groupBy("product_id").agg(F.count("order_id").alias("times_ordered"), *sales)
    new = [c for c in totals.columns if c != "product_id"]
    joined = products.join(totals, "product_id", "left").fillna(0, new)
    # The first field decides; the others keep the columns of the plan alike.
    whole = F.struct("times_ordered", *[c for c in joined.columns if c != "times_ordered"])
    most = joined.select(F.max(whole)["times_ordered"].alias("n")).scalar()
    return joined, F.greatest(F.coalesce(most, F.lit(0)), F.lit(1))


def product_popularity(products: DataFrame, orders: DataFrame) -> DataFrame:
    """Products with ``times_ordered`` and ``popularity_score`` (percent of the
    most ordered product)."""
    joined, most = _with_sales(products, orders)
    return joined.withColumn("popularity_score", round_ratio("times_ordered", most, 2, 100))


def product_metrics(products: DataFrame, orders: DataFrame) -> DataFrame:
    """Products extended with sales counts, popularity, simulated cost and
    margin, and inventory turnover.

    The cost factor 0.6 + 0.2 u draws u from the product id (reproducible),
    and all roundings are exact on cents.
    """
    joined, most = _with_sales(products, orders,
                               F.sum("quantity").cast("long").alias("total_quantity_sold"),
                               sum_money("total_amount").alias("total_revenue"))
    price_c = cents("unit_price")
    # cost = price * (0.6 + 0.2 u / steps) = price * (3 steps + u) / (5 steps),
    # u in [0, steps): exact cents.
    cost_c = half_up_div(price_c * (F.lit(3 * COST_STEPS) + draw_below("product_id", COST_SALT, COST_STEPS)),
                         F.lit(5 * COST_STEPS))
    return (joined
            .withColumn("popularity_score", round_ratio("times_ordered", most, 2, 100))
            .withColumn("_cost_c", cost_c)
            .withColumn("estimated_cost", F.col("_cost_c") / F.lit(100.0))
            .withColumn("profit_margin",
                        round_ratio(price_c - F.col("_cost_c"), price_c, 2, 100))
            .withColumn("inventory_turnover",
                        round_ratio("total_quantity_sold",
                                    F.greatest("stock_quantity", F.lit(1)), 2))
            .drop("_cost_c"))


def top_products(popularity: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    """The k most popular products of :func:`product_popularity` or
    :func:`product_metrics`; ties by product_id (TakeOrderedAndProject: each
    task keeps its own top k, the driver merges k x tasks rows)."""
    return (popularity
            .select("product_id", "product_name", "category", "popularity_score",
                    "times_ordered")
            .orderBy(F.desc("popularity_score"), F.asc("product_id"))
            .limit(k))


# --------------------------------------------------------------------------
# Daily metrics
# --------------------------------------------------------------------------

def daily_metrics(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Per product x day x category: quantity, revenue, orders, average
    order value and profit (30% of unrounded revenue, then rounded).
    A null category (product missing from the catalogue) is its own group.

    The category depends on the product alone (one catalogue row per
    product), so orders are aggregated per (product, day) first -- with
    map-side partial aggregation -- and only the aggregate is joined with
    the catalogue: the join sees one row per product-day, not per order.
    """
    per_day = (orders.groupBy("product_id", "order_date").agg(
        F.sum("quantity").cast("long").alias("quantity_sold"),
        F.sum(cents("total_amount")).alias("_revenue_c"),
        F.count("order_id").alias("num_orders"),
        F.count("total_amount").alias("_n_amount")))
    enriched = per_day.join(products.select("product_id", "category"), "product_id", "left")
    revenue_c = F.col("_revenue_c")
    avg_c = half_up_div(revenue_c, F.col("_n_amount"))
    return enriched.select(
        "product_id", "order_date", "category", "quantity_sold",
        (revenue_c / F.lit(100.0)).alias("revenue"),
        "num_orders",
        F.when(F.col("_n_amount") > 0, avg_c / F.lit(100.0)).alias("avg_order_value"),
        (half_up_div(revenue_c * PROFIT_RATE_TENTHS, F.lit(10)) / F.lit(100.0)).alias("profit"))
