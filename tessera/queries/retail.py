"""Retail pipeline queries (cleaning, customer / product / daily metrics)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import retail as R
from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.sources import adapters as A

# The driver's money values are line prices, far larger than the reference's
# per-order amounts, so the segment bounds are scaled (same rule).
SEGMENTS = (1_500_000.0, 1_000_000.0, 500_000.0)


def cleaned(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (R.clean_customers(A.customers(spark, sf)),
            R.clean_products(A.products(spark, sf)),
            R.clean_orders(A.orders(spark, sf)))


@register("clean_customers", S.with_retail("SELECT * FROM c_customers"))
def clean_customers(spark, sf):
    return R.clean_customers(A.customers(spark, sf))


@register("clean_products", S.with_retail("SELECT * FROM c_products"))
def clean_products(spark, sf):
    return R.clean_products(A.products(spark, sf))


@register("clean_orders", S.with_retail("SELECT * FROM c_orders"))
def clean_orders(spark, sf):
    return R.clean_orders(A.orders(spark, sf))


@register("quality_report", S.with_retail("""
SELECT 'customers' AS entity, COUNT(*) AS initial_count,
       COUNT(*) FILTER (WHERE email IS NOT NULL) AS after_filter,
       (COUNT(DISTINCT CASE WHEN email IS NOT NULL THEN customer_id END) + MAX(CASE WHEN email IS NOT NULL AND customer_id IS NULL THEN 1 ELSE 0 END)) AS final_count,
       COUNT(*) - (COUNT(DISTINCT CASE WHEN email IS NOT NULL THEN customer_id END) + MAX(CASE WHEN email IS NOT NULL AND customer_id IS NULL THEN 1 ELSE 0 END)) AS removed
FROM r_customers
UNION ALL
SELECT 'products', COUNT(*), COUNT(*) FILTER (WHERE unit_price > 0),
       (COUNT(DISTINCT CASE WHEN unit_price > 0 THEN product_id END) + MAX(CASE WHEN unit_price > 0 AND product_id IS NULL THEN 1 ELSE 0 END)),
       COUNT(*) - (COUNT(DISTINCT CASE WHEN unit_price > 0 THEN product_id END) + MAX(CASE WHEN unit_price > 0 AND product_id IS NULL THEN 1 ELSE 0 END))
FROM r_products
UNION ALL
SELECT 'orders', COUNT(*), COUNT(*) FILTER (WHERE customer_id IS NOT NULL),
       (COUNT(DISTINCT CASE WHEN customer_id IS NOT NULL THEN order_id END) + MAX(CASE WHEN customer_id IS NOT NULL AND order_id IS NULL THEN 1 ELSE 0 END)),
       COUNT(*) - (COUNT(DISTINCT CASE WHEN customer_id IS NOT NULL THEN order_id END) + MAX(CASE WHEN customer_id IS NOT NULL AND order_id IS NULL THEN 1 ELSE 0 END))
FROM r_orders"""))
def quality_report(spark, sf):
    return R.quality_reports(A.customers(spark, sf), A.products(spark, sf), A.orders(spark, sf))


CUSTOMER_ANALYTICS_CTES = [
    "enriched AS (SELECT o.customer_id, o.order_id, o.order_date, o.total_amount, p.category "
    "FROM c_orders o LEFT JOIN c_products p ON o.product_id = p.product_id)",
    f"""metrics AS (SELECT customer_id, {S.sum_money('total_amount')} AS lifetime_value,
        COUNT(order_id) AS total_orders, COUNT(DISTINCT order_date) AS active_days
        FROM c_orders GROUP BY customer_id)""",
    """pref AS (SELECT customer_id, category AS preferred_category FROM (
        SELECT customer_id, category, row_number() OVER (PARTITION BY customer_id
               ORDER BY COUNT(*) DESC, category ASC) AS rn
        FROM enriched WHERE category IS NOT NULL GROUP BY customer_id, category) WHERE rn = 1)""",
    f"""ca AS (SELECT c.*, COALESCE(m.lifetime_value, 0.0) AS lifetime_value,
        COALESCE(m.total_orders, 0) AS total_orders, COALESCE(m.active_days, 0) AS active_days,
        COALESCE(p.preferred_category, 'Unknown') AS preferred_category,
        COALESCE({S.round_ratio('m.total_orders', 'greatest(m.active_days, 1)')}, 0.0) AS activity_score,
        CASE WHEN m.customer_id IS NULL THEN 'New'
             WHEN m.lifetime_value >= {SEGMENTS[0]} THEN 'Premium'
             WHEN m.lifetime_value >= {SEGMENTS[1]} THEN 'Gold'
             WHEN m.lifetime_value >= {SEGMENTS[2]} THEN 'Silver' ELSE 'Bronze' END AS segment
        FROM c_customers c LEFT JOIN metrics m ON c.customer_id = m.customer_id
        LEFT JOIN pref p ON c.customer_id = p.customer_id)""",
]


def customer_analytics_df(spark: SparkSession, sf: str) -> DataFrame:
    c, p, o = cleaned(spark, sf)
    return R.customer_analytics(c, o, p, SEGMENTS)


@register("customer_analytics", S.with_retail("SELECT * FROM ca", *CUSTOMER_ANALYTICS_CTES),
          headline=True)
def customer_analytics(spark, sf):
    return customer_analytics_df(spark, sf)


@register("segment_distribution", S.with_retail(
    'SELECT segment, COUNT(*) AS "count" FROM ca GROUP BY segment', *CUSTOMER_ANALYTICS_CTES))
def segment_distribution(spark, sf):
    return R.segment_distribution(customer_analytics_df(spark, sf))


PRODUCT_METRICS_CTES = [
    f"""sales AS (SELECT product_id, COUNT(order_id) AS times_ordered,
        CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold,
        {S.sum_money('total_amount')} AS total_revenue FROM c_orders GROUP BY product_id)""",
    """ext AS (SELECT p.*, COALESCE(s.times_ordered, 0) AS times_ordered,
        COALESCE(s.total_quantity_sold, 0) AS total_quantity_sold,
        COALESCE(s.total_revenue, 0.0) AS total_revenue
        FROM c_products p LEFT JOIN sales s ON p.product_id = s.product_id)""",
    f"""pm0 AS (SELECT *, {S.cents('unit_price')} AS _pc,
        {S.half_up_div(f"{S.cents('unit_price')} * ({3 * R.COST_STEPS} + {S.draw_below('product_id', R.COST_SALT, R.COST_STEPS)})", str(5 * R.COST_STEPS))} AS _cc,
        (SELECT greatest(COALESCE(MAX(times_ordered), 0), 1) FROM ext) AS _mx FROM ext)""",
    f"""pm AS (SELECT product_id, product_name, category, brand, unit_price, stock_quantity,
        is_active, times_ordered, total_quantity_sold, total_revenue,
        {S.round_ratio('times_ordered', '_mx', 2, 100)} AS popularity_score,
        CAST(_cc AS DOUBLE) / 100 AS estimated_cost,
        {S.round_ratio('_pc - _cc', '_pc', 2, 100)} AS profit_margin,
        {S.round_ratio('total_quantity_sold', 'greatest(stock_quantity, 1)')} AS inventory_turnover
        FROM pm0)""",
]


def product_metrics_df(spark: SparkSession, sf: str) -> DataFrame:
    _, p, o = cleaned(spark, sf)
    return R.product_metrics(p, o)


@register("product_metrics", S.with_retail("SELECT * FROM pm", *PRODUCT_METRICS_CTES),
          headline=True)
def product_metrics(spark, sf):
    return product_metrics_df(spark, sf)


@register("top_products", S.with_retail(
    "SELECT product_id, product_name, category, popularity_score, times_ordered FROM pm "
    "ORDER BY popularity_score DESC, product_id ASC LIMIT 10", *PRODUCT_METRICS_CTES))
def top_products(spark, sf):
    _, p, o = cleaned(spark, sf)
    return R.top_products(R.product_popularity(p.select("product_id", "product_name", "category"), o))


DAILY_SQL = S.with_retail(f"""
SELECT o.product_id, o.order_date, p.category,
       CAST(SUM(o.quantity) AS BIGINT) AS quantity_sold,
       CAST(SUM({S.cents('o.total_amount')}) AS DOUBLE) / 100 AS revenue,
       COUNT(o.order_id) AS num_orders,
       CAST(round(CAST(SUM({S.cents('o.total_amount')}) AS DECIMAL(30,0)) / COUNT(o.total_amount), 0) AS DOUBLE) / 100 AS avg_order_value,
       CAST(round(CAST(SUM({S.cents('o.total_amount')}) * 3 AS DECIMAL(30,1)) * 0.1, 0) AS DOUBLE) / 100 AS profit
FROM c_orders o LEFT JOIN c_products p ON o.product_id = p.product_id
GROUP BY o.product_id, o.order_date, p.category""")


@register("daily_metrics", DAILY_SQL, headline=True)
def daily_metrics(spark, sf):
    _, p, o = cleaned(spark, sf)
    return R.daily_metrics(o, p)
