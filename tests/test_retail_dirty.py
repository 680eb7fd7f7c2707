"""Retail pipeline on hand-made dirty rows, expected values by hand."""

import datetime as dt

from pyspark.sql import functions as F

from tessera import schemas
from tessera.plans import retail as R

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def frames(spark):
    customers = spark.createDataFrame([
        (1, "A", "a", "a@x", "1", "c", D1, "Basic"),
        (1, "A2", "a", "a2@x", "1", "c", D1, "Basic"),      # duplicate key, 'A' survives
        (2, "B", "b", None, "2", "c", D1, "Basic"),         # null email -> dropped
        (3, "C", "c", "c@x", "3", "c", D1, "Basic"),        # no orders -> New
        (4, "D", "d", "d@x", "4", "c", D1, "Basic"),
    ], schemas.CUSTOMERS)
    products = spark.createDataFrame([
        (10, "p10", "Books", "b", 20.0, 5, True),
        (11, "p11", "Toys", "b", -10.0, 5, True),           # negative -> dropped
        (12, "p12", "Toys", "b", 0.0, 5, True),             # zero -> dropped
        (13, "p13", "Toys", "b", None, 5, True),            # null -> dropped
        (14, "p14", "Toys", "b", 10.0, 0, True),            # stock 0 -> divisor 1
    ], schemas.PRODUCTS)
    orders = spark.createDataFrame([
        (100, 1, 10, 2, D1, "s", "m", 600.0, 0.0, 0.0),
        (100, 1, 10, 9, D1, "s", "m", 999.0, 0.0, 0.0),    # duplicate id, bigger row dropped
        (101, 1, 14, 1, D2, "s", "m", 500.0, 0.0, 0.0),
        (102, 1, 14, 1, D2, "s", "m", 0.05, 0.0, 0.0),
        (103, None, 10, 1, D1, "s", "m", 50.0, 0.0, 0.0),   # no customer -> dropped
        (104, 4, 11, 3, D1, "s", "m", 80.0, 0.0, 0.0),      # product cleaned away
    ], schemas.ORDERS)
    return (R.clean_customers(customers), R.clean_products(products),
            R.clean_orders(orders))


def test_cleaning(spark):
    c, p, o = frames(spark)
    assert sorted((r.customer_id, r.first_name) for r in c.collect()) == [(1, "A"), (3, "C"), (4, "D")]
    assert sorted(r.product_id for r in p.collect()) == [10, 14]
    assert sorted((r.order_id, r.quantity) for r in o.collect()) == [(100, 2), (101, 1), (102, 1), (104, 3)]


def test_customer_analytics(spark):
    c, p, o = frames(spark)
    out = {r.customer_id: r for r in R.customer_analytics(c, o, p).collect()}
    a = out[1]
    assert a.lifetime_value == 1100.05 and a.total_orders == 3 and a.active_days == 2
    assert a.activity_score == 1.5 and a.segment == "Premium"
    assert a.preferred_category == "Toys"              # 2 Toys rows vs 1 Books
    assert out[3].segment == "New" and out[3].lifetime_value == 0.0
    assert out[3].preferred_category == "Unknown" and out[3].total_orders == 0
    d = out[4]                                          # only a dangling product
    assert d.segment == "Bronze" and d.preferred_category == "Unknown"


def test_product_metrics(spark):
    c, p, o = frames(spark)
    out = {r.product_id: r for r in R.product_metrics(p, o).collect()}
    assert out[10].times_ordered == 1 and out[14].times_ordered == 2
    assert out[14].popularity_score == 100.0 and out[10].popularity_score == 50.0
    assert out[14].inventory_turnover == 2.0            # 2 / greatest(0, 1)
    assert out[10].inventory_turnover == 0.4            # 2 / 5
    for r in out.values():
        assert 0.6 * r.unit_price - 0.005 <= r.estimated_cost <= 0.8 * r.unit_price + 0.005
        assert 20.0 - 0.005 <= r.profit_margin <= 40.0 + 0.005


def test_daily_metrics(spark):
    c, p, o = frames(spark)
    rows = {(r.product_id, r.order_date): r for r in R.daily_metrics(o, p).collect()}
    r = rows[(14, D2)]
    assert (r.quantity_sold, r.num_orders, r.revenue) == (2, 2, 500.05)
    assert r.avg_order_value == 250.03                  # 250.025 rounds half up
    assert r.profit == 150.02                           # 150.015 -> 150.02
    assert rows[(11, D1)].category is None              # dangling product keeps its group


def test_quality_report_counts_null_key_group(spark):
    from tessera.operators.clean import dedup_by_key, quality_report
    df = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c"), (1, "d"), (2, None)],
                               "k int, v string")
    keep = F.col("v").isNotNull()
    r = quality_report("x", df, keep, "k").first()
    assert r.final_count == dedup_by_key(df.where(keep), ["k"]).count() == 2
    assert (r.initial_count, r.after_filter, r.removed) == (5, 4, 3)
