"""Same rows at shuffle width 1 and 8, and on a rerun."""

import collections

import pytest

from .conftest import SF_SMALL

NAMES = ["clean_orders", "customer_analytics", "product_metrics", "daily_metrics",
         "quotes_clean", "sales_trend", "sql_rank", "gen_orders", "agg_first_last",
         "word_count_ws", "agg_collect_list", "win_lag_lead", "monthly_summary",
         "region_sales", "json_purchase_totals", "prf_describe", "smp_split_hash",
         "gen_customers", "cln_dedup_key", "top_products", "quotes_quote_tags",
         "join_full", "quality_report", "sql_rank_window", "agg_pivot_auto"]


def rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_any_width(spark, registry, name):
    q = registry[name]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        one = rows(q.fn(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    eight = rows(q.fn(spark, SF_SMALL))
    assert one == eight
