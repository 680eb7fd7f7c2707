"""Plan shape: broadcasts only where bounded, pushdown, top-k, partial
aggregation, no Python in the hot path."""

import pathlib
import re

import pytest

from .conftest import SF_CHECK


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bounded_broadcast(spark, registry):
    p = plan(registry["join_broadcast"].fn(spark, SF_CHECK))
    assert "BroadcastHashJoin" in p


def test_filter_pushed_to_scan(spark, registry):
    p = plan(registry["flt_cmp"].fn(spark, SF_CHECK))
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThan(c_acctbal,3000.0)]" in p


def test_column_pruning(spark, registry):
    p = plan(registry["prj_select"].fn(spark, SF_CHECK))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in p


def test_top_k_is_take_ordered(spark, registry):
    assert "TakeOrderedAndProject" in plan(registry["top_k"].fn(spark, SF_CHECK))


def test_dedup_aggregates_map_side(spark, registry):
    p = plan(registry["clean_orders"].fn(spark, SF_CHECK))
    assert p.count("WindowGroupLimit") == 2      # one of them before the shuffle


def test_partition_pruning(spark, tmp_path):
    from pyspark.sql import functions as F
    from tessera.sinks.files import write_parquet
    df = spark.range(100).withColumn("d", (F.col("id") % 5).cast("int"))
    write_parquet(df, str(tmp_path / "t"), partition_by=["d"])
    p = plan(spark.read.parquet(str(tmp_path / "t")).where("d = 3"))
    assert re.search(r"PartitionFilters: \[.*\(d#\d+ = 3\)\]", p)


@pytest.mark.parametrize("name", ["customer_analytics", "product_metrics", "daily_metrics",
                                  "word_count_ws", "quotes_clean", "sales_trend",
                                  "monthly_summary", "gen_orders", "sql_rank"])
def test_no_python_udf(spark, registry, name):
    p = plan(registry[name].fn(spark, SF_CHECK))
    assert "EvalPython" not in p and "PythonUDF" not in p


def test_library_never_collects():
    root = pathlib.Path(__file__).resolve().parents[1] / "tessera"
    bad = []
    for f in root.rglob("*.py"):
        if "llm" in f.parts:        # bounded samples are collected there
            continue
        text = f.read_text()
        for token in (".collect(", ".toPandas(", ".rdd", "localCheckpoint"):
            if token in text:
                bad.append((f.name, token))
    assert bad == []


def test_product_metrics_takes_its_maximum_from_the_same_plan(spark, registry):
    # The global max is a scalar subquery over whole rows of the plan that the
    # rows come from (tests/test_scale.py counts the scans that are run).
    p = plan(registry["product_metrics"].fn(spark, SF_CHECK))
    assert "Subquery" in p and "ExistingRDD" not in p


def test_sql_rank_is_chunked(spark, registry):
    p = plan(registry["sql_rank"].fn(spark, SF_CHECK))
    assert "_chunk" in p
    assert not re.search(r"Window \[rank\([^\]]*\]\s*,\s*\[c_mktsegment#\d+\]", p)


def test_daily_metrics_aggregates_before_join(spark, registry):
    p = plan(registry["daily_metrics"].fn(spark, SF_CHECK))
    join_at = min(i for i in (p.find("BroadcastHashJoin"), p.find("SortMergeJoin")) if i >= 0)
    # The final aggregate over (product_id, order_date) sits below the join.
    assert "keys=[product_id" in p[join_at:]
