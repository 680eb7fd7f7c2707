"""The driver contract in __spark_entry__.py."""

import importlib.util
from pathlib import Path

import pytest

ENTRY = Path(__file__).resolve().parents[1] / "__spark_entry__.py"


@pytest.fixture(scope="module")
def se():
    spec = importlib.util.spec_from_file_location("spark_entry", ENTRY)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_flagship(spark, se):
    df = se.entry(spark)
    assert "segment" in df.columns and "preferred_category" in df.columns
    assert df.count() > 0


def test_queries_and_oracle_keys(se):
    q, sql = se.queries(), se.oracle_sql()
    assert set(sql) <= set(q)
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and s.strip() for s in sql.values())


WRITES_OR_CHECKPOINTS = ("snk_", "src_csv", "src_json_lines", "src_json_infer", "src_json_multiline",
                         "csv_product_summary", "silver_", "product_metrics", "top_products",
                         "sql_rank", "ml_linreg_summary", "ml_linreg_simple")


def test_every_query_reads_driver_tables(spark, registry):
    # Queries plan over the driver's parquet tables, so their work grows with
    # the data.  (Writers read back files written from those tables; the
    # checkpointed and model-summary queries read the tables before that.)
    bad = []
    for name, q in sorted(registry.items()):
        if name.startswith(WRITES_OR_CHECKPOINTS):
            continue
        files = q.fn(spark, "/root/testdata/sf0.001").inputFiles()
        if not files or not all("/root/testdata/sf0.001/" in f for f in files):
            bad.append(name)
    assert bad == []
