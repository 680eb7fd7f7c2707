"""End-to-end jobs on files written from the driver tables."""

from pyspark.sql import functions as F

from tessera.plans import quotes as Q
from tessera.plans import sales as SA
from tessera.plans import silver
from tessera.queries.pipelines import raw_sales
from tessera.sinks.files import write_csv, write_parquet, write_text
from tessera.sources import adapters as A

from .conftest import SF_SMALL


def test_retail_batch_job(spark, tmp_path):
    src = tmp_path / "in"
    write_parquet(A.customers(spark, SF_SMALL), str(src / "customers"))
    write_parquet(A.products(spark, SF_SMALL), str(src / "products"))
    write_parquet(A.orders(spark, SF_SMALL), str(src / "orders"))
    paths = silver.run_batch(spark, str(src), str(tmp_path / "out"))
    ca = spark.read.parquet(paths["customers_analytics"])
    assert ca.count() == A.customers(spark, SF_SMALL).where("email is not null").count()
    assert spark.read.parquet(paths["daily_metrics"]).count() > 0
    assert "order_date" in spark.read.parquet(paths["orders_clean"]).columns


def test_quotes_job(spark, tmp_path):
    q = A.quotes(spark, SF_SMALL).withColumn("file", (F.col("page_number") / 50).cast("long"))
    docs = q.groupBy("file").agg(F.to_json(F.collect_list(F.struct(
        "quote_text", "author", "tags", "page_number", "scraped_at"))).alias("value"))
    write_text(docs, str(tmp_path / "json"), partition_by=["file"])
    paths = Q.run_quotes(spark, str(tmp_path / "json" / "file=*" / "*.txt"), str(tmp_path / "out"))
    n_clean = Q.clean_quotes(A.quotes(spark, SF_SMALL)).count()
    assert spark.read.option("header", True).option("multiLine", True).csv(paths["quotes"]).count() == n_clean
    assert spark.read.json(paths["cleaned"]).count() == n_clean


def test_monthly_summary_job(spark, tmp_path):
    write_csv(raw_sales(spark, SF_SMALL), str(tmp_path / "csv"))
    out = SA.run_monthly_summary(spark, str(tmp_path / "csv"), str(tmp_path / "summary"))
    direct = SA.monthly_summary(raw_sales(spark, SF_SMALL))
    # Undated rows are in the partition of the null year.
    assert sorted(map(tuple, out.select(*direct.columns).collect()), key=str) == \
        sorted(map(tuple, direct.collect()), key=str)
