"""Null groups and keys, empty inputs, values past 32 bits, equal rows, and
the settings that a cluster must give."""

import datetime as dt

import pytest
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from tessera import schemas, session
from tessera.functions import avg_money, half_up_div, hash_unit
from tessera.functions.hashing import HASH_RANGE, draw, draw_below
from tessera.operators.clean import quality_report
from tessera.operators.joins import lookup_join, skew_join
from tessera.operators.sample import sample_by_hash, split_by_hash
from tessera.operators.windows import rank_within
from tessera.plans import sales, silver, synth
from tessera.plans import retail as R
from tessera.plans.text import word_count_whitespace
from tessera.sources.files import EntityReadError, read_entity, read_json


@pytest.mark.parametrize("method", ["rank", "dense_rank", "row_number"])
@pytest.mark.parametrize("chunks", [1, 7])
def test_rank_within_keeps_null_groups(spark, method, chunks):
    df = spark.range(400).select(F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("g"),
                                 F.when(F.col("id") % 7 > 0, F.col("id") % 11).alias("v"), "id")
    order = [F.desc("v"), F.asc("id")] if method == "row_number" else [F.desc("v")]
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    want = {r.id: r.r for r in df.select("id", fn().over(Window.partitionBy("g").orderBy(*order)).alias("r")).collect()}
    out = rank_within(df, "g", "v", method=method, name="r", chunks=chunks, tiebreak="id" if method == "row_number" else None)
    assert {r.id: r.r for r in out.collect()} == want
    assert dict(out.dtypes)["r"] == "bigint"
    assert rank_within(df.limit(0), "g", "v", method=method, name="r").count() == 0


def test_rank_within_cuts_runs_of_equal_rows(spark):
    df = spark.range(3000).select(F.lit(1).alias("g"), F.lit(5).alias("v"))
    out = rank_within(df, "g", "v", method="row_number", name="r", chunks=8)
    assert sorted(r.r for r in out.collect()) == list(range(1, 3001))
    assert out.select(F.spark_partition_id()).distinct().count() > 1


def test_split_keeps_every_row(spark):
    df = spark.createDataFrame([(i,) for i in range(500)] + [(None,)] * 7, "k long")
    parts = split_by_hash(df, "k", [0.5, 0.3, 0.2], salt=1)
    as_column = split_by_hash(df, "k", [0.5, 0.3, 0.2], salt=1, column="part")
    assert [p.count() for p in parts] == [as_column.where(F.col("part") == i).count() for i in range(3)]
    assert sum(p.count() for p in parts) == 507 and parts[2].where("k is null").count() == 7


def test_samples_have_no_period_and_no_floor(spark):
    ids = spark.range(10_000_000)
    assert 1 <= sample_by_hash(ids, "id", 1e-6, salt=3).count() <= 30
    even = spark.range(0, 10_000 * 20_000, 10_000)
    for salt in (0, 5000):
        assert abs(sample_by_hash(even, "id", 0.1, salt).count() - 2000) < 250
    a, b = (sample_by_hash(spark.range(20_000), "id", 0.1, salt) for salt in (1, 2))
    assert a.intersect(b).count() < 320                       # independent: about 200
    assert sample_by_hash(even, "id", 1.0).count() == 20_000


def test_draws_past_32_bits(spark):
    df = spark.createDataFrame([(5,), (5 + 2**31 - 1,), (5 + 2**40,)], "id long")
    assert df.select(draw("id", 1)).distinct().count() == 3
    r = df.select(draw_below("id", 1, 2**40).alias("x"), hash_unit("id", 2).alias("u")).collect()
    assert max(x.x for x in r) > 2**31 and all(0 <= x.u < 1 for x in r) and HASH_RANGE == 2**60
    rows = synth.generate_orders(spark.createDataFrame([(7,), (7 + 2**31 - 1,)], "id long"), 10**6, 10**6, "2024-12-31")
    assert rows.select("customer_id", "product_id", "total_amount", "discount_amount").distinct().count() >= 2


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_skew_join_with_null_keys(spark, how):
    left = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id") % 4).alias("k"), (F.col("id") % 2).alias("lv"))
    right = spark.createDataFrame([(None, 1), (None, 1), (0, 2), (1, 3), (1, 3), (9, 4)], "k long, rv int")
    key = lambda d: sorted(map(tuple, d.select("k", "lv", "rv").collect()), key=str)
    got = skew_join(left, right, "k", how, hot_rows=50)
    assert key(got) == key(left.join(right, "k", how))
    assert key(skew_join(left.limit(0), right, "k", how)) == key(left.limit(0).join(right, "k", how))


def test_skew_join_deals_equal_and_null_rows(spark):
    left = spark.range(4000).select(F.lit(None).cast("long").alias("k"), F.lit(1).alias("lv")).unionAll(
        spark.range(4000).select(F.lit(3).cast("long").alias("k"), F.lit(1).alias("lv")))
    right = spark.createDataFrame([(3, 1)], "k long, rv int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = skew_join(left, right, "k", "left", hot_rows=500).groupBy("k", F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for k in (None, 3):
        assert len({r.p for r in out if r.k == k}) > 2


def test_lookup_join_hints_only_what_is_small(spark):
    fact, dim = spark.range(10).withColumnRenamed("id", "k"), spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plan = lambda n: lookup_join(fact, dim, "k", bounded_rows=n)._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" in plan(30) and "strategy=broadcast" not in plan(29)


def test_quality_report_of_nothing(spark):
    df = spark.createDataFrame([], "k int, v string")
    r = quality_report("x", df, F.col("v").isNotNull(), "k").first()
    assert (r.initial_count, r.after_filter, r.final_count, r.removed) == (0, 0, 0, 0)


def test_signed_money_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(-10.03,), (-10.12,)], "x double")
    assert df.agg(avg_money("x").alias("a")).first().a == -10.08
    ints = spark.createDataFrame([(n, d) for n in range(-15, 16) for d in (1, 2, 3, 4)], "n long, d long")
    for r in ints.select("n", "d", half_up_div("n", "d").alias("q"), F.round(F.col("n") / F.col("d"), 0).alias("w")).collect():
        assert r.q == r.w
    orders = spark.createDataFrame([(1, 1, 1, 1, dt.date(2024, 1, 1), "s", "p", x, 0.0, 0.0) for x in (-10.03, -10.12)], schemas.ORDERS)
    products = spark.createDataFrame([], schemas.PRODUCTS)
    m = R.daily_metrics(orders, products).first()
    assert (m.avg_order_value, m.revenue, m.profit) == (-10.08, -20.15, -6.05)


def test_revenue_categories_on_the_limits(spark):
    raw = spark.createDataFrame([("1", a, "2024-01-05") for a in ("1000", "1000.01", "500", "500.01", "0.5", "-1", "x")],
                                "customer_id string, amount string, date_string string")
    got = {r.amount: r.revenue_category for r in sales.enriched_sales(raw).collect()}
    assert got == {1000.0: "Medium", 1000.01: "High", 500.0: "Low", 500.01: "Medium", 0.5: "Low"}
    assert sales.monthly_summary(raw).columns == ["year", "month", "num_transactions", "total_revenue", "avg_transaction", "unique_customers"]


def test_words_split_on_unicode_space(spark):
    df = spark.createDataFrame([("A b c\x1cD 　 a",), (None,), ("",)], "text string")
    assert {r.word: r["count"] for r in word_count_whitespace(df).collect()} == {"a": 2, "b": 1, "c": 1, "d": 1}


def test_read_entity_checks_types_counts_rows_and_names_the_entity(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    spark.createDataFrame([(1, "p", "c", "b", 2.0, 3, True)] * 4, schemas.PRODUCTS).write.parquet(good)
    seen = Observation("products")
    df = read_entity(spark, good, "products", schemas.PRODUCTS, seen)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 4
    spark.read.parquet(good).withColumn("unit_price", F.col("unit_price").cast("string")).write.parquet(bad)
    with pytest.raises(EntityReadError, match="products.*other types.*unit_price"):
        read_entity(spark, bad, "products", schemas.PRODUCTS)
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "x.parquet").write_bytes(b"PAR1 no footer")
    with pytest.raises(EntityReadError, match="orders"):
        read_entity(spark, str(broken), "orders", schemas.ORDERS)


def test_json_without_schema_must_ask(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "k long, v string").write.json(str(tmp_path / "j"))
    with pytest.raises(ValueError):
        read_json(spark, str(tmp_path / "j"))
    assert read_json(spark, str(tmp_path / "j"), infer=True).dtypes == [("k", "bigint"), ("v", "string")]


def test_generate_all_and_the_batch_job(spark, tmp_path, monkeypatch):
    paths = synth.generate_all(spark, 2000, str(tmp_path / "raw"), "2024-12-31")
    counts = {k: spark.read.parquet(v).count() for k, v in paths.items()}
    assert counts["customers"] == 10_000 and counts["products"] == 1000 and 2000 <= counts["orders"] <= 2020
    published = []
    monkeypatch.setattr(silver, "publish", lambda df, config, key: published.append((config.get(key), df.count())))
    config = {"url": "x", "table_customers": "public.customers", "table_products": "public.products"}
    out = silver.run_batch(spark, str(tmp_path / "raw"), str(tmp_path / "silver"), jdbc=config)
    c, p, o = (spark.read.parquet(paths[k]) for k in ("customers", "products", "orders"))
    c, p, o = R.clean_customers(c), R.clean_products(p), R.clean_orders(o)
    want = {"orders_clean": o, "customers_analytics": R.customer_analytics(c, o, p), "products_metrics": R.product_metrics(p, o),
            "daily_metrics": R.daily_metrics(o, p)}
    for name, df in want.items():
        back = spark.read.parquet(out[name]).select(*df.columns)
        assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    assert [t for t, _ in published] == ["public.customers", "public.products", None]
    assert published[0][1] == c.count()


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())


def test_clear_scratch(spark, tmp_path):
    path = session.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    before = session._scratch_of(spark)
    assert path.startswith(before)
