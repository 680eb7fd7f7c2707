"""Skewed joins, ranks by bounds, narrow dedup, draws, splits of hot
directories, counted reads, shared exchanges."""

import datetime as dt
import decimal
import hashlib
import math
import pathlib
import re
import uuid

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera import schemas
from tessera.functions.hashing import numbers, split_draw
from tessera.operators.clean import dedup_by_key, row_digest
from tessera.operators.joins import skew_join
from tessera.operators.windows import rank_within
from tessera.plans import retail as R
from tessera.plans import sales, silver
from tessera.queries.retail import cleaned
from tessera.sinks.files import write_parquet
from tessera.sources import adapters as A

from .conftest import SF_CHECK, SF_SMALL


@pytest.fixture
def conf(spark):
    """Settings for one test."""
    old = {}

    def put(key, value):
        old.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)
    yield put
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def jobs_of(spark, build):
    """(result of build, number of jobs it ran)."""
    group = f"probe-{uuid.uuid4().hex}"       # an id() may be that of an earlier function
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = build()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def final_plan(df):
    """The adaptive plan after running it, without the initial plans."""
    df.collect()
    kept, skip = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(line) - len(line.lstrip(" :"))
        if skip is not None and depth > skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            kept.append(line)
    return "\n".join(kept)


# ---- skew_join

def key_rows(spark, counts, value):
    """A frame (k, value) with the given number of equal rows per key."""
    rows = [(k, n) for k, n in counts.items()]
    return (spark.createDataFrame(rows, "k long, n int")
            .select("k", F.explode(F.sequence(F.lit(1), "n")).alias("i")).select("k", F.lit(1).alias(value)).repartition(8))


SIDES = {
    "left": ({1: 500, 2: 3, 3: 1, None: 4}, {1: 2, 2: 2, 9: 1, None: 2}),
    "left_alone": ({1: 500, 2: 3}, {2: 2, 9: 1}),
    "right": ({1: 2, 2: 2, 9: 1, None: 2}, {1: 500, 2: 3, 3: 1, None: 4}),
    "right_alone": ({2: 2, 9: 1}, {1: 500, 2: 3}),
    "both": ({1: 120, 2: 90, 4: 300, None: 200}, {1: 110, 2: 2, 5: 400, None: 300}),
    "none": ({1: 2, 2: 2, None: 1}, {2: 1, 3: 1, None: 1}),
}


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("side", sorted(SIDES))
def test_skew_join_splits_either_side(spark, how, side):
    left, right = key_rows(spark, SIDES[side][0], "lv"), key_rows(spark, SIDES[side][1], "rv")
    count = lambda df: sorted(map(tuple, df.groupBy("k", "lv", "rv").count().collect()), key=str)
    assert count(skew_join(left, right, "k", how, hot_rows=40)) == count(left.join(right, "k", how))


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_no_task_of_a_skew_join_gets_a_hot_key(spark, conf, how):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "96")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    counts = {7: 8000, None: 8000}
    few = {7: 1, None: 1}
    left = key_rows(spark, counts if how != "right" else few, "lv")
    right = key_rows(spark, counts if how != "left" else few, "rv")
    if how == "full":                       # one hot key on each side, nulls on both
        right = key_rows(spark, {8: 8000, None: 8000}, "rv")
    out = skew_join(left, right, "k", how, hot_rows=1000)
    tasks = out.groupBy("k", F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in tasks) <= 2000
    assert sum(r["count"] for r in tasks) == left.join(right, "k", how).count()


def test_skew_join_without_hot_keys_numbers_nothing(spark):
    left, right = key_rows(spark, {1: 30, 2: 4}, "lv"), key_rows(spark, {1: 3, 3: 4}, "rv")
    p = final_plan(skew_join(left, right, "k", "full", hot_rows=40))
    assert "monotonically_increasing_id" not in p
    assert "monotonically_increasing_id" in final_plan(skew_join(left, right, "k", "full", hot_rows=10))


def test_skew_join_names_clashing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "k long, v int")
    with pytest.raises(ValueError, match="both sides"):
        skew_join(df, df, "k")


# ---- rank_within by bounds

RANKED = {
    "long": lambda i: F.when(i % 13 > 0, (i * 7919) % 501 - 250),
    "hot": lambda i: F.when(i % 3 == 0, F.lit(5)).when(i % 3 == 1, (i * 31) % 700),
    "double": lambda i: F.when(i % 11 == 0, F.lit(float("nan"))).when(i % 7 > 0, ((i * 7919) % 977) / F.lit(8.0) - 40),
    "zero": lambda i: F.when(i % 2 == 0, F.lit(-0.0)).otherwise(F.lit(0.0)),
    "decimal": lambda i: ((i * 17) % 333).cast("decimal(12,3)") / 7,
    "date": lambda i: F.date_add(F.lit(dt.date(2024, 1, 1)), ((i * 37) % 300).cast("int")),
    "timestamp": lambda i: F.timestamp_seconds((i * 911) % 4000),
    "null": lambda i: F.lit(None).cast("int"),
    "string": lambda i: ((i * 37) % 300).cast("string"),
}


@pytest.mark.parametrize("kind, method", [(kind, "rank") for kind in sorted(RANKED)]
                         + [(kind, "dense_rank") for kind in ("double", "hot", "long", "null")])
def test_rank_by_bounds_equals_the_window(spark, kind, method):
    i = F.col("id")
    df = spark.range(4000).select("id", F.when(i % 17 > 0, F.when(i % 10 < 7, 0).otherwise(i % 5)).alias("g"),
                                  RANKED[kind](i).alias("v"))
    fn = {"rank": F.rank, "dense_rank": F.dense_rank}[method]
    for descending in (True, False):
        order = F.desc("v") if descending else F.asc("v")
        want = {r.id: r.r for r in df.select("id", fn().over(Window.partitionBy("g").orderBy(order)).alias("r")).collect()}
        for hot_rows, chunks in ((500, 16), (0, 3), (10**6, None)) if kind == "long" else ((500, 16),):
            got = rank_within(df, "g", "v", descending=descending, method=method, name="r", chunks=chunks, hot_rows=hot_rows)
            assert {r.id: r.r for r in got.collect()} == want and got.columns == ["id", "g", "v", "r"]


def test_rank_by_bounds_runs_no_job_and_shuffles_once(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), (F.col("id") % 1000).alias("v"), F.col("id").cast("string").alias("w"))
    out, jobs = jobs_of(spark, lambda: rank_within(df, "g", "v", name="r", chunks=8))
    assert jobs == 0
    text = out._jdf.queryExecution().explainString(
        spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    wide = [m for m in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", text) if "w#" in m]
    assert len(wide) == 1


def test_hot_values_are_not_shuffled(spark, conf):
    # Half of the rows have one value: no task of the window sees them.
    conf("spark.sql.adaptive.enabled", "false")
    df = spark.range(8000).select(F.lit(1).alias("g"), F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("v"))
    out = rank_within(df, "g", "v", name="r", chunks=16)
    per_task = out.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_task) <= 8000 / 4


# ---- dedup

ORDERS = [(k, c, p, q, dt.date(2024, 1, 1 + d), "s", m, float(a), 0.0, 0.0)
          for k in range(40) for c, p, q, d, m, a in
          [(1, k % 3, 2, k % 5, "x", 5), (1, k % 3, 2, k % 5, "y", 5), (2, 9, 1, 3, None, 7), (None, 0, 0, 0, "z", 1)]]


def test_digest_dedup_has_one_survivor_whatever_is_used(spark):
    df = spark.createDataFrame(ORDERS, schemas.ORDERS)
    whole = {r.order_id: r for r in R.clean_orders(df).collect()}
    for parts in (1, 7):
        some = R.clean_orders(df.repartition(parts)).select("order_id", "payment_method").collect()
        assert {r.order_id: r.payment_method for r in some} == {k: r.payment_method for k, r in whole.items()}
    # By hand: smallest (product, quantity), then the digest of the row.
    tagged = df.withColumn("d", row_digest(df)).where("customer_id is not null").collect()
    for k, r in whole.items():
        best = min((t for t in tagged if t.order_id == k), key=lambda t: (t.product_id, t.quantity, t.d))
        assert tuple(best)[:-1] == tuple(r)
    assert len(whole) == 40 and {r.payment_method for r in whole.values()} == {"x", "y"}


def test_row_digest_tells_nulls_apart(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (None, None), (1, 1)], "a int, b int")
    assert df.select(row_digest(df)).distinct().count() == 4


def test_dedup_by_a_unique_order(spark):
    df = spark.createDataFrame([(1, 5, {"a": 1}), (1, 3, {"b": 2}), (2, None, None), (2, 1, {})], "k int, o int, m map<string,int>")
    got = {r.k: (r.o, r.m) for r in dedup_by_key(df, ["k"], ["o"], ties="none").collect()}
    assert got == {1: (3, {"b": 2}), 2: (None, None)}
    for bad in (lambda: dedup_by_key(df, ["k"], ties="none"), lambda: dedup_by_key(df, ["k"], ["o"], ties="digest"),
                lambda: dedup_by_key(df, ["k"], ["o"], ties="x")):
        with pytest.raises(ValueError):
            bad()


def test_join_lookup_shuffles_four_columns(spark, registry, conf):
    conf("spark.sql.adaptive.enabled", "false")
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = registry["join_lookup"].fn(spark, SF_CHECK)._jdf.queryExecution().explainString(mode)
    exchanges = re.findall(r"\) Exchange\nInput \[(\d+)\]: \[(.*?)\]\nArguments: hashpartitioning\(order_id", text)
    assert [int(n) for n, _ in exchanges] == [4]
    assert {c.split("#")[0] for c in exchanges[0][1].split(", ")} == {"order_id", "product_id", "quantity", "_digest"}


# ---- draws

def test_numbers_are_halves_of_digests(spark):
    rows = spark.range(50).select("id", *[c.alias(f"n{i}") for i, c in enumerate(numbers("id", 3, salt=4))]).collect()
    for r in rows:
        first, second = (hashlib.md5(f"{r.id}:{s}".encode()).hexdigest() for s in (4, 5))
        assert (r.n0, r.n1, r.n2) == (int(first[:15], 16), int(first[16:31], 16), int(second[:15], 16))


def test_split_draws_are_even_and_independent(spark):
    a, b, c = split_draw(F.col("n"), 5, F.lit(7), 100_000)
    df = spark.range(70_000).select(numbers("id", 1)[0].alias("n")).select(a.alias("a"), b.alias("b"), c.alias("c"))
    cells = df.groupBy("a", "b").count().collect()
    assert len(cells) == 35
    chi = sum((r["count"] - 2000) ** 2 / 2000 for r in cells)
    assert chi < 34 + 5 * math.sqrt(2 * 34)
    r = df.agg(F.avg("c").alias("m"), F.corr("a", "c").alias("r"), F.min("c").alias("lo"), F.max("c").alias("hi")).first()
    assert abs(r.m - 50_000) < 600 and abs(r.r) < 0.02 and r.lo >= 0 and r.hi < 100_000


def test_generated_orders_need_two_digests_and_no_job(spark, registry, conf):
    conf("spark.sql.adaptive.enabled", "false")
    df, jobs = jobs_of(spark, lambda: registry["gen_orders"].fn(spark, SF_SMALL))
    assert jobs == 1                                    # the schema of the table with the ids
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("md5(") == 4                      # four numbers of two digests, each written once
    twice = df.groupBy("order_id").count().where("count > 1").count()
    assert twice < 50


# ---- writes

def test_equal_rows_of_one_day_are_written_by_several_tasks(spark, tmp_path, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")     # the rows are small, too
    df = spark.range(100_000).select(F.lit("2024-01-01").alias("day"), F.lit(1).alias("v"))
    write_parquet(df, str(tmp_path / "a"), partition_by=["day"])
    assert len(list(pathlib.Path(tmp_path / "a" / "day=2024-01-01").glob("*.parquet"))) > 2
    write_parquet(df, str(tmp_path / "b"), partition_by=["day"], rows_per_task=20_000)
    assert len(list(pathlib.Path(tmp_path / "b" / "day=2024-01-01").glob("*.parquet"))) == 5
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.columns == ["v", "day"] and back.count() == 100_000


def test_small_partition_values_are_one_file(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") % 50).alias("d"), "id")
    write_parquet(df, str(tmp_path / "t"), partition_by=["d"], rows_per_task=400)
    files = [len(list(p.glob("*.parquet"))) for p in pathlib.Path(tmp_path / "t").glob("d=*")]
    assert len(files) == 50 and sum(files) <= 50 + 5


# ---- batch job, product metrics, monthly summary

def test_batch_reports_the_rows_it_read(spark, tmp_path):
    frames = {"customers": A.customers(spark, SF_SMALL), "products": A.products(spark, SF_SMALL),
              "orders": A.orders(spark, SF_SMALL)}
    for name, df in frames.items():
        write_parquet(df, str(tmp_path / "in" / name))
    out, jobs = jobs_of(spark, lambda: silver.run_batch(spark, str(tmp_path / "in"), str(tmp_path / "out")))
    assert out.rows_read == {name: df.count() for name, df in frames.items()}
    assert set(out) == set(silver.OUTPUTS)
    reads = {n: spark.read.parquet(str(tmp_path / "in" / n)) for n in frames}
    _, plain = jobs_of(spark, lambda: silver.write_silver(
        R.clean_customers(reads["customers"]), R.clean_products(reads["products"]), R.clean_orders(reads["orders"]),
        str(tmp_path / "out2")))
    assert jobs <= plain + 3                 # one job per Parquet schema, none that counts


@pytest.mark.parametrize("name", ["product_metrics", "top_products"])
def test_catalogue_and_orders_are_cleaned_once(spark, registry, name):
    _, reads = jobs_of(spark, lambda: cleaned(spark, SF_CHECK))      # the schemas of the tables
    df, jobs = jobs_of(spark, lambda: registry[name].fn(spark, SF_CHECK))
    assert jobs == reads
    p = final_plan(df)
    assert p.count("ReusedExchange") >= 2
    assert len(re.findall(r"Scan parquet .*part\.parquet", p)) == 1 == len(re.findall(r"Scan parquet .*lineitem\.parquet", p))


def test_customer_metrics_need_hash_aggregates_only(spark, registry):
    p = final_plan(registry["customer_analytics"].fn(spark, SF_CHECK))
    assert "ObjectHashAggregate" not in p and "SortAggregate" not in p and "Expand" not in p
    assert p.count("HashAggregate") >= 3


def test_customer_metrics_of_odd_rows(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [(1, 10, d1, 1.5, "b"), (1, 11, d1, None, "a"), (1, None, None, 2.25, None), (1, 12, d2, 1.0, None),
            (2, 13, d1, None, None), (3, 14, None, -1.0, "z"), (3, 14, None, -1.0, "z"), (3, 15, d1, 0.0, "y"), (3, 16, d1, 0.0, "y")]
    df = spark.createDataFrame(rows, "customer_id long, order_id long, order_date date, total_amount double, category string")
    got = {r.customer_id: (r.lifetime_value, r.total_orders, r.active_days, r.preferred_category)
           for r in R._customer_metrics(df).collect()}
    assert got == {1: (4.75, 3, 2, "a"), 2: (None, 1, 1, None), 3: (-2.0, 4, 1, "y")}


def test_undated_sales_are_a_month_of_their_own(spark):
    raw = spark.createDataFrame([("1", "10.5", "2024-02-03"), ("2", "20", None), ("2", "5", "2024-02-31"), ("3", "x", "2024-01-01")],
                                "customer_id string, amount string, date_string string")
    got = sorted(map(tuple, sales.monthly_summary(raw).collect()), key=str)
    assert got == sorted([(None, None, 2, 25.0, 12.5, 1), (2024, 2, 1, 10.5, 10.5, 1)], key=str)
    assert decimal.Decimal(str(got[0][3])) > 0
