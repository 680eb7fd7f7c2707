"""Operator behaviour: sort order, chunked rank under skew, dedup survivor,
hash sampling, sinks (JDBC through embedded Derby), generators."""


import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.clean import dedup_by_key
from tessera.operators.layout import persisted
from tessera.operators.sample import sample_by_hash, split_by_hash
from tessera.operators.windows import rank_within
from tessera.plans import synth
from tessera.sinks.files import write_csv, write_parquet
from tessera.sinks.jdbc import publish, write_jdbc

from .conftest import SF_SMALL


def test_sorts_are_ordered(spark, registry):
    r = [x.c_acctbal for x in registry["srt_desc"].fn(spark, SF_SMALL).collect()]
    assert r == sorted(r, reverse=True)
    e = [x.email for x in registry["srt_asc"].fn(spark, SF_SMALL).collect()]
    nulls = [x for x in e if x is None]
    assert e[:len(nulls)] == nulls and e[len(nulls):] == sorted(e[len(nulls):])
    e = [x.email for x in registry["srt_nulls"].fn(spark, SF_SMALL).collect()]
    assert e[-1] is None and e[0] is not None
    m = [(x.c_mktsegment, -x.c_acctbal) for x in registry["srt_multi"].fn(spark, SF_SMALL).collect()]
    assert m == sorted(m)


@pytest.mark.parametrize("method", ["rank", "dense_rank", "row_number"])
def test_rank_within_equals_window_under_skew(spark, method):
    # Group 0 holds ~90% of the rows, values repeat (ties).
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(F.lit(0)).alias("g"),
        (F.col("id") % 997).alias("v"), F.col("id"))
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    w = Window.partitionBy("g").orderBy(F.desc("v"), F.asc("id"))
    if method != "row_number":
        w = Window.partitionBy("g").orderBy(F.desc("v"))
    want = {r.id: r.r for r in df.select("id", fn().over(w).alias("r")).collect()}
    got_df = rank_within(df, "g", "v", method=method, name="r", chunks=16,
                         tiebreak="id" if method == "row_number" else None)
    got = {r.id: r.r for r in got_df.collect()}
    assert got == want
    # The hot group really was split over several chunks.
    chunks = (df.repartitionByRange(16, "g", F.desc("v"))
              .where("g = 0").select(F.spark_partition_id()).distinct().count())
    assert chunks > 4


@pytest.mark.parametrize("method", ["rank", "dense_rank", "row_number"])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_within_hot_value(spark, method, descending):
    # One (group, value) pair holds half the rows: it is cut across chunks.
    df = spark.range(6000).select(
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 2 == 0, F.lit(50)).otherwise(F.col("id") % 101).alias("v"),
        F.col("id"))
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    o = F.desc("v") if descending else F.asc("v")
    w = Window.partitionBy("g").orderBy(o, F.asc("id")) if method == "row_number" else \
        Window.partitionBy("g").orderBy(o)
    want = {r.id: r.r for r in df.select("id", fn().over(w).alias("r")).collect()}
    got = {r.id: r.r for r in rank_within(df, "g", "v", method=method, name="r", chunks=24,
                                          descending=descending,
                                          tiebreak="id" if method == "row_number" else None
                                          ).collect()}
    assert got == want


def test_dedup_survivor_is_smallest(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (1, None, 5), (2, "z", 1)],
                               "k int, s string, n int")
    out = {r.k: (r.s, r.n) for r in dedup_by_key(df, ["k"], order=["n"]).collect()}
    assert out == {1: ("b", 2), 2: ("z", 1)}
    out = {r.k: (r.s, r.n) for r in dedup_by_key(df, ["k"]).collect()}
    assert out[1] == (None, 5)   # nulls first


def test_hash_sample_and_split(spark):
    df = spark.range(100000)
    n = sample_by_hash(df, "id", 0.1).count()
    assert abs(n - 10000) < 500
    parts = split_by_hash(df, "id", [0.8, 0.2])
    assert abs(parts[0].count() - 80000) < 700 and sum(p.count() for p in parts) == 100000


def test_partitioned_write_files(spark, tmp_path):
    df = spark.range(5000).withColumn("d", (F.col("id") % 3).cast("int"))
    write_parquet(df, str(tmp_path / "p"), partition_by=["d"])
    dirs = sorted(p.name for p in (tmp_path / "p").iterdir() if p.name.startswith("d="))
    assert dirs == ["d=0", "d=1", "d=2"]
    assert spark.read.parquet(str(tmp_path / "p")).count() == 5000


def test_single_file_write(spark, tmp_path):
    write_csv(spark.range(1000).repartition(5), str(tmp_path / "c"), num_files=1)
    assert len(list((tmp_path / "c").glob("part-*.csv"))) == 1


def test_jdbc_roundtrip_embedded_derby(spark, tmp_path):
    # In-process Derby: no server, no port.  On a cluster the URL points at
    # a real database every executor can reach.
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    df = spark.range(25).withColumn("name", F.concat(F.lit("n"), F.col("id").cast("string")))
    write_jdbc(df, url, "NATIONS", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    back = spark.read.jdbc(url, "NATIONS", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    assert back.count() == 25
    assert publish(df, {"url": url}, "table_missing") is False


def test_persisted_releases(spark):
    df = spark.range(10)
    with persisted(df):
        assert df.storageLevel.useDisk
    assert not df.storageLevel.useMemory


def test_generators(spark):
    n = 20000
    c = synth.generate_customers(synth.ids(spark, 10000), "2024-12-31")
    o = synth.generate_orders(synth.ids(spark, n), 10000, 1000, "2024-12-31")
    p = synth.generate_products(synth.ids(spark, 1000))
    assert c.count() == 10000 and p.count() == 1000
    stats = o.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("order_id").alias("ids"),
                  F.min("quantity"), F.max("quantity"), F.min("total_amount"),
                  F.max("total_amount"), F.max("customer_id"), F.max("product_id")).first()
    assert n < stats.rows < n * 1.003 and stats.ids == n
    assert (stats[2], stats[3]) == (1, 5)
    assert 10.0 <= stats[4] and stats[5] <= 505.0
    assert stats[6] <= 10000 and stats[7] <= 1000
    assert set(r.city for r in c.select("city").distinct().collect()) == set(synth.CITIES)


def test_read_entity_fails_fast(spark, tmp_path):
    from tessera.sources.files import EntityReadError, read_entity
    with pytest.raises(EntityReadError, match="customers"):
        read_entity(spark, str(tmp_path / "missing"), "customers")
    spark.range(3).write.parquet(str(tmp_path / "ok"))
    with pytest.raises(EntityReadError, match="lacks columns"):
        read_entity(spark, str(tmp_path / "ok"), "customers", required=["id", "email"])
    assert read_entity(spark, str(tmp_path / "ok"), "ids", required=["id"]).count() == 3


def test_as_of_makes_dates_repeatable(spark):
    import datetime as dt
    from tessera.functions.dates import as_of_date, days_since
    df = spark.createDataFrame([(dt.date(2024, 12, 1),)], "d date")
    assert df.select(days_since("d", "2024-12-31")).first()[0] == 30
    assert df.select(as_of_date()).first()[0] == dt.date.today()


def test_sorted_list_equals_collect_list(spark):
    from tessera.operators.aggregate import sorted_list
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, "z")] +
                               [(3, "x")] * 500, "g int, v string")
    want = {r.g: r.l for r in df.groupBy("g").agg(F.array_sort(F.collect_list("v")).alias("l")).collect()}
    got = {r.g: r.l for r in sorted_list(df, "g", "v", "l").collect()}
    assert got == want


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_skew_join_equals_join(spark, how):
    from tessera.operators.joins import skew_join
    # Key 0 holds 90% of the left rows; key 7 is hot without right rows.
    left = spark.range(5000).select(
        F.when(F.col("id") % 10 < 8, F.lit(0)).when(F.col("id") % 10 == 8, F.lit(7))
         .otherwise(F.col("id") % 50 + 100).alias("k"), F.col("id").alias("lv"))
    right = spark.range(300).select((F.col("id") % 150).alias("k"), (F.col("id") * 2).alias("rv"))
    want = sorted(map(tuple, left.join(right, "k", how).select("k", "lv", "rv").collect()),
                  key=str)
    got_df = skew_join(left, right, "k", how, hot_rows=100)
    got = sorted(map(tuple, got_df.select("k", "lv", "rv").collect()), key=str)
    assert got == want


@pytest.mark.parametrize("method", ["rank", "dense_rank", "row_number"])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_within_nulls(spark, method, descending):
    # A third of the rows have a null value; nulls tie and may span chunks.
    df = spark.range(3000).select(
        (F.col("id") % 2).alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("long")).otherwise(F.col("id") % 37).alias("v"),
        F.col("id"))
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    o = F.desc("v") if descending else F.asc("v")
    w = Window.partitionBy("g").orderBy(o, F.asc("id")) if method == "row_number" else \
        Window.partitionBy("g").orderBy(o)
    want = {r.id: r.r for r in df.select("id", fn().over(w).alias("r")).collect()}
    got = {r.id: r.r for r in rank_within(df, "g", "v", method=method, name="r", chunks=20,
                                          descending=descending,
                                          tiebreak="id" if method == "row_number" else None
                                          ).collect()}
    assert got == want
