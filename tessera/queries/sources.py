"""SRC: scans.  File scans are checked by round trip: a driver table is
written to the shared scratch folder, read back with the operator, and
compared with the SQL of the source table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T_

from tessera import schemas
from tessera.operators.joins import lookup_join
from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.session import scratch_path
from tessera.sinks.files import write_csv, write_json, write_text
from tessera.sources import adapters as A
from tessera.sources.files import read_csv, read_json, read_parquet
from tessera.sources.tables import table as T

CUSTOMER_DDL = ("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING")
ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")


@register("src_csv_infer", """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name,
  c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def src_csv_infer(spark, sf):
    path = scratch_path(spark, "src_csv_infer")
    write_csv(T(spark, sf, "customer"), path)
    # Header + inferred types (an extra pass over the files).
    return read_csv(spark, path, infer=True)


@register("src_csv_options", "SELECT * FROM customer")
def src_csv_options(spark, sf):
    path = scratch_path(spark, "src_csv_options")
    write_csv(T(spark, sf, "customer"), path, sep="|", quote="'")
    return read_csv(spark, path, CUSTOMER_DDL, sep="|", quote="'")


def _two_sales_files(spark, sf, name):
    root = scratch_path(spark, name)
    o = T(spark, sf, "orders")
    hot = F.col("o_orderkey") % 2 == 0
    write_csv(o.where(hot), f"{root}/sales_2024_even")
    write_csv(o.where(~hot), f"{root}/sales_2024_odd")
    write_csv(o.limit(0), f"{root}/other_2023")
    return root


@register("src_csv_glob", "SELECT * FROM orders")
def src_csv_glob(spark, sf):
    root = _two_sales_files(spark, sf, "src_csv_glob")
    return read_csv(spark, f"{root}/sales_2024_*/*.csv", ORDERS_DDL)


@register("src_csv_multi", "SELECT * FROM orders")
def src_csv_multi(spark, sf):
    root = _two_sales_files(spark, sf, "src_csv_multi")
    return read_csv(spark, [f"{root}/sales_2024_even", f"{root}/sales_2024_odd"], ORDERS_DDL)


@register("src_json_lines", "SELECT * FROM orders")
def src_json_lines(spark, sf):
    path = scratch_path(spark, "src_json_lines")
    write_json(T(spark, sf, "orders"), path)
    return read_json(spark, path, ORDERS_DDL)


@register("src_json_infer", """SELECT c_acctbal, c_custkey, c_mktsegment, c_name,
  CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer""")
def src_json_infer(spark, sf):
    path = scratch_path(spark, "src_json_infer")
    write_json(T(spark, sf, "customer"), path)
    return read_json(spark, path, infer=True)


QUOTES_PER_FILE = 100


@register("src_json_multiline", S.with_ctes(
    "SELECT quote_text, author, array_to_string(tags, ',') AS tags, page_number, scraped_at FROM r_quotes",
    S.R_QUOTES))
def src_json_multiline(spark, sf):
    """Quotes written as one JSON array per file (100 quotes each, by page
    number, so no file grows with the data) and read back with multiLine."""
    path = scratch_path(spark, "src_json_multiline")
    q = A.quotes(spark, sf).withColumn(
        "file", (F.col("page_number") / QUOTES_PER_FILE).cast("long"))
    docs = q.groupBy("file").agg(
        F.to_json(F.collect_list(F.struct(*schemas.QUOTES.fieldNames()))).alias("value"))
    # One document per line of the array, so the files are truly multi-line.
    docs = docs.select("file", F.regexp_replace("value", r"\},\{\"quote_text\"",
                                                '},\n{"quote_text"').alias("value"))
    write_text(docs, path, partition_by=["file"])
    back = read_json(spark, f"{path}/file=*/*.txt", schemas.QUOTES, multiline=True)
    return back.select("quote_text", "author", F.array_join("tags", ",").alias("tags"),
                       "page_number", "scraped_at")


@register("src_json_strings", """SELECT event_id, user_id,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def src_json_strings(spark, sf):
    # JSON text rows -> typed columns, parsed on the executors (no RDD).
    parsed = F.from_json("props", "k BIGINT")
    return T(spark, sf, "events").select("event_id", "user_id", parsed.getField("k").alias("k"))


@register("src_parquet", "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem")
def src_parquet(spark, sf):
    path = f"{sf.rstrip('/')}/lineitem.parquet"
    return read_parquet(spark, path).select("l_orderkey", "l_partkey", "l_extendedprice")


# Fixed lookup values (small literal tables).
SEGMENT_NOTES = [("AUTOMOBILE", "cars", 1), ("BUILDING", "construction", 2),
                 ("FURNITURE", "home", 3), ("HOUSEHOLD", "home", 4), ("MACHINERY", "industry", 5)]
STATUS_LABELS = [{"status": "F", "label": "finished", "open": False},
                 {"status": "O", "label": "open", "open": True},
                 {"status": "P", "label": "partial", "open": True}]


@register("src_values", """WITH notes(c_mktsegment, note, seq) AS (VALUES
  ('AUTOMOBILE', 'cars', 1), ('BUILDING', 'construction', 2), ('FURNITURE', 'home', 3),
  ('HOUSEHOLD', 'home', 4), ('MACHINERY', 'industry', 5))
  SELECT c.c_custkey, c.c_mktsegment, n.note, CAST(n.seq AS BIGINT) AS seq
  FROM customer c LEFT JOIN notes n ON c.c_mktsegment = n.c_mktsegment""")
def src_values(spark, sf):
    notes = spark.createDataFrame(SEGMENT_NOTES, ["c_mktsegment", "note", "seq"])
    c = T(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return lookup_join(c, notes, "c_mktsegment", bounded_rows=len(SEGMENT_NOTES))


@register("src_values_schema", """WITH r(r_regionkey, code) AS (VALUES (0, 'AF'), (1, 'AM'), (2, 'AS'),
  (3, 'EU'), (4, 'ME'))
  SELECT n.n_nationkey, n.n_name, r.code FROM nation n JOIN r ON n.n_regionkey = r.r_regionkey""")
def src_values_schema(spark, sf):
    schema = T_.StructType([T_.StructField("n_regionkey", T_.IntegerType(), False),
                            T_.StructField("code", T_.StringType(), False)])
    codes = spark.createDataFrame([(0, "AF"), (1, "AM"), (2, "AS"), (3, "EU"), (4, "ME")], schema)
    n = T(spark, sf, "nation")
    return lookup_join(n, codes, "n_regionkey", "inner", bounded_rows=5).select(
        "n_nationkey", "n_name", "code")


@register("src_values_dicts", """WITH s(o_orderstatus, label, is_open) AS (VALUES ('F', 'finished', false),
  ('O', 'open', true), ('P', 'partial', true))
  SELECT o.o_orderkey, o.o_orderstatus, s.label, s.is_open FROM orders o
  LEFT JOIN s ON o.o_orderstatus = s.o_orderstatus""")
def src_values_dicts(spark, sf):
    labels = spark.createDataFrame(STATUS_LABELS, "status STRING, label STRING, open BOOLEAN")
    labels = labels.select(F.col("status").alias("o_orderstatus"), "label",
                           F.col("open").alias("is_open"))
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return lookup_join(o, labels, "o_orderstatus", bounded_rows=len(STATUS_LABELS))


@register("src_range", """SELECT id FROM range(1, (SELECT MAX(c_custkey) + 1 FROM customer)) t(id)
  WHERE id NOT IN (SELECT c_custkey FROM customer)""")
def src_range(spark, sf):
    """Key gaps: ``spark.range`` over the key domain, anti-joined with the
    table.  Only the one scalar bound travels to the driver."""
    c = T(spark, sf, "customer")
    top = c.agg(F.max("c_custkey")).first()[0] or 0
    ids = spark.range(1, top + 1)
    return ids.join(c.select(F.col("c_custkey").alias("id")), "id", "left_anti")
