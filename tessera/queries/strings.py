"""STR: string functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.sources import adapters as A
from tessera.sources.tables import table as T


@register("str_case", "SELECT c_custkey, upper(c_name) AS up, lower(c_mktsegment) AS low FROM customer")
def str_case(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", F.upper("c_name").alias("up"),
                                           F.lower("c_mktsegment").alias("low"))


@register("str_initcap", """SELECT p_partkey, array_to_string(list_transform(string_split(lower(p_name), ' '),
  lambda w: upper(substring(w, 1, 1)) || substring(w, 2)), ' ') AS title FROM part""")
def str_initcap(spark, sf):
    # Capitalises after a space only ("a-b" -> "A-b").
    return T(spark, sf, "part").select("p_partkey", F.initcap("p_name").alias("title"))


@register("str_trim", """SELECT c_custkey, trim('  ' || c_mktsegment || chr(9) || '  ', ' ') AS t,
  ltrim('  ' || c_mktsegment || '  ', ' ') AS lt, rtrim('  ' || c_mktsegment || '  ', ' ') AS rt
  FROM customer""")
def str_trim(spark, sf):
    seg = F.col("c_mktsegment")
    padded = F.concat(F.lit("  "), seg, F.lit("  "))
    # Only spaces are trimmed; the tab stays.
    return T(spark, sf, "customer").select(
        "c_custkey", F.trim(F.concat(F.lit("  "), seg, F.lit("\t  "))).alias("t"),
        F.ltrim(padded).alias("lt"), F.rtrim(padded).alias("rt"))


@register("str_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents")
def str_length(spark, sf):
    return T(spark, sf, "documents").select("doc_id", F.length("text").alias("n"))


@register("str_substring", "SELECT c_custkey, substring(c_name, 1, 5) AS head FROM customer")
def str_substring(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", F.substring("c_name", 1, 5).alias("head"))


@register("str_reverse", "SELECT c_custkey, reverse(c_name) AS rev FROM customer")
def str_reverse(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", F.reverse("c_name").alias("rev"))


@register("str_concat", S.with_retail(
    "SELECT customer_id, first_name || ' <' || email || '>' AS contact FROM r_customers"))
def str_concat(spark, sf):
    # Any null part makes the result null.
    return A.customers(spark, sf).select(
        "customer_id", F.concat("first_name", F.lit(" <"), "email", F.lit(">")).alias("contact"))


@register("str_concat_ws", S.with_retail(
    "SELECT customer_id, concat_ws('-', first_name, email, city) AS joined FROM r_customers"))
def str_concat_ws(spark, sf):
    return A.customers(spark, sf).select(
        "customer_id", F.concat_ws("-", "first_name", "email", "city").alias("joined"))


@register("str_regexp_replace", S.with_retail(
    "SELECT customer_id, regexp_replace(phone, '[^0-9]', '', 'g') AS digits FROM r_customers"))
def str_regexp_replace(spark, sf):
    return A.customers(spark, sf).select(
        "customer_id", F.regexp_replace("phone", "[^0-9]", "").alias("digits"))


@register("str_regexp_extract", """SELECT c_custkey,
  regexp_extract(c_name, 'Customer#0*([1-9][0-9]*)', 1) AS number,
  regexp_extract(c_name, 'Supplier#([0-9]+)', 1) AS nomatch FROM customer""")
def str_regexp_extract(spark, sf):
    return T(spark, sf, "customer").select(
        "c_custkey", F.regexp_extract("c_name", r"Customer#0*([1-9][0-9]*)", 1).alias("number"),
        F.regexp_extract("c_name", r"Supplier#([0-9]+)", 1).alias("nomatch"))


@register("str_split", """SELECT p_partkey, array_to_string(string_split(p_name, ' '), '|') AS parts,
  CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_parts,
  CAST(len(string_split_regex(p_type, '\\s+')) AS INTEGER) AS n_type_words FROM part""")
def str_split(spark, sf):
    parts = F.split("p_name", " ")
    return T(spark, sf, "part").select(
        "p_partkey", F.array_join(parts, "|").alias("parts"), F.size(parts).alias("n_parts"),
        F.size(F.split("p_type", r"\s+")).alias("n_type_words"))


@register("str_lpad", "SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS padded FROM customer")
def str_lpad(spark, sf):
    return T(spark, sf, "customer").select(
        "c_custkey", F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("padded"))
