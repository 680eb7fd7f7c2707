"""Small report pipelines of the apps and guides, on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import schemas
from tessera.functions import avg_money, cents, sum_money
from tessera.operators.joins import lookup_join
from tessera.plans.sales import enriched_sales, monthly_summary
from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.session import scratch_path
from tessera.sinks.files import write_csv
from tessera.sources import adapters as A
from tessera.sources.files import read_csv
from tessera.sources.tables import fan_out, table as T


def _mean_money(x):
    """Exact-sum mean of money as a double (sum of cents / n / 100)."""
    return F.sum(cents(x)) / F.count(F.col(x)) / F.lit(100.0)


def _sql_mean_money(x):
    return f"CAST(SUM({S.cents(x)}) AS DOUBLE) / COUNT({x}) / 100"


@register("employee_report", """SELECT c_custkey, upper(c_name) AS name, c_mktsegment, c_acctbal
  FROM customer WHERE c_acctbal > 6000""")
def employee_report(spark, sf):
    return (T(spark, sf, "customer").where(F.col("c_acctbal") > 6000)
            .select("c_custkey", F.upper("c_name").alias("name"), "c_mktsegment", "c_acctbal"))


@register("employee_dept_avg", f"""SELECT c_mktsegment, {_sql_mean_money('c_acctbal')} AS avg_balance
  FROM customer GROUP BY c_mktsegment""")
def employee_dept_avg(spark, sf):
    return T(spark, sf, "customer").groupBy("c_mktsegment").agg(
        _mean_money("c_acctbal").alias("avg_balance"))


_CAT_SQL = f"""COUNT(*) AS n_lines,
  CAST(SUM({S.cents('p.p_retailprice')} * CAST(l.l_quantity AS BIGINT)) AS DOUBLE) / 100 AS revenue,
  {_sql_mean_money('p.p_retailprice')} AS avg_price,
  MAX(l.l_quantity) AS max_quantity, MIN(l.l_quantity) AS min_quantity
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""


def _category_lines(spark, sf):
    li = T(spark, sf, "lineitem").select("l_partkey", "l_quantity")
    p = T(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type",
                                    "p_retailprice")
    return li.join(p, "l_partkey")


def _category_aggs():
    return [F.count(F.lit(1)).alias("n_lines"),
            (F.sum(cents("p_retailprice") * F.col("l_quantity").cast("long")) / F.lit(100.0))
            .alias("revenue"),
            _mean_money("p_retailprice").alias("avg_price"),
            F.max("l_quantity").alias("max_quantity"), F.min("l_quantity").alias("min_quantity")]


@register("category_stats", f"SELECT p.p_type AS category, {_CAT_SQL} GROUP BY p.p_type")
def category_stats(spark, sf):
    return (_category_lines(spark, sf).groupBy(F.col("p_type").alias("category"))
            .agg(*_category_aggs()))


@register("category_grand_total", f"SELECT {_CAT_SQL}")
def category_grand_total(spark, sf):
    return _category_lines(spark, sf).agg(*_category_aggs())


@register("customer_totals", """SELECT c.c_custkey, c.c_name,
  CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
  FROM customer c LEFT JOIN (SELECT CASE WHEN o_custkey % 7 = 0 THEN -o_custkey ELSE o_custkey END AS o_custkey,
    o_totalprice FROM orders) o ON c.c_custkey = o.o_custkey
  GROUP BY c.c_custkey, c.c_name ORDER BY c.c_custkey""")
def customer_totals(spark, sf):
    """Left join then total: a customer without orders gets null (the orders
    of every seventh customer are moved to a key that no customer has)."""
    c = T(spark, sf, "customer").select("c_custkey", "c_name")
    k = F.col("o_custkey")
    o = T(spark, sf, "orders").select(F.when(k % 7 == 0, -k).otherwise(k).alias("c_custkey"), "o_totalprice")
    return (c.join(o, "c_custkey", "left").groupBy("c_custkey", "c_name")
            .agg(sum_money("o_totalprice").alias("total_amount")).orderBy("c_custkey"))


@register("csv_product_summary", f"""SELECT l_partkey AS product, {_sql_mean_money('l_extendedprice')} AS avg_price,
  SUM(l_quantity) AS total_quantity FROM lineitem GROUP BY l_partkey""")
def csv_product_summary(spark, sf):
    """Write sales as CSV, read the text back, cast, summarise per product."""
    path = scratch_path(spark, "csv_sales")
    li = T(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.col("l_partkey").alias("product"), F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"))
    write_csv(li, path)
    raw = read_csv(spark, path, "date STRING, product STRING, price STRING, quantity STRING")
    typed = raw.select(F.col("product").try_cast("long").alias("product"),
                       F.col("price").try_cast("double").alias("price"),
                       F.col("quantity").try_cast("double").alias("quantity"))
    return typed.groupBy("product").agg(_mean_money("price").alias("avg_price"),
                                        F.sum("quantity").alias("total_quantity"))


@register("json_purchase_totals", """SELECT user_id, 'user' || CAST(user_id AS VARCHAR) AS name,
  CAST(SUM(CAST(json_extract(props, '$.k') AS BIGINT) + CAST(floor(value) AS BIGINT)) AS BIGINT) AS total,
  2 * COUNT(*) AS n_purchases FROM events GROUP BY user_id""")
def json_purchase_totals(spark, sf):
    """JSON text rows (user, name, purchases array) -> typed columns ->
    explode the array -> total and number per user."""
    e = fan_out(T(spark, sf, "events").select("user_id", "props", "value"))
    doc = F.to_json(F.struct(
        F.col("user_id"), F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("name"),
        F.array(F.from_json("props", "k BIGINT").getField("k"),
                F.floor("value").cast("long")).alias("purchases")))
    parsed = e.select(F.from_json(doc, schemas.PURCHASES).alias("p")).select("p.*")
    items = parsed.select("user_id", "name", F.explode("purchases").alias("amount"))
    return items.groupBy("user_id", "name").agg(F.sum("amount").alias("total"),
                                                F.count(F.lit(1)).alias("n_purchases"))


@register("compensation", """SELECT c_custkey, c_name || ' (' || c_mktsegment || ')' AS display_name,
  c_acctbal * 0.1 AS bonus, c_acctbal + c_acctbal * 0.1 AS total_comp,
  CASE WHEN c_nationkey % 10 < 3 THEN 'Junior' WHEN c_nationkey % 10 < 6 THEN 'Mid' ELSE 'Senior' END
  AS level FROM customer""")
def compensation(spark, sf):
    c = T(spark, sf, "customer")
    years = F.col("c_nationkey") % 10
    bonus = F.col("c_acctbal") * 0.1
    return c.select(
        "c_custkey",
        F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")")).alias("display_name"),
        bonus.alias("bonus"), (F.col("c_acctbal") + bonus).alias("total_comp"),
        F.when(years < 3, "Junior").when(years < 6, "Mid").otherwise("Senior").alias("level"))


@register("line_value", """SELECT l.l_orderkey, l.l_linenumber, CAST(ROUND(CAST(l.l_quantity AS DECIMAL(18,2))
  * CAST(p.p_retailprice AS DECIMAL(18,2)), 2) AS DOUBLE) AS line_value
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")
def line_value(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    p = T(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    v = F.col("l_quantity").cast("decimal(18,2)") * F.col("p_retailprice").cast("decimal(18,2)")
    return li.join(p, "l_partkey").select("l_orderkey", "l_linenumber",
                                          F.round(v, 2).cast("double").alias("line_value"))


def raw_sales(spark, sf):
    """orders as raw sales text with dirty rows derived from the key."""
    o = T(spark, sf, "orders")
    k = F.col("o_orderkey")
    date_text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return o.select(
        F.when(k % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(k % 13 == 0, F.lit("n/a")).when(k % 17 == 0, F.lit("-5.0"))
         .otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        F.when(k % 19 == 0, F.lit("2024-13-45")).when(k % 23 == 0, F.lit(None).cast("string"))
         .otherwise(date_text).alias("date_string"))


@register("monthly_summary", f"""WITH s AS (SELECT o_custkey AS customer_id, o_totalprice AS amount,
    CASE WHEN o_orderkey % 19 <> 0 AND o_orderkey % 23 <> 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders
    WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 AND o_totalprice > 0)
  SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, COUNT(*) AS num_transactions,
    CAST(SUM({S.cents('amount')}) AS DOUBLE) / 100 AS total_revenue,
    CAST(SUM({S.cents('amount')}) AS DOUBLE) / COUNT(*) / 100 AS avg_transaction,
    COUNT(DISTINCT customer_id) AS unique_customers
  FROM s GROUP BY 1, 2 ORDER BY 1, 2""", headline=True)
def monthly_summary_q(spark, sf):
    return monthly_summary(raw_sales(spark, sf))


@register("sales_categories", """SELECT CASE WHEN amount > 1000 THEN 'High' WHEN amount > 500 THEN 'Medium' ELSE 'Low' END
    AS revenue_category, CAST(quarter(d) AS INTEGER) AS quarter, COUNT(*) AS n FROM (
    SELECT CASE o_orderkey % 5 WHEN 0 THEN 1000.0 WHEN 1 THEN 500.0 WHEN 2 THEN 500.01 ELSE o_totalprice END AS amount,
           CAST(o_orderdate AS DATE) AS d FROM orders) WHERE amount > 0 GROUP BY 1, 2""")
def sales_categories(spark, sf):
    """Rows per revenue category and quarter; amounts on the class limits."""
    o = T(spark, sf, "orders")
    k = F.col("o_orderkey") % 5
    raw = o.select(F.col("o_custkey").cast("string").alias("customer_id"),
                   F.when(k == 0, "1000.0").when(k == 1, "500.0").when(k == 2, "500.01")
                   .otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
                   F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_string"))
    return enriched_sales(raw).groupBy("revenue_category", "quarter").agg(F.count(F.lit(1)).alias("n"))


@register("region_sales", f"""SELECT r.r_name AS region, {S.sum_money('o.o_totalprice')} AS total_sales,
  {S.avg_money('o.o_totalprice')} AS avg_sale, COUNT(*) AS n_orders
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY r.r_name""")
def region_sales(spark, sf):
    o = T(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    c = T(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = T(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    r = T(spark, sf, "region").select("r_regionkey", F.col("r_name").alias("region"))
    geo = lookup_join(n, r, "r_regionkey", "inner", bounded_rows=5)
    cust = lookup_join(c, geo, "n_nationkey", "inner", bounded_rows=25)
    return o.join(cust, "c_custkey").groupBy("region").agg(
        sum_money("o_totalprice").alias("total_sales"), avg_money("o_totalprice").alias("avg_sale"),
        F.count(F.lit(1)).alias("n_orders"))


@register("contact_clean", S.with_retail("""SELECT customer_id, trim(first_name, ' ') AS first_name,
  regexp_replace(phone, '[^0-9]', '', 'g') AS phone, COALESCE(email, 'unknown') AS email
  FROM r_customers WHERE customer_id IS NOT NULL"""))
def contact_clean(spark, sf):
    c = A.customers(spark, sf).dropna(subset=["customer_id"])
    return c.select("customer_id", F.trim("first_name").alias("first_name"),
                    F.regexp_replace("phone", "[^0-9]", "").alias("phone"),
                    F.when(F.col("email").isNull(), "unknown").otherwise(F.col("email"))
                    .alias("email"))


@register("customer_order_summary", f"""SELECT c.c_custkey, c.c_name, COUNT(o.o_orderkey) AS num_orders,
  {S.sum_money('o.o_totalprice')} AS total_spent
  FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey, c.c_name""")
def customer_order_summary(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_name")
    o = T(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey",
                                      "o_totalprice")
    return c.join(o, "c_custkey").groupBy("c_custkey", "c_name").agg(
        F.count("o_orderkey").alias("num_orders"), sum_money("o_totalprice").alias("total_spent"))
