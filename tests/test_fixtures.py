"""Golden tests on the reference's literal inputs (expected values worked
out by hand, FIXTURES.md section 1)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import sum_money
from tessera.operators.aggregate import agg_dict
from tessera.plans import quotes as Q
from tessera.plans.sales import sales_trend
from tessera.plans.text import word_count_space, word_count_whitespace

# Fixed literal inputs of the reference's examples.
LINES = ["Apache Spark is amazing", "Spark is fast and powerful",
         "PySpark makes Spark easy to use", "Spark Spark Spark"]
LINES3 = LINES[:3]
EMPLOYEES = [("John", "Sales", 5000, 28), ("Alice", "Engineering", 8000, 32),
             ("Bob", "Sales", 6000, 35), ("Charlie", "Engineering", 9000, 29),
             ("Diana", "HR", 5500, 30), ("Eve", "Engineering", 7500, 27)]
PRODUCT_SALES = [("Laptop", "Electronics", 1200, 5), ("Mouse", "Electronics", 25, 50),
                 ("Desk", "Furniture", 300, 10), ("Chair", "Furniture", 150, 20),
                 ("Keyboard", "Electronics", 75, 30), ("Monitor", "Electronics", 400, 15),
                 ("Table", "Furniture", 250, 8)]
CUSTOMERS = [(1, "John Doe", "New York"), (2, "Jane Smith", "Los Angeles"),
             (3, "Bob Johnson", "Chicago"), (4, "Alice Brown", "Houston")]
ORDERS = [(101, 1, 250.00), (102, 2, 150.00), (103, 1, 300.00), (104, 3, 200.00),
          (105, 2, 450.00), (106, 5, 100.00)]
SALES_DATED = [("2024-01-15", "Product A", 100, 50), ("2024-01-20", "Product B", 150, 30),
               ("2024-02-10", "Product A", 120, 45), ("2024-02-15", "Product C", 200, 25),
               ("2024-03-05", "Product B", 180, 35), ("2024-03-20", "Product A", 110, 55)]
MONTHLY = [("Alice", "2024-01", 1000), ("Alice", "2024-02", 1500), ("Bob", "2024-01", 800),
           ("Bob", "2024-02", 1200), ("Charlie", "2024-01", 2000), ("Charlie", "2024-02", 1800)]
TEXTS = ["  Hello World  ", "APACHE SPARK", "pyspark-tutorial"]


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_word_count_lines(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "text string")
    counts = as_dict(word_count_whitespace(df), "word", "count")
    assert counts["spark"] == 6 and counts["is"] == 2
    for w in ["amazing", "apache", "fast", "and", "powerful", "pyspark", "makes", "easy", "to", "use"]:
        assert counts[w] == 1
    assert len(counts) == 12


def test_word_count_lines3(spark):
    df = spark.createDataFrame([(x,) for x in LINES3], "text string")
    counts = as_dict(word_count_whitespace(df), "word", "count")
    assert counts["spark"] == 3 and counts["is"] == 2 and len(counts) == 12


def test_word_count_space_keeps_empty_tokens(spark):
    df = spark.createDataFrame([("a  b",)], "text string")
    counts = as_dict(word_count_space(df), "word", "count")
    assert counts == {"a": 1, "": 1, "b": 1}


def test_employee_report(spark):
    df = spark.createDataFrame(EMPLOYEES, ["name", "department", "salary", "age"])
    high = sorted(r.name for r in df.filter(F.col("salary") > 6000).collect())
    assert high == ["Alice", "Charlie", "Eve"]
    avg = as_dict(df.groupBy("department").avg("salary"), "department", "avg(salary)")
    assert avg["Sales"] == 5500 and avg["HR"] == 5500
    assert avg["Engineering"] == pytest.approx(24500 / 3)


def test_category_stats(spark):
    df = spark.createDataFrame(PRODUCT_SALES, ["product", "category", "price", "quantity"])
    df = df.withColumn("revenue", F.col("price") * F.col("quantity"))
    out = {r.category: r for r in df.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("revenue").alias("revenue"),
        F.avg("price").alias("avg_price"), F.max("quantity").alias("mx"),
        F.min("quantity").alias("mn")).collect()}
    e, f = out["Electronics"], out["Furniture"]
    assert (e.n, e.revenue, e.avg_price, e.mx, e.mn) == (4, 15500, 425, 50, 5)
    assert (f.n, f.revenue, f.mx, f.mn) == (3, 8000, 20, 8)
    assert f.avg_price == pytest.approx(233.333, abs=1e-3)
    total = df.agg(F.sum("revenue"), F.avg("price"), F.count(F.lit(1))).first()
    assert total[0] == 23500 and total[1] == pytest.approx(342.857, abs=1e-3) and total[2] == 7


def test_customer_totals_left_join(spark):
    c = spark.createDataFrame(CUSTOMERS, ["customer_id", "name", "city"])
    o = spark.createDataFrame(ORDERS, ["order_id", "customer_id", "amount"])
    assert c.join(o, "customer_id", "inner").count() == 5
    assert c.join(o, "customer_id", "left").count() == 6
    totals = as_dict(agg_dict(c.join(o, "customer_id", "left"), ["customer_id"],
                              {"amount": "sum"}, rename={"sum(amount)": "total"}),
                     "customer_id", "total")
    assert totals == {1: 550.0, 2: 600.0, 3: 200.0, 4: None}


def test_csv_summary(spark):
    df = spark.createDataFrame(SALES_DATED, ["date", "product", "price", "quantity"])
    out = {r.product: (r["avg(price)"], r["sum(quantity)"])
           for r in agg_dict(df, ["product"], {"price": "avg", "quantity": "sum"}).collect()}
    assert out == {"Product A": (110, 150), "Product B": (165, 65), "Product C": (200, 25)}


def test_sales_trend(spark):
    df = spark.createDataFrame(MONTHLY, ["customer", "month", "sales"])
    monthly = df.select("customer", F.to_date(F.concat("month", F.lit("-01"))).alias("month"),
                        (F.col("sales") * 100).alias("sales_cents"))
    rows = {(r.customer, r.month.month): r for r in sales_trend(monthly).collect()}
    assert rows[("Alice", 1)].running_total == 1000 and rows[("Alice", 2)].running_total == 2500
    assert rows[("Bob", 2)].running_total == 2000 and rows[("Charlie", 2)].running_total == 3800
    assert rows[("Alice", 2)].moving_avg == 1250 and rows[("Alice", 1)].moving_avg == 1000
    assert rows[("Alice", 1)].change is None and rows[("Alice", 2)].change == 500
    assert rows[("Charlie", 2)].change == -200


def test_dates(spark):
    df = spark.createDataFrame([("2024-01-15",)], "date_string string")
    d = F.try_to_date("date_string", "yyyy-MM-dd")
    r = df.select(F.dayofweek(d).alias("dow"), F.date_add(d, 7).alias("plus"),
                  F.date_format(d, "MMM dd, yyyy").alias("pretty")).first()
    assert r.dow == 2 and r.plus == dt.date(2024, 1, 22) and r.pretty == "Jan 15, 2024"


def test_strings(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    rows = df.select(F.trim("text").alias("t"), F.initcap("text").alias("i"),
                     F.substring("text", 1, 5).alias("s")).collect()
    assert rows[0].t == "Hello World"
    assert [r.i for r in rows[1:]] == ["Apache Spark", "Pyspark-tutorial"]
    assert [r.s for r in rows] == ["  Hel", "APACH", "pyspa"]
    phone = spark.createDataFrame([("(123) 456-7890",)], "p string")
    assert phone.select(F.regexp_replace("p", "[^0-9]", "")).first()[0] == "1234567890"


def test_money_sum_is_order_independent(spark):
    vals = [(0.1,), (0.2,), (0.3,)] * 1000
    df = spark.createDataFrame(vals, "x double")
    a = df.repartition(7).agg(sum_money("x")).first()[0]
    b = df.coalesce(1).agg(sum_money("x")).first()[0]
    assert a == b == 600.0


def test_quotes_dirty_cases(spark):
    raw = spark.createDataFrame(
        [("  ", "A", None, 1, "t1"), ("q", " B ", ["x", None], 2, "t2"),
         ("q", "B", ["y"], 3, "t3"), ("\tlead", "C", ["z"], 4, "t4"), (None, "D", [], 5, "t5")],
        "quote_text string, author string, tags array<string>, page_number bigint, scraped_at string")
    clean = {(r.quote_text, r.author): r for r in Q.clean_quotes(raw).collect()}
    assert clean[("", "A")].word_count == 1 and clean[("", "A")].tags == []
    assert clean[("q", "B")].page_number == 2          # lowest page survives
    assert clean[("\tlead", "C")].word_count == 2      # a leading tab adds a token
    assert len(clean) == 3
    assert sorted(r.tag for r in Q.quote_tags(Q.clean_quotes(raw)).collect()) == ["x", "z"]


def test_sql_and_dataframe_forms_agree(spark):
    df = spark.createDataFrame(EMPLOYEES, ["name", "department", "salary", "age"])
    via_df = {r.department: (r.n, r.avg_salary, r.max_salary) for r in df.groupBy("department").agg(
        F.count(F.lit(1)).alias("n"), F.avg("salary").alias("avg_salary"),
        F.max("salary").alias("max_salary")).collect()}
    via_sql = {r.department: (r.n, r.avg_salary, r.max_salary) for r in spark.sql(
        """SELECT department, count(*) AS n, avg(salary) AS avg_salary, max(salary) AS max_salary
           FROM {t} GROUP BY department ORDER BY avg_salary DESC""", t=df).collect()}
    assert via_df == via_sql
    assert via_sql["Engineering"][0] == 3 and via_sql["Engineering"][2] == 9000
