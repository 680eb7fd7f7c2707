"""More golden tests on the reference's literal inputs (FIXTURES.md §1)."""

import pytest
from pyspark.sql import functions as F

from tessera import schemas
from tessera.operators.joins import skew_join
from tessera.operators.windows import rank_within
from tessera.plans import ml as M

# Fixed literal inputs of the reference's examples.
ROLES = [("Alice", 34, "Engineer"), ("Bob", 45, "Manager"), ("Charlie", 28, "Engineer"),
         ("Diana", 35, "Analyst"), ("Eve", 29, "Engineer")]
PRODUCTS_SMALL = [("product_1", 100, 25.50), ("product_2", 200, 15.75),
                  ("product_3", 150, 30.00), ("product_4", 75, 45.25)]
EMP_YEARS = [("Alice", "Engineering", 90000, 5), ("Bob", "Engineering", 95000, 7),
             ("Charlie", "Sales", 70000, 3), ("Diana", "Sales", 75000, 4),
             ("Eve", "Engineering", 85000, 2)]
PURCHASES_JSON = ['{"user_id": 1, "name": "Alice", "purchases": [100, 200, 150]}',
                  '{"user_id": 2, "name": "Bob", "purchases": [50, 75]}',
                  '{"user_id": 3, "name": "Charlie", "purchases": [300, 250, 100, 150]}']
PEOPLE = [{"name": "Alice", "age": 34, "city": "NYC"}, {"name": "Bob", "age": 45, "city": "LA"},
          {"name": "Charlie", "age": 28, "city": "Chicago"}]
EMP_DEPT = [(1, "Alice", 100), (2, "Bob", 200), (3, "Charlie", 100)]
DEPTS = [(100, "Engineering"), (200, "Sales"), (300, "Marketing")]
REGRESSION = [(1.0, 2.0, 3.0), (2.0, 3.0, 5.0), (3.0, 4.0, 7.0), (4.0, 5.0, 9.0)]


def test_roles(spark):
    df = spark.createDataFrame(ROLES, ["name", "age", "role"])
    counts = {r.role: r["count"] for r in df.groupBy("role").count().collect()}
    assert counts == {"Engineer": 3, "Manager": 1, "Analyst": 1}
    avg = {r.role: r["avg(age)"] for r in df.groupBy("role").avg("age").collect()}
    assert avg["Engineer"] == pytest.approx(30.333, abs=1e-3) and avg["Manager"] == 45


def test_products_small_value(spark):
    df = spark.createDataFrame(PRODUCTS_SMALL, ["product_id", "quantity", "price"])
    v = {r.product_id: r.v for r in df.select(
        "product_id", F.round(F.col("quantity") * F.col("price"), 2).alias("v")).collect()}
    assert v == {"product_1": 2550.0, "product_2": 3150.0, "product_3": 4500.0,
                 "product_4": 3393.75}


def test_emp_years(spark):
    df = spark.createDataFrame(EMP_YEARS, ["name", "department", "salary", "years"])
    stats = {r.department: (r.a, r.t, r.n) for r in df.groupBy("department").agg(
        F.avg("salary").alias("a"), F.sum("salary").alias("t"), F.count(F.lit(1)).alias("n")
    ).collect()}
    assert stats == {"Engineering": (90000, 270000, 3), "Sales": (72500, 145000, 2)}
    y = F.col("years")
    level = {r.name: r.level for r in df.select(
        "name", F.when(y < 3, "Junior").when(y < 6, "Mid").otherwise("Senior").alias("level")
    ).collect()}
    assert level == {"Charlie": "Mid", "Diana": "Mid", "Eve": "Junior", "Alice": "Mid",
                     "Bob": "Senior"}
    ranks = {r.name: r.rank for r in rank_within(df, "department", "salary").collect()}
    assert ranks == {"Bob": 1, "Alice": 2, "Eve": 3, "Diana": 1, "Charlie": 2}


def test_purchases_json(spark):
    text = spark.createDataFrame([(j,) for j in PURCHASES_JSON], "value string")
    parsed = text.select(F.from_json("value", schemas.PURCHASES).alias("p")).select("p.*")
    out = {r.name: (r.total, r.n) for r in parsed.select("name", F.explode("purchases").alias("x"))
           .groupBy("name").agg(F.sum("x").alias("total"), F.count(F.lit(1)).alias("n")).collect()}
    assert out == {"Alice": (450, 3), "Bob": (125, 2), "Charlie": (800, 4)}


def test_people_filters(spark):
    df = spark.createDataFrame(PEOPLE, "name string, age bigint, city string")
    names = lambda d: sorted(r.name for r in d.collect())
    assert names(df.filter(F.col("age") > 30)) == ["Alice", "Bob"]
    assert names(df.filter(F.col("name").like("%li%"))) == ["Alice", "Charlie"]
    assert names(df.filter(F.col("city").isin(["NYC", "LA"]))) == ["Alice", "Bob"]


def test_emp_dept_joins(spark):
    e = spark.createDataFrame(EMP_DEPT, ["emp_id", "name", "dept_id"])
    d = spark.createDataFrame(DEPTS, ["dept_id", "dept_name"])
    sizes = {how: e.join(d, "dept_id", how).count()
             for how in ("inner", "left", "right", "full", "left_semi", "left_anti")}
    assert sizes == {"inner": 3, "left": 3, "right": 4, "full": 4, "left_semi": 3, "left_anti": 0}
    assert skew_join(d, e, "dept_id", "full", hot_rows=1).count() == 4


def test_collinear_regression_fits_exactly(spark):
    df = spark.createDataFrame(REGRESSION, ["feature1", "feature2", "label"])
    model = M.fit_linear(M.assemble(df, ["feature1", "feature2"]), "label")
    summary = M.model_summary(spark, model).first()
    assert summary.rmse < 1e-6            # coefficients are not unique; the fit is
    pred = model.transform(M.assemble(df, ["feature1", "feature2"]))
    assert all(abs(r.prediction - r.label) < 1e-6 for r in pred.collect())
