"""SQL surface: the same operators as SQL text over DataFrame parameters."""

from __future__ import annotations

from tessera.operators.windows import rank_within
from tessera.queries import register
from tessera.sources.tables import table as T


@register("sql_dept_stats", """SELECT c_mktsegment AS department, COUNT(*) AS employees,
  CAST(SUM(CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 100 AS BIGINT)) AS DOUBLE) / COUNT(*) / 100 AS avg_salary,
  MAX(c_acctbal) AS max_salary FROM customer GROUP BY c_mktsegment ORDER BY avg_salary DESC""")
def sql_dept_stats(spark, sf):
    return spark.sql("""
        SELECT c_mktsegment AS department, count(*) AS employees,
               sum(CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 100 AS BIGINT)) / count(*) / 100.0
                 AS avg_salary,
               max(c_acctbal) AS max_salary
        FROM {employees} GROUP BY c_mktsegment ORDER BY avg_salary DESC""",
                     employees=T(spark, sf, "customer"))


@register("sql_rank", """SELECT c_mktsegment AS department, c_name AS name, c_acctbal AS salary,
  CAST(RANK() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS INTEGER) AS salary_rank
  FROM customer""")
def sql_rank(spark, sf):
    # A department is a hot group (5 segments, a fifth of the table each):
    # the rank is computed by the chunked operator, SQL does the projection.
    ranked = rank_within(T(spark, sf, "customer"), "c_mktsegment", "c_acctbal",
                         method="rank", name="salary_rank")
    return spark.sql("""SELECT c_mktsegment AS department, c_name AS name, c_acctbal AS salary,
                               CAST(salary_rank AS INT) AS salary_rank FROM {ranked}""", ranked=ranked)


@register("sql_rank_window", """WITH m AS (SELECT o_custkey AS customer,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
    SUM(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS sales_cents
    FROM orders GROUP BY 1, 2)
  SELECT customer, month, CAST(sales_cents AS DOUBLE) / 100 AS sales,
  CAST(RANK() OVER (PARTITION BY customer ORDER BY sales_cents DESC) AS INTEGER) AS sales_rank FROM m""")
def sql_rank_window(spark, sf):
    # The plain SQL window form, on groups bounded by construction: the
    # aggregate leaves one row per customer and month before the window.
    return spark.sql("""
        WITH m AS (SELECT o_custkey AS customer, trunc(CAST(o_orderdate AS DATE), 'MM') AS month,
                          sum(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS sales_cents
                   FROM {orders} GROUP BY 1, 2)
        SELECT customer, month, CAST(sales_cents AS DOUBLE) / 100 AS sales,
               RANK() OVER (PARTITION BY customer ORDER BY sales_cents DESC) AS sales_rank
        FROM m""", orders=T(spark, sf, "orders"))


@register("sql_temp_view", """SELECT c_mktsegment AS department, COUNT(*) AS employees,
  MAX(c_acctbal) AS max_salary FROM customer GROUP BY c_mktsegment""")
def sql_temp_view(spark, sf):
    # Register a name for SQL (session-scoped view), then query it by name.
    T(spark, sf, "customer").createOrReplaceTempView("tessera_employees")
    return spark.sql("""SELECT c_mktsegment AS department, count(*) AS employees,
                               max(c_acctbal) AS max_salary
                        FROM tessera_employees GROUP BY c_mktsegment""")
