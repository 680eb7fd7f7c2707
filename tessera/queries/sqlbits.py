"""SQL text for the oracle engine, mirroring the Spark helpers.

``adapters`` here must stay equal to ``tessera.sources.adapters``; the money
and hash snippets mirror ``tessera.functions``.  The oracle engine's
``//`` is integer division and ``/`` of integers is floating division.
"""

from __future__ import annotations

from collections.abc import Sequence

from tessera.functions.hashing import HASH_DIGITS
from tessera.sources import adapters as A


def cents(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) * 100 AS BIGINT)"


def sum_money(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def half_up_div(n: str, d: str) -> str:
    """round(n / d), halves away from zero."""
    return f"(CASE WHEN ({n}) < 0 THEN -((-2 * CAST({n} AS BIGINT) + ({d})) // (2 * CAST({d} AS BIGINT))) ELSE (2 * CAST({n} AS BIGINT) + ({d})) // (2 * CAST({d} AS BIGINT)) END)"


def round_ratio(n: str, d: str, digits: int = 2, scale: int = 1) -> str:
    p = 10 ** digits
    return f"(CAST({half_up_div(f'CAST({n} AS BIGINT) * {scale * p}', d)} AS DOUBLE) / {p})"


def avg_money(x: str) -> str:
    return (f"CASE WHEN COUNT({x}) > 0 THEN "
            f"CAST({half_up_div(f'SUM({cents(x)})', f'COUNT({x})')} AS DOUBLE) / 100 END")


def draw(k: str, salt: int = 0) -> str:
    return f"CAST('0x' || substr(md5(CAST({k} AS VARCHAR) || ':{salt}'), 1, {HASH_DIGITS}) AS BIGINT)"


def draw_below(k: str, salt: int, n: str | int) -> str:
    return f"({draw(k, salt)} % CAST({n} AS BIGINT))"


def number(k: str, i: int, salt: int = 0) -> str:
    """Number ``i`` of ``tessera.functions.hashing.numbers``."""
    at = 1 if i % 2 == 0 else HASH_DIGITS + 2
    return f"CAST('0x' || substr(md5(CAST({k} AS VARCHAR) || ':{salt + i // 2}'), {at}, {HASH_DIGITS}) AS BIGINT)"


def split_draw(number: str, *sizes: str | int) -> list[str]:
    draws = []
    for size in sizes:
        draws.append(f"(({number}) % CAST({size} AS BIGINT))")
        number = f"({number}) // CAST({size} AS BIGINT)"
    return draws


def dedup(src: str, keys: Sequence[str], columns: Sequence[str], where: str | None = None,
          order: Sequence[str] = ()) -> str:
    """One row per key: smallest by ``order`` then all other columns, nulls first."""
    rest = [c for c in order if c not in keys] + \
        [c for c in columns if c not in keys and c not in order]
    ob = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    w = f" WHERE {where}" if where else ""
    cols = ", ".join(columns)
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{', '.join(keys)} ORDER BY {ob}) AS _rn FROM {src}{w}) WHERE _rn = 1")


CUSTOMER_COLS = ["customer_id", "first_name", "last_name", "email", "phone", "city",
                 "registration_date", "customer_type"]
PRODUCT_COLS = ["product_id", "product_name", "category", "brand", "unit_price",
                "stock_quantity", "is_active"]
ORDER_COLS = ["order_id", "customer_id", "product_id", "quantity", "order_date",
              "order_status", "payment_method", "total_amount", "discount_amount",
              "shipping_cost"]

R_CUSTOMERS = f"""r_customers AS (
  SELECT c.c_custkey AS customer_id, c.c_name AS first_name,
         'Family' || lpad(CAST(c.c_custkey % 1000 AS VARCHAR), 3, '0') AS last_name,
         CASE WHEN c.c_custkey % {A.NULL_EMAIL_EVERY} = 0 THEN NULL
              ELSE 'customer' || CAST(c.c_custkey AS VARCHAR) || '@example.com' END AS email,
         '555-' || lpad(CAST(c.c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
         n.n_name AS city,
         CAST(DATE '{A.REGISTRATION_START}' + CAST(c.c_custkey % {A.REGISTRATION_DAYS} AS INTEGER) AS DATE)
           AS registration_date,
         c.c_mktsegment AS customer_type
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

R_PRODUCTS = f"""r_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
         CASE WHEN p_partkey % {A.NEGATIVE_PRICE_EVERY} = 0 THEN CAST(-10 AS DOUBLE)
              WHEN p_partkey % {A.ZERO_PRICE_EVERY} = 0 THEN CAST(0 AS DOUBLE)
              ELSE p_retailprice END AS unit_price,
         CAST(CASE WHEN p_partkey % {A.ZERO_STOCK_EVERY} = 0 THEN 0 ELSE p_size * 20 END AS INTEGER)
           AS stock_quantity,
         p_partkey % {A.INACTIVE_EVERY} <> 0 AS is_active
  FROM part)"""

R_ORDERS = f"""r_orders AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS order_id,
         CASE WHEN o.o_custkey % {A.NULL_CUSTOMER_EVERY} = 0 THEN NULL ELSE o.o_custkey END AS customer_id,
         l.l_partkey AS product_id, CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(o.o_orderdate AS DATE) AS order_date, o.o_orderstatus AS order_status,
         o.o_orderpriority AS payment_method, CASE WHEN l.l_partkey % {A.REFUND_EVERY} = 0 THEN -l.l_extendedprice
              ELSE l.l_extendedprice END AS total_amount,
         l.l_discount AS discount_amount, l.l_tax AS shipping_cost
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

R_QUOTES = f"""r_quotes AS (
  SELECT text AS quote_text, source AS author,
         CASE WHEN doc_id % {A.NULL_TAGS_EVERY} = 0 THEN NULL ELSE [lang, source] END AS tags,
         doc_id AS page_number,
         '2024-01-01T00:00:' || lpad(CAST(doc_id % 60 AS VARCHAR), 2, '0') AS scraped_at
  FROM documents)"""

C_CUSTOMERS = ("c_customers AS ("
               + dedup("r_customers", ["customer_id"], CUSTOMER_COLS, "email IS NOT NULL") + ")")
C_PRODUCTS = ("c_products AS ("
              + dedup("r_products", ["product_id"], PRODUCT_COLS, "unit_price > 0") + ")")
C_ORDERS = ("c_orders AS ("
            + dedup("r_orders", ["order_id"], ORDER_COLS, "customer_id IS NOT NULL") + ")")

RETAIL = ",\n".join([R_CUSTOMERS, R_PRODUCTS, R_ORDERS, C_CUSTOMERS, C_PRODUCTS, C_ORDERS])


def with_retail(body: str, *extra_ctes: str) -> str:
    """``WITH <retail adapters + cleaning>, <extra> <body>``."""
    ctes = ",\n".join([RETAIL, *extra_ctes])
    return f"WITH {ctes}\n{body}"

SPARSE = """sparse AS (
  SELECT CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_name END AS name,
         CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END AS segment,
         CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE c_acctbal END AS balance
  FROM customer)"""


def with_ctes(body: str, *ctes: str) -> str:
    return f"WITH {', '.join(ctes)}\n{body}" if ctes else body


def pick(values: Sequence[str], drawn: str) -> str:
    items = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"[{items}][CAST({drawn} AS INTEGER) + 1]"


def drawn_cents(drawn: str, low: int) -> str:
    return f"CAST({low} + ({drawn} + 1) // 2 AS DOUBLE) / 100"


def drawn_pick(values: Sequence[str], k: str, stream: int) -> str:
    return pick(values, draw_below(k, stream, len(values)))


def cents_between(k: str, stream: int, low: int, span: int) -> str:
    return f"({low} + ({draw_below(k, stream, 2 * span + 1)} + 1) // 2)"
