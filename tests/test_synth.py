"""Every value of a generated customer or order has a digest of its own."""

import datetime
import hashlib

from pyspark.sql import functions as F

from tessera.functions.hashing import HASH_DIGITS, HASH_RANGE
from tessera.plans import synth

AS_OF = "2024-12-31"


def below(key, salt, n):
    return int(hashlib.md5(f"{key}:{salt}".encode()).hexdigest()[:HASH_DIGITS], 16) % n


def cents(key, salt, low, span):
    return (low + (below(key, salt, 2 * span + 1) + 1) // 2) / 100


def day(ago):
    return datetime.date.fromisoformat(AS_OF) - datetime.timedelta(days=ago)


def test_each_value_of_a_customer_has_its_own_digest(spark, registry):
    for r in synth.generate_customers(spark.range(0, 4000), AS_OF).collect():
        k = r.customer_id - 1
        assert (r.email is None) == (below(k, 0, 100_000) < 100)
        assert r.phone == f"614-555-{below(k, 1, 10_000):04d}" and r.city == synth.CITIES[below(k, 2, 10)]
        assert r.registration_date == day(below(k, 3, 1095)) and r.customer_type == synth.CUSTOMER_TYPES[below(k, 4, 3)]
    assert registry["gen_customers"].sql.count("md5(") == 5


def test_each_value_of_an_order_has_its_own_digest(spark, registry):
    n, n_c, n_p = 6000, 10_000, 1000
    rows = synth.generate_orders(spark.range(0, n), F.lit(n_c), n_p, AS_OF).collect()
    twice = [k for k in range(n) if below(k + 1, 9, HASH_RANGE) < HASH_RANGE / 1000]
    assert twice and sorted(r.order_id for r in rows) == sorted([*range(1, n + 1), *(k + 1 for k in twice)])
    for r in rows:
        k = r.order_id - 1
        assert r.customer_id == (None if below(k, 11, 100_000) < 50 else below(k, 0, n_c) + 1)
        assert (r.product_id, r.quantity, r.order_date) == (below(k, 1, n_p) + 1, below(k, 2, 5) + 1, day(below(k, 3, 365)))
        assert (r.order_status, r.payment_method) == (synth.ORDER_STATUSES[below(k, 4, 5)], synth.PAYMENT_METHODS[below(k, 5, 5)])
        assert (r.total_amount, r.discount_amount, r.shipping_cost) == (
            cents(k, 6, 1000, 49500), cents(k, 7, 0, 5000), cents(k, 8, 500, 2000))
    assert registry["gen_orders"].sql.count("md5(") == 11
