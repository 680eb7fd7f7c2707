"""Every registered query with SQL equals DuckDB on the sf0.001 tables
(the driver repeats this at sf0.01)."""


import pytest

from tessera.queries import load_all
from tools.oracle_check import compare, duck

from .conftest import SF_SMALL

NAMES = sorted(load_all())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, registry, name):
    status, info, _ = compare(spark, con, registry[name], SF_SMALL)
    assert status in ("OK", "NOSQL"), f"{name}: {status} {info}"


def test_every_query_has_sql(registry):
    assert [n for n, q in sorted(registry.items()) if q.sql is None] == []


def test_inventory_size(registry):
    assert len(registry) >= 150
