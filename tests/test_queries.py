"""Every registered query against its comparison SQL, on the smallest test data."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry
from catalogue import q_clean, q_dims, q_facts, q_marts, q_profile
from catalogue.bank import Bank

SF = "/root/testdata/sf0.001"
QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.fixture(scope="module", autouse=True)
def one_load(spark):
    """The stage tables of a load do not change, so the queries here share one."""
    shared = Bank(spark, SF)
    with pytest.MonkeyPatch.context() as patch:
        for module in (q_clean, q_dims, q_facts, q_marts, q_profile):
            patch.setattr(module, "Bank", lambda spark, sf_dir: shared)
        yield


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, SF)
    if name in CHECKS:
        assert difference(df, connection, CHECKS[name]) is None
    else:
        assert df.count() > 0
