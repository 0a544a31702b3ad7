"""Every registered query against its SQL on the given tables, and the counts of the survey."""

import pytest

import __spark_entry__ as contract
from tests.check_oracle import compare, tables
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def database():
    return tables(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


COUNTS = {
    "sig_dormant_vendor": 8880,
    "sig_dormant_vendor_dense": 56,
    "sig_accrual": 11175,
    "sig_accrual_documented": 12072,
    "sig_large_month": 919 + 530 + 28,
    "sig_cadence_monthly": 2632,
    "sig_cadence_quarterly": 3485,
    "sig_no_invoice": 78979,
    "sig_no_invoice_dense": 40467,
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, database, name):
    difference, rows = compare(spark, database, name, SF)
    assert difference is None
    assert rows == COUNTS.get(name, rows)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "glean_id",
        "glean_date",
        "glean_text",
        "glean_type",
        "glean_location",
        "invoice_id",
        "canonical_vendor_id",
    ]
    assert df.count() > 0
