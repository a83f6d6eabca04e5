"""Every registered query against its SQL oracle, on the smallest tables."""

import oracle_check
import pytest

import __spark_entry__ as registered

SF_DIR = registered.SMOKE_DIR


@pytest.fixture(scope="module")
def connection():
    return oracle_check.oracle_connection(SF_DIR)


OWN = [key for key in registered.queries() if key not in registered.LLM_QUERIES]


@pytest.mark.parametrize("key", OWN)
def test_query_equals_its_oracle(spark, connection, key):
    assert oracle_check.compare(spark, connection, SF_DIR, key)


def test_every_query_has_an_oracle():
    assert set(OWN) == set(registered.oracle_sql()) - set(registered.LLM_ORACLES)


def test_entry_gives_rows(spark):
    result = registered.entry(spark)
    assert result.columns == [
        "calendar_year",
        "calendar_month",
        "country",
        "product_line",
        "units_sold",
        "gross_revenue",
        "margin",
    ]
    assert result.first() is not None
