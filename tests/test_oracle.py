import pytest

from oracle import SMALL, connect, differences
from spokewise.plans.sales import SalesTables
from spokewise.registered import REGISTERED


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_equals_its_sql(spark, duck, name):
    registered = REGISTERED[name]
    assert registered.sql is not None
    df = registered.build(SalesTables(spark, SMALL))
    assert differences(df, duck, registered.sql) == ""


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    rows = contract.entry(spark).collect()
    assert [r.order_year for r in rows] == sorted(r.order_year for r in rows)
    assert len(rows) == 7
