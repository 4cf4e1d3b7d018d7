import pytest
from compare import SF, connect, same_rows

from loomspan.plans import catalog

SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    same_rows(catalog.queries()[name](spark, SF), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_flagship_is_the_panel(spark):
    assert catalog.flagship(spark, SF).columns == ["grp", "day", "smooth", "change_7", "change_30"]
