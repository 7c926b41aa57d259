import pytest

from factloom.plans import catalog

from .conftest import canonical


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_its_sql(spark, sf, duck, name):
    got = canonical(catalog.queries()[name](spark, sf).toPandas())
    assert got == canonical(duck.sql(catalog.oracle_sql()[name]).df())


def test_entry_gives_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
