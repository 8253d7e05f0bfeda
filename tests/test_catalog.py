import pytest

from fluvia import catalog
from oracle import same

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, name):
    same(catalog.queries()[name](spark, DIR), DIR, catalog.oracle_sql()[name])


def test_entry(spark):
    assert catalog.entry(spark, DIR).count() > 0
