import __spark_entry__
from checks.oracle import ORACLE
from checks.queries import QUERIES
import pytest

from checks.compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    found = compare(spark, SF, name)
    assert found.startswith("same"), found


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= __spark_entry__.queries().keys()
