"""Every registered query against its SQL counterpart on the driver tables."""

import __spark_entry__ as entry
import oracle_check
import pytest

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF_DIR)


def test_entry(spark):
    assert entry.entry(spark).columns == ["value", "n_docs"]
    assert set(entry.ORACLE) == set(entry.QUERIES) and set(ORACLE) <= set(QUERIES)


# The queries of the subpackage that may be taken out are tested beside it.
@pytest.mark.parametrize("name", entry.QUERIES)
def test_query(spark, con, name):
    assert oracle_check.difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None
