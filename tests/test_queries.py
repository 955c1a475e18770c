import pytest
from oracle import check

import __spark_entry__ as entry
from tidemark.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    if name in ORACLES:
        check(spark, QUERIES[name], ORACLES[name], sf_dir)
    else:
        assert QUERIES[name](spark, sf_dir).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
