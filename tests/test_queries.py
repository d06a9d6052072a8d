from __future__ import annotations

import pytest
from conftest import SMALL
from oracle import same

from rillflow.plans import ORACLES, QUERIES


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, name):
    same(QUERIES[name](spark, SMALL), ORACLES[name], SMALL)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
