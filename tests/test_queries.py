"""Every query of the engine against its SQL on the smallest tables; those without SQL give rows that aren't all null."""

import pytest

from orthoweave.plans.registry import REGISTERED
from orthoweave.plans import catalog  # noqa: F401
from tests.oracle import assert_same, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query(spark, duck, name):
    q = REGISTERED[name]
    df = q.run(spark, SF)
    if q.sql:
        assert_same(df, q.sql, duck)
    else:
        got = df.collect()
        assert got and any(v is not None for r in got for v in r)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
