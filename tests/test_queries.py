"""Every query with an oracle gives the oracle's rows."""

import oracle
import pytest

from tessera import registry


@pytest.fixture(scope="module")
def duck(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, duck, name):
    got = registry.QUERIES[name](spark, sf).toPandas()
    if name in registry.ORACLES:
        oracle.same(got, duck.execute(registry.ORACLES[name]).df())
    else:
        assert len(got) > 0
