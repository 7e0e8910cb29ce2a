"""Every core query against its SQL, and those without SQL against a run that must give rows."""

import pytest

from newsloom.plans import registry
from tests.compare import rows
from tests.conftest import DATA

ORACLE = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, DATA)
    assert len(set(got.columns)) == len(got.columns)
    got = got.toPandas()
    if name in ORACLE:
        assert rows(got) == rows(duck.execute(ORACLE[name]).df())
    else:
        assert len(got) > 0
