import __spark_entry__ as e
from newsloom.plans import registry


def test_contract(spark):
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and set(registry.queries()) <= set(q)
    assert e.entry(spark).limit(5).count() == 5
