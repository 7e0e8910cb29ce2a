import pytest

from newsloom.llm.queries import QUERIES
from newsloom.llm.sql import ORACLE
from tests.compare import rows
from tests.conftest import DATA

FIXED = {
    "p1_found": [("feed_articleid", "bigint"), ("lang", "string")], "p2_found": [("first_id", "bigint"), ("second_id", "bigint")], "p3_found": [("feed_articleid", "bigint")],
    "p4_found": [("first_id", "bigint"), ("item_id", "bigint")], "p5_found": [("hostname", "string"), ("line", "string")], "p6_found": [("feed_articleid", "bigint"), ("line_no", "int")],
    "p10_found": [("doc_id", "bigint")],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    if name in FIXED:
        assert df.dtypes == FIXED[name]
    got = df.toPandas()
    if name.endswith("_found"):
        assert not got.duplicated().any()
    if name in ORACLE:
        assert rows(got) == rows(duck.execute(ORACLE[name]).df())
    else:
        assert len(got) > 0
