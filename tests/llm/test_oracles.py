"""Every training-data query that has SQL, against that SQL on the smallest scale."""

import pytest

from barsmith.llm.queries import ORACLES, QUERIES

from ..compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None
