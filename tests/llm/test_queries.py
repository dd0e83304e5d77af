import os

import pytest

import __spark_entry__ as entry
from compare import compare, oracle
from tallyroute.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    verdict, _, n = compare(spark, oracle(FOLDER), FOLDER, name, QUERIES[name], ORACLES[name])
    assert verdict == "ok" and n > 0
