"""Every registered query against its SQL, on the smallest tables."""

import pytest

duckdb = pytest.importorskip("duckdb")

from checks.compare import compare, oracle_connection  # noqa: E402
from checks.oracles import ORACLES  # noqa: E402
from checks.registry import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    ok, note = compare(spark, connection, SF_DIR, name)
    assert ok, note
