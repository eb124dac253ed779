"""Every registered query equals its DuckDB oracle on the smallest scale factor."""

import pytest

from carecast.oracle import oracle_sql
from carecast.registry import queries
from tests.conftest import SMALL_SF
from tools.compare import compare

KEYS = sorted(queries())


def test_every_query_has_an_oracle():
    assert set(KEYS) == set(oracle_sql())


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, duck, name):
    problems, n_spark, n_duck, _, _ = compare(spark, duck, SMALL_SF, name, oracle_sql()[name])
    assert not problems, "\n".join(problems)
    assert n_spark == n_duck
