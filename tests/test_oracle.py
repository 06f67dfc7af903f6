"""Every SQL-expressible query agrees with its DuckDB formulation (sf0.001)."""

import pytest

from tadkit.plans.registry import load_all
from tadkit.plans.verify import compare, duck

SMALL = "/root/testdata/sf0.001"
CHECKED = sorted(n for n, (_f, sql) in load_all().items() if sql)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", CHECKED)
def test_matches_duckdb(spark, con, entry_module, name):
    fn = entry_module.queries()[name]
    st = compare(spark, con, name, fn, entry_module.oracle_sql()[name], SMALL)
    assert st["status"].startswith("ok"), st
