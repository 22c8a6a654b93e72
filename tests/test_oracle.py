"""Every oracle-checked catalogue query equals its DuckDB SQL (sf 0.001)."""

import pytest

import __spark_entry__ as E
from scripts.oracle_check import rows_of
from tests.conftest import SF_SMALL

ORACLE = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = rows_of(cols, [tuple(r) for r in df.collect()])
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    want = rows_of(dcols, res.fetchall())
    assert sorted(cols) == sorted(dcols)
    assert got == want


def test_every_query_has_a_callable():
    qs = E.queries()
    assert set(ORACLE) <= set(qs)
    assert len(qs) >= 90
