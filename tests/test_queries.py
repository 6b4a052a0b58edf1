"""Every registered query against its SQL on the driver tables."""

import compare
import pytest

from framelearn.plans import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.duck(sf_dir)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, sf_dir, con, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    cols, rows = compare.spark_rows(df)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in catalog.SQL:
        assert rows
        return
    want_cols, want = compare.duck_rows(con, catalog.SQL[name])
    assert cols == want_cols
    assert len(rows) == len(want)
    assert rows == want


def test_every_sql_has_a_query():
    assert set(catalog.SQL) <= set(catalog.QUERIES)
