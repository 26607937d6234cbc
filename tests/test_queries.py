"""Every registered query with SQL gives what DuckDB gives; the others give rows."""

from __future__ import annotations

import pytest

from planquill.plans import all_queries

from .conftest import rows_of

QUERIES, SQL = all_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, duck, name):
    got = QUERIES[name](spark, small).toPandas()
    if name in SQL:
        want = duck.sql(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)
    else:
        assert len(got.columns) > 0
