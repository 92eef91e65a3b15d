"""Rows that follow from the rules by hand, on small tables."""

import duckdb
import pytest
import scans  # noqa: F401  states more
from test_entry import plain
from worked import STATED


@pytest.mark.parametrize("name", sorted(STATED))
def test_stated(spark, name):
    rows, run = STATED[name]
    df, found = run(spark, None), duckdb.connect().execute(rows)
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert plain(df.collect(), df.columns) == plain(found.fetchall(), names)
