"""The driver's contract: every oracle holds at sf0.001, and the engine stands without the training-data operators."""

import importlib
import sys

import duckdb
import pytest

from corpusforge import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_oracle(spark, duck, name):
    df = catalog.queries()[name](spark, DIR)
    found = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert plain(df.collect(), df.columns) == plain(found.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_without_oracle(spark, name):
    assert catalog.queries()[name](spark, DIR).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 23


def test_stands_without_llm(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpusforge.llm", None)
    monkeypatch.delitem(sys.modules, "corpusforge.llm.queries", raising=False)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    entry = importlib.import_module("__spark_entry__")
    assert not any(n.startswith("op") and n[2].isdigit() for n in entry.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
