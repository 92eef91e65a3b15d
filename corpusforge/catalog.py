"""Registry of the engine's own queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusforge.session import spread

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its own name, with DuckDB SQL for the same rows if SQL can express it."""
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if oracle:
            _ORACLES[f.__name__] = oracle
        return f

    return register


#: Tables whose texts are split, folded and matched.
TEXT_TABLES = {"documents", "pages", "conversations"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name in TEXT_TABLES else rows


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    from corpusforge.plans import curated, derived, inline, linking, ordered, songbook, texts, typeset  # noqa: F401  they register themselves
