"""All registered queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratinglens.session import tune
from workload import collection, end_to_end, figures, ratings, records, sketched, snapshots, stored, streams, trends

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = (ratings, records, snapshots, trends, collection, figures, streams, stored, sketched, end_to_end)


def _tuned(run: Query) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(tune(spark), sf_dir)

    query.__doc__ = run.__doc__
    return query


def all_queries() -> dict[str, Query]:
    return {name: _tuned(run) for m in _MODULES for name, (run, _) in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, (_, sql) in m.QUERIES.items() if sql is not None}
