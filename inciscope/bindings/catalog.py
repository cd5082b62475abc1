"""All registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from inciscope.bindings import events, numbers, orders, parts, raw, runs, star
from inciscope.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def _configured(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run


MODULES = [raw, orders, star, events, parts, numbers, runs]
QUERIES = {name: _configured(query) for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
