"""Where queries are registered: a function of Tables, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geoquill.sources.fixtures import Tables, with_derived
from geoquill.workspace import Workspace

registered: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
sql_of: dict[str, str] = {}


def query(sql: str | None) -> Callable:
    def register(f: Callable[[Tables], DataFrame]) -> Callable:
        registered[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            sql_of[f.__name__] = with_derived(sql)
        return f

    return register


def work(t: Tables) -> Workspace:
    return Workspace(t.spark, "features")
