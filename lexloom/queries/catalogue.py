"""The register that ``query`` fills."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexloom.sources.tables import spread, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TEXTS = {"documents", "pages"}


def query(*tables: str, sql: str | None = None):
    """Registers f(table, ...) as a query over the named tables of a folder; those of texts are spread."""

    def register(f: Callable[..., DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return f(*(spread(table(spark, folder, t)) if t in TEXTS else table(spark, folder, t) for t in tables))

        QUERIES[f.__name__] = run
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register
