"""Where queries are registered: name, function, equivalent SQL and the rows of the blueprint that they cover."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


REGISTERED: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Registers a function of (spark, sf_dir). covers: names of blueprint rows, parted by blanks."""

    def keep(run):
        REGISTERED[run.__name__] = Query(run, sql and sql.strip(), tuple(covers.split()))
        return run

    return keep
