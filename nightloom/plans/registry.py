"""Every registered query of the survey operators, with its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chain, columns, joins, reports

PARTS = (reports.R, columns.R, joins.R, chain.R)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for part in PARTS for name, q in part.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for part in PARTS for name, text in part.twins.items()}
