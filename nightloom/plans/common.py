"""Helpers of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .views import Survey, r6, sql

Query = Callable[[Survey], DataFrame]


class Registry:
    """Queries over the survey's tables, each with the SQL that DuckDB runs (None where SQL can't express it)."""

    def __init__(self):
        self.made: dict[str, Query] = {}
        self.twins: dict[str, str] = {}

    def add(self, name: str, query: Query, twin: str | None) -> None:
        self.made[name] = query
        if twin is not None:
            self.twins[name] = sql(twin)

    def queries(self) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
        return {name: (lambda spark, sf_dir, q=q: q(Survey(spark, sf_dir))) for name, q in self.made.items()}


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Columns rounded as :func:`views.r6` does."""
    return df.withColumns({c: F.floor(F.col(c) * 1e6 + 0.5) / 1e6 for c in columns})


def sep(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    """Great-circle distance as SQL."""
    return f"degrees(2*asin(sqrt(least(1e0, pow(sin(radians(({dec2})-({dec1}))/2),2) + cos(radians({dec1}))*cos(radians({dec2}))*pow(sin(radians(({ra2})-({ra1}))/2),2)))))"


def dang(a: str, b: str) -> str:
    """a - b in (-180, 180] as SQL (both in [0, 360))."""
    return f"(CASE WHEN ({a})-({b}) > 180 THEN ({a})-({b})-360e0 WHEN ({a})-({b}) <= -180 THEN ({a})-({b})+360e0 ELSE ({a})-({b}) END)"


CLASSES = """
CAST(coalesce(sum(CASE WHEN classification <> 'X' THEN 1 ELSE 0 END),0) AS BIGINT) AS found, CAST(coalesce(sum(CASE WHEN classification = 'X' THEN 1 ELSE 0 END),0) AS BIGINT) AS unfound,
CAST(coalesce(sum(CASE WHEN classification IN ('C','X') THEN 1 ELSE 0 END),0) AS BIGINT) AS avail, CAST(coalesce(sum(CASE WHEN classification = 'C' THEN 1 ELSE 0 END),0) AS BIGINT) AS clean,
CAST(coalesce(sum(CASE WHEN classification = 'M' THEN 1 ELSE 0 END),0) AS BIGINT) AS mixed, CAST(coalesce(sum(CASE WHEN classification = 'B' THEN 1 ELSE 0 END),0) AS BIGINT) AS bad,
CAST(coalesce(sum(CASE WHEN classification = 'N' THEN 1 ELSE 0 END),0) AS BIGINT) AS nonsynthetic"""

__all__ = ["CLASSES", "F", "Registry", "dang", "r6", "rounded", "sep"]
