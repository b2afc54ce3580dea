"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from audience_engine.plans.expected import SPACES
from audience_engine.plans.views import duck_views, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


class Inputs:
    """The views of one data folder as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)


def query(name: str, check: str | None = None, views: Iterable[str] = (), steps: str = ""):
    """Register a query on the views; ``check`` is the DuckDB query on the same views, after the CTEs in ``steps``."""

    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        if check is not None:
            ctes = ",\n".join(part for part in (duck_views(*views), steps.strip()) if part)
            CHECKS[name] = (f"WITH {ctes}\n" if ctes else "") + check.strip()
        return build

    return register


def sql_list(words: Iterable[str]) -> str:
    """Words as a SQL list of literals."""
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


def stripped(text: str) -> str:
    """SQL: the text without outer white space."""
    return f"trim({text}, concat({', '.join(f'chr({ord(c)})' for c in SPACES)}))"


def any_in(text: str, words: Iterable[str]) -> str:
    """SQL: any of the words occurs in the text."""
    return "(" + " OR ".join(f"contains({text}, '{word}')" for word in words) + ")"
