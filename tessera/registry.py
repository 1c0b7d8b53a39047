"""All queries of the engine and the SQL that says the same.

A query is written over named inputs: tables of the data folder and views of views.py that shape them like the manifests the engine works on.
`{name}` in a text stands for an input; the same holds for the oracle's text, which runs in DuckDB.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_NAME = re.compile(r"\{(\w+)\}")


class Inputs:
    """Tables and views over one data folder, by name; a view is built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._made = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self.sql(views.SPARK[name]) if name in views.SPARK else self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._made[name]

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{name: self[name] for name in set(_NAME.findall(text))})


def oracle(text: str) -> str:
    """DuckDB SQL: the views that the text needs as common table expressions, then the text."""
    needed: list[str] = []

    def add(t: str) -> None:
        for name in _NAME.findall(t):
            if name in views.DUCK and name not in needed:
                add(views.DUCK[name])
                needed.append(name)

    add(text)
    plain = lambda t: _NAME.sub(r"\1", t)
    made = ", ".join(f"{n} AS MATERIALIZED ({plain(views.DUCK[n])})" for n in needed)
    text = plain(text).strip()
    if not made:
        return text
    if text.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {made}, {text[len('WITH RECURSIVE') :]}"
    if text.upper().startswith("WITH"):
        return f"WITH {made}, {text[len('WITH') :]}"
    return f"WITH {made} {text}"


def query(name: str, duck: str | None = None):
    """Register f(inputs) -> DataFrame under this name, with its oracle."""

    def register(f: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Inputs(spark, sf_dir))
        if duck is not None:
            ORACLES[name] = oracle(duck)
        return f

    return register


def sql_query(name: str, spark: str, duck: str | None = None) -> None:
    """Register a query that is one SQL text; without a text for DuckDB both engines take the same."""
    query(name, spark if duck is None else duck)(lambda t: t.sql(spark))


def load() -> None:
    """Import all modules that register queries."""
    from . import operators, plans, sources, streaming  # noqa: F401


load()
