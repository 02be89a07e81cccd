"""Every query of the engine proper, with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from tessella.plans import model

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function of (spark, sf_dir) under its name; oracle: SQL over the relations of `model`."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = model.sql(oracle)
        return f

    return register


def over(name: str, operator: Callable[..., DataFrame], *relations: str, oracle: str | None = None, **options) -> None:
    """Register an operator applied to whole relations."""
    QUERIES[name] = lambda spark, sf_dir: operator(*(model.relation(spark, sf_dir, r) for r in relations), **options)
    if oracle:
        ORACLE[name] = model.sql(oracle)


def scalar(name: str, relation: str, key: str, value: Callable[[], Column], oracle: str) -> None:
    """Register a scalar function over every row of a relation: key and value."""
    QUERIES[name] = lambda spark, sf_dir: model.relation(spark, sf_dir, relation).select(key, value().alias("value"))
    ORACLE[name] = model.sql(f"SELECT {key}, {oracle} AS value FROM {{{relation}}}")


from tessella.plans import aggregates, catalog, checks, documents, io, joins, pages, scalars, stages, trees, whole  # noqa: E402, F401  (they register themselves)
