"""All registered queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.plans import gold_queries, model_oracle, model_queries
from tradewind.plans.sample import Sample
from tradewind.plans.silver import Dealt, Staged, StagedOrders

_QUERIES = [gold_queries, model_queries]
_ORACLES = [gold_queries, model_oracle]


def _staging(family, name: str) -> bool | type[Staged] | type[Dealt]:
    if name in getattr(family, "DEALT", ()):
        return Dealt
    return StagedOrders if name in getattr(family, "STAGED_ORDERS", ()) else name in family.STAGED


def _run(build: Callable[[Sample], DataFrame], staged: bool | type[Staged] | type[Dealt]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Sample(spark, sf_dir, staged))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _run(build, _staging(family, name)) for family in _QUERIES for name, build in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for family in _ORACLES for name, text in family.ORACLE.items()}
