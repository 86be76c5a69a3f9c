"""Every operator as a named query over the test tables, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from obsflow.registry import bundles, flows, loads, marts, upkeep, values, weather
from obsflow.registry.inputs import comparable
from obsflow.session import pin_utc

_MODULES = (marts, weather, loads, upkeep, flows, bundles, values)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {}
    for module in _MODULES:
        for name, build in module.QUERIES.items():
            found[name] = _finished(build)
    return found


def all_oracles() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}


def _finished(
    build: Callable[[SparkSession, str], DataFrame],
) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(pin_utc(spark), sf_dir))

    return run
