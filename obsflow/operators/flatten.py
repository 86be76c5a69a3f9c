"""Nested documents to flat columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.functions.scalars import as_coordinate, as_measure, first_field, from_epoch
from obsflow.schemas import CONDITION_FIELDS, CURRENT_MEASURES, HOURLY_MEASURES


def _place() -> list[Column]:
    return [
        as_coordinate(F.col("lat")).alias("latitude"),
        as_coordinate(F.col("lon")).alias("longitude"),
        F.col("timezone"),
    ]


def _measures(entry: str, names: list[str]) -> list[Column]:
    return [as_measure(F.col(f"{entry}.{name}")).alias(name) for name in names]


def _condition(entry: str) -> list[Column]:
    return [
        first_field(F.col(f"{entry}.weather"), field).alias(f"weather_{field}")
        for field in CONDITION_FIELDS
    ]


def _unfit(entry: str, names: list[str]) -> list[Column]:
    """For each measure whether its value is there but doesn't fit its type, and so came out null."""
    lost = [(F.col(f"{entry}.{name}"), name) for name in names]
    return [(raw.isNotNull() & as_measure(raw).isNull()).alias(f"{name} does not fit") for raw, name in lost]


def unfit_flags(names: list[str]) -> dict[str, Column]:
    """Rules that a flattened row breaks if a value of one of these measures was lost."""
    return {rule: F.col(f"`{rule}`") for rule in (f"{name} does not fit" for name in names)}


def flatten_hourly(documents: DataFrame, unfit: bool = False) -> DataFrame:
    """One row per hourly entry. Documents without entries give no row.

    With ``unfit`` there is a further column for each measure, whether it had a value that doesn't fit.
    """
    entries = documents.select("lat", "lon", "timezone", F.explode("hourly").alias("entry"))
    return entries.select(
        *_place(),
        from_epoch(F.col("entry.dt")).alias("datetime"),
        *_measures("entry", HOURLY_MEASURES),
        *_condition("entry"),
        *(_unfit("entry", HOURLY_MEASURES) if unfit else []),
    )


def flatten_current(documents: DataFrame, unfit: bool = False) -> DataFrame:
    """One row per document that carries a current observation; ``unfit`` as for hourly entries."""
    return documents.filter(F.col("current").isNotNull()).select(
        *_place(),
        from_epoch(F.col("current.dt")).alias("requested_datetime"),
        from_epoch(F.col("current.sunrise")).alias("sunrise"),
        from_epoch(F.col("current.sunset")).alias("sunset"),
        *_measures("current", CURRENT_MEASURES),
        *_condition("current"),
        *(_unfit("current", CURRENT_MEASURES) if unfit else []),
    )


def flatten_struct(rows: DataFrame, sep: str = ".") -> DataFrame:
    """Every struct field becomes a column named by its path; arrays stay whole."""
    return rows.select(*_leaves(rows.schema, [], sep))


def _leaves(schema: T.StructType, path: list[str], sep: str) -> list[Column]:
    columns: list[Column] = []
    for field in schema.fields:
        here = [*path, field.name]
        if isinstance(field.dataType, T.StructType):
            columns += _leaves(field.dataType, here, sep)
        else:
            quoted = ".".join("`" + name.replace("`", "``") + "`" for name in here)
            columns.append(F.col(quoted).alias(sep.join(here)))
    return columns
