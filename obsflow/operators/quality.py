"""Key, null and length checks: what a database would enforce on load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from obsflow.fixed_values import MAX_TEXT_LENGTH


class QualityError(ValueError):
    """A batch breaks a rule of the table it is meant for."""


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def _tally(rows: DataFrame, flags: dict[str, Column], label: str) -> DataFrame:
    """One aggregate over all flags, turned into a row per column."""
    counts = rows.agg(*[F.count_if(flag).alias(name) for name, flag in flags.items()])
    return counts.unpivot([], list(flags), "column_name", label)


def null_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    return _tally(rows, {c: F.col(c).isNull() for c in columns}, "nulls")


def over_length(
    rows: DataFrame, columns: list[str], longest: int = MAX_TEXT_LENGTH
) -> DataFrame:
    return _tally(rows, {c: F.length(c) > longest for c in columns}, "too_long")


def rule_flags(required: list[str], texts: list[str]) -> dict[str, Column]:
    """Named conditions under which a row breaks a rule."""
    flags = {f"{c} is null": F.col(c).isNull() for c in required}
    return flags | {f"{c} is too long": F.length(c) > MAX_TEXT_LENGTH for c in texts}


def split_by_rules(rows: DataFrame, flags: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that break no rule, the others with a column ``broken``: the names of the rules they break)."""
    names = F.array(*[F.when(flag, F.lit(name)) for name, flag in flags.items()])
    judged = rows.withColumn("broken", F.array_compact(names))
    return judged.filter(F.size("broken") == 0).drop("broken"), judged.filter(F.size("broken") > 0)


def assert_clean(
    rows: DataFrame,
    required: list[str],
    texts: list[str],
    unique: list[str] | None = None,
    **measures: Column,
) -> Row:
    """Raise when a required column is null, a text is too long or a key repeats.

    Nulls and lengths take one pass with one output row; ``measures`` are further
    aggregates wanted from the same pass, and come back as a row. The key check stops at
    the first repeated key it finds.
    """
    flags = rule_flags(required, texts)
    found = rows.agg(
        F.count("*").alias("rows"),
        *[F.count_if(flag).alias(name) for name, flag in flags.items()],
        *[measure.alias(name) for name, measure in measures.items()],
    ).first()
    broken = {name: found[name] for name in flags if found[name]}
    if broken:
        raise QualityError(f"rows breaking a rule: {broken}")
    if unique and not duplicate_keys(rows, unique).isEmpty():
        raise QualityError(f"key {unique} occurs more than once in the batch")
    return found
