"""Reading a published view and showing the head of it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from obsflow.fixed_values import DAILY_MAX_VIEW, PREVIEW_ROWS
from obsflow.sinks.files import preview
from obsflow.sources.tables import read_query


def show_view(
    spark: SparkSession,
    name: str = DAILY_MAX_VIEW,
    jdbc: Mapping[str, str] | None = None,
    count: int = PREVIEW_ROWS,
) -> DataFrame:
    """Print the first rows of a view and return the whole of it."""
    rows = read_query(spark, f"SELECT * FROM {name}", jdbc)
    preview(rows, count)
    return rows
