"""Keeping good documents and answers, setting the rest aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.functions.scalars import is_accepted
from obsflow.schemas import CORRUPT_COLUMN


def rejection() -> Column:
    """Why a weather document is unusable, null when it is good.

    A service error is valid JSON of another shape, so the required fields are tested too.
    """
    incomplete = F.col("lat").isNull() | F.col("lon").isNull() | F.col("timezone").isNull()
    empty = F.col("hourly").isNull() & F.col("current").isNull()
    return (
        F.when(F.col(CORRUPT_COLUMN).isNotNull(), "corrupt")
        .when(incomplete, "incomplete")
        .when(empty, "empty")
    )


def split_documents(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejected); the rejected rows say why in ``reason``."""
    judged = documents.withColumn("reason", rejection())
    good = judged.filter(F.col("reason").isNull()).drop("reason", CORRUPT_COLUMN)
    return good, judged.filter(F.col("reason").isNotNull())


def accepted_responses(responses: DataFrame, status: str = "status") -> DataFrame:
    return responses.filter(is_accepted(F.col(status)))
