"""Order documents to a total and its message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.functions.maps import parse_amounts, total_of
from obsflow.functions.scalars import total_message


def order_totals(documents: DataFrame, text: str = "document") -> DataFrame:
    """Parse each order document and add its total and a line to print."""
    total = total_of(parse_amounts(F.col(text)))
    return documents.withColumn("total_order_value", total).withColumn(
        "message", total_message(F.col("total_order_value"))
    )
