"""Documents that are one flat object of key and amount."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_amounts(text: Column) -> Column:
    return F.from_json(text, "map<string,double>")


def total_of(amounts: Column) -> Column:
    """Sum of the values of one map; an empty map gives zero."""
    return F.aggregate(F.map_values(amounts), F.lit(0.0), lambda acc, value: acc + value)


def total_by(rows: DataFrame, keys: list[str], amounts: str) -> DataFrame:
    """Sum of all map values of a group, however many maps it holds; zero if they are all empty.

    A group whose maps are all null has a null total.
    """
    return rows.groupBy(*keys).agg(F.sum(total_of(F.col(amounts))).alias("total"))
