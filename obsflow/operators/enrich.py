"""Looking up the address of a coordinate in a gazetteer table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.fixed_values import COORDINATE_SCALE
from obsflow.operators.rounded_join import ROUNDED_KEY, keyed_locations, with_rounded_key

ADDRESS = ["city", "state", "postcode", "country"]


def fullest_address() -> Column:
    """Of several addresses of one place the one with the fewest gaps, then the first by its fields."""
    gaps = sum((F.col(c).isNull().cast("int") for c in ADDRESS), F.lit(0))
    return F.min(F.struct(gaps.alias("gaps"), F.struct(*ADDRESS).alias("address")))["address"]


def lookup_location(
    points: DataFrame, gazetteer: DataFrame, scale: int = COORDINATE_SCALE
) -> DataFrame:
    """One location row per distinct coordinate; unknown address fields are null.

    Points are reduced to distinct coordinates first, and the gazetteer to one
    address per rounded key, the fullest, so no key is heavy on either side.
    """
    distinct_points = points.select("latitude", "longitude").distinct()
    known = (
        keyed_locations(gazetteer, scale)
        .groupBy(*ROUNDED_KEY)
        .agg(fullest_address().alias("_address"))
    )
    return (
        with_rounded_key(distinct_points, scale)
        .join(known, ROUNDED_KEY, "left")
        .select("latitude", "longitude", *[F.col(f"_address.{name}").alias(name) for name in ADDRESS])
    )
