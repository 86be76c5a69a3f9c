"""What a run asks for: locations, days, and the grid of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.fixed_values import DEFAULT_LOCATIONS, DEFAULT_UNITS, TRAILING_DAYS
from obsflow.functions.scalars import is_blank


def default_locations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_LOCATIONS, "latitude string, longitude string")


def resolve_locations(
    requests: DataFrame, latitude: str = "latitude", longitude: str = "longitude"
) -> DataFrame:
    """Replace each request whose two coordinates are blank by the default locations.

    A request with at least one coordinate is taken as it stands. The defaults are a
    constant array in the row, so no join takes place.
    """
    defaults = F.array(
        *[
            F.struct(F.lit(lat).alias("latitude"), F.lit(lon).alias("longitude"))
            for lat, lon in DEFAULT_LOCATIONS
        ]
    )
    own = F.array(
        F.struct(F.col(latitude).alias("latitude"), F.col(longitude).alias("longitude"))
    )
    both_blank = is_blank(F.col(latitude)) & is_blank(F.col(longitude))
    others = [c for c in requests.columns if c not in (latitude, longitude)]
    return requests.select(
        *others, F.explode(F.when(both_blank, defaults).otherwise(own)).alias("place")
    ).select(*others, "place.latitude", "place.longitude")


def trailing_days(rows: DataFrame, anchor: Column, days: int = TRAILING_DAYS) -> DataFrame:
    """Repeat each row for ``days`` days before its anchor, newest first.

    Adds ``day`` and ``dt``, the epoch second of the anchor's time of day on that day.
    """
    back = F.explode(F.sequence(F.lit(1), F.lit(days)))
    return (
        rows.select("*", anchor.cast("timestamp").alias("_anchor"), back.alias("_back"))
        .withColumn("_moment", F.timestamp_add("DAY", -F.col("_back"), F.col("_anchor")))
        .select(
            *rows.columns,
            F.date_sub(F.to_date("_anchor"), F.col("_back")).alias("day"),
            F.unix_timestamp("_moment").alias("dt"),
        )
    )


def request_grid(
    locations: DataFrame,
    anchor: Column,
    units: str = DEFAULT_UNITS,
    days: int = TRAILING_DAYS,
) -> DataFrame:
    """Every location on every trailing day.

    The days are generated inside each location row, so the product needs neither a
    join nor a shuffle.
    """
    return trailing_days(locations, anchor, days).withColumn("units", F.lit(units))
