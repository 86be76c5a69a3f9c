"""Joining observations to locations on rounded coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.fixed_values import COORDINATE_SCALE
from obsflow.functions.scalars import rounded

ROUNDED_KEY = ["_lat_key", "_lon_key"]


def with_rounded_key(rows: DataFrame, scale: int = COORDINATE_SCALE) -> DataFrame:
    return rows.withColumns(
        {
            "_lat_key": rounded(F.col("latitude"), scale),
            "_lon_key": rounded(F.col("longitude"), scale),
        }
    )


def keyed_locations(locations: DataFrame, scale: int = COORDINATE_SCALE) -> DataFrame:
    """Locations under their rounded key, without the coordinates themselves."""
    return with_rounded_key(locations, scale).drop("latitude", "longitude")


def join_on_rounded(
    observations: DataFrame, locations: DataFrame, scale: int = COORDINATE_SCALE
) -> DataFrame:
    """Each observation with each location whose rounded coordinates are equal.

    Row-level form, read once: locations of a size that Spark broadcasts are; else adaptive execution splits the partition of a
    hot coordinate and reads its few locations for each part. The marts do
    not need it, as they aggregate before they join. Two locations that round to one key
    both match; ``duplicate_keys`` on the rounded key finds such pairs.
    """
    keyed = with_rounded_key(observations, scale)
    return keyed.join(keyed_locations(locations, scale), ROUNDED_KEY).drop(*ROUNDED_KEY)
