"""Locations whose address changes: one row for each span of time in which it stayed the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsflow.fixed_values import COORDINATE_SCALE
from obsflow.operators.merge import first_per_key
from obsflow.operators.rounded_join import ROUNDED_KEY, with_rounded_key

ADDRESS = ["city", "state", "postcode", "country"]


def location_history(landings: DataFrame, scale: int = COORDINATE_SCALE) -> DataFrame:
    """(rounded key, address, valid_from, valid_to) from all landings of locations, each with the moment ``landed``.

    A span starts when an address first lands that isn't the one before, nulls being equal, and ends where the next starts; the last is open, its
    valid_to null. Of several addresses that land for one place at one moment the first by its columns counts. A place lands once a run, so its landings are few.
    """
    keyed = with_rounded_key(landings, scale).select(*ROUNDED_KEY, "landed", *ADDRESS)
    single = first_per_key(keyed, [*ROUNDED_KEY, "landed"], ADDRESS)
    by_time = Window.partitionBy(*ROUNDED_KEY).orderBy("landed")
    before = F.lag(F.struct(*ADDRESS)).over(by_time)
    starts = single.withColumn("_before", before).filter(F.col("_before").isNull() | ~F.struct(*ADDRESS).eqNullSafe(F.col("_before")))
    return starts.select(
        *ROUNDED_KEY, *ADDRESS, F.col("landed").alias("valid_from"), F.lead("landed").over(by_time).alias("valid_to")
    )


def address_as_of(rows: DataFrame, history: DataFrame, moment: str = "datetime", scale: int = COORDINATE_SCALE) -> DataFrame:
    """Each row with the address that its place had at its moment; nulls where there was none yet.

    The spans of a place don't overlap, so a row meets at most one: a join on the place, the span being part of its condition, which gives as
    many rows as there are. A place with very many rows is split by adaptive execution, as the join keeps the rows' side whole.
    """
    keyed = with_rounded_key(rows, scale)
    spans = history.select(*[F.col(k).alias(f"_of{k}") for k in ROUNDED_KEY], *ADDRESS, "valid_from", "valid_to")
    at = F.col(moment).cast("timestamp")
    same_place = (F.col("_lat_key") == F.col("_of_lat_key")) & (F.col("_lon_key") == F.col("_of_lon_key"))
    within = (at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    joined = keyed.join(spans, same_place & within, "left")
    return joined.select(*rows.columns, *ADDRESS, "valid_from")
