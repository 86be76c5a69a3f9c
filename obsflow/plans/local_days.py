"""Daily marts by the local day of each place, which starts and ends by the clock there.

Every row carries its own zone. A local day has 23 or 25 hours when the clock changes. Tables are stored by the day in UTC, which is
at most one day off the local one, so a span of local days needs the stored days one wider on each side.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.functions.scalars import exact_average
from obsflow.operators.rounded_join import ROUNDED_KEY, keyed_locations, with_rounded_key
from obsflow.plans.marts import summarize


def known_zone(zone: Column) -> Column:
    """Whether a text is the name of a zone; a conversion by any other would fail."""
    return F.coalesce(zone.isin(sorted(available_timezones())), F.lit(False))


def split_zones(rows: DataFrame, zone: str = "timezone") -> tuple[DataFrame, DataFrame]:
    """(rows whose zone is known, the others)."""
    known = known_zone(F.col(zone))
    return rows.filter(known), rows.filter(~known)


def local_day(moment: Column, zone: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(moment, zone))


def day_hours(day: Column, zone: Column) -> Column:
    """Hours from one local midnight to the next."""
    begin, end = (F.unix_seconds(F.to_utc_timestamp(d.cast("timestamp"), zone)) for d in (day, F.date_add(day, 1)))
    return ((end - begin) / 3600).cast("decimal(4,2)")


def stored_days(day: str, first: dt.date, last: dt.date) -> Column:
    """The stored days that can hold moments of the local days from first to last."""
    step = dt.timedelta(days=1)
    return F.col(day).between(first - step, last + step)


def local_daily_stats(
    hourly: DataFrame,
    locations: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
    zone: str = "timezone",
) -> DataFrame:
    """Highest, lowest and average temperature per city, zone and local date, with the hours of that day and the number of observations.

    ``hourly`` is in UTC. Rows of an unknown zone are left out; ``split_zones`` gives them. With ``first`` and ``last`` only these local dates are
    given, and of a table that is stored by ``obs_date`` only the days that can hold them are read.
    """
    if (first is None) != (last is None):
        raise ValueError("a span has two ends")
    rows, _ = split_zones(hourly, zone)
    if first is not None and "obs_date" in hourly.columns:
        rows = rows.filter(stored_days("obs_date", first, last))
    dated = with_rounded_key(rows).withColumn("date", local_day(F.col("datetime").cast("timestamp"), F.col(zone)))
    if first is not None:
        dated = dated.filter(F.col("date").between(first, last))
    days = summarize(dated, [*ROUNDED_KEY, zone, "date"])
    placed = days.join(keyed_locations(locations), ROUNDED_KEY)
    stats = placed.groupBy("country", "state", "city", zone, "date").agg(
        F.max("_max").alias("max_temperature"),
        F.min("_min").alias("min_temperature"),
        F.expr(exact_average("sum(_sum)", "sum(_count)")).alias("average_temperature"),
        F.sum("_count").alias("observations"),
    )
    return stats.withColumn("day_hours", day_hours(F.col("date"), F.col(zone)))
