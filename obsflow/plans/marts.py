"""Daily and monthly reporting tables.

Every mart first reduces observations to one summary per place and day. That keeps
the shuffle small, takes the weight off places with very many observations, and
leaves only summaries to join with locations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsflow.fixed_values import COORDINATE_SCALE
from obsflow.functions.scalars import as_measure, exact_average
from obsflow.operators.rounded_join import ROUNDED_KEY, keyed_locations, with_rounded_key


def summarize(
    rows: DataFrame, keys: list[str | Column], value: Column | str = "temp", also: dict[str, Column] | None = None
) -> DataFrame:
    """Highest, lowest, sum and number of values; summaries of summaries stay exact. ``also`` adds further aggregates."""
    measured = as_measure(F.col(value) if isinstance(value, str) else value)
    return rows.groupBy(*keys).agg(
        F.max(measured).alias("_max"),
        F.min(measured).alias("_min"),
        F.sum(measured).alias("_sum"),
        F.count(measured).alias("_count"),
        *[aggregate.alias(name) for name, aggregate in (also or {}).items()],
    )


def _average() -> Column:
    return F.expr(exact_average("sum(_sum)", "sum(_count)"))


def _day(hourly: DataFrame) -> Column:
    """The stored day where there is one, so that a filter on a mart's date prunes files."""
    return F.col("obs_date") if "obs_date" in hourly.columns else F.to_date("datetime")


def _days_by_location(
    hourly: DataFrame, locations: DataFrame, scale: int = COORDINATE_SCALE
) -> DataFrame:
    """Summary per (rounded place, date), with the location columns."""
    days = summarize(
        with_rounded_key(hourly, scale), [*ROUNDED_KEY, _day(hourly).alias("date")]
    )
    return placed_days(days, locations, scale)


def placed_days(days: DataFrame, locations: DataFrame, scale: int = COORDINATE_SCALE) -> DataFrame:
    """Summaries per rounded place and date with the location columns.

    The join has no hint: a small location table is broadcast by its measured size,
    a large one is shuffled along with the summaries.
    """
    return days.join(keyed_locations(locations, scale), ROUNDED_KEY)


def daily_max(hourly: DataFrame, locations: DataFrame) -> DataFrame:
    """Highest temperature per city and date. Cities are told apart by state and country
    only, so all coordinates of a city count together."""
    return daily_max_of(_days_by_location(hourly, locations))


def daily_max_of(placed: DataFrame) -> DataFrame:
    """The same from summaries per place and date."""
    return (
        placed
        .groupBy("country", "state", "city", "date", F.month("date").alias("month"))
        .agg(F.max("_max").alias("max_temperature"))
    )


def daily_stats(hourly: DataFrame, locations: DataFrame) -> DataFrame:
    """Highest, lowest and average temperature per city and date."""
    return daily_stats_of(_days_by_location(hourly, locations))


def daily_stats_of(placed: DataFrame) -> DataFrame:
    """The same from summaries per place and date."""
    return (
        placed
        .groupBy("country", "state", "city", "date")
        .agg(
            F.max("_max").alias("max_temperature"),
            F.min("_min").alias("min_temperature"),
            _average().alias("average_temperature"),
        )
    )


def monthly_peak(daily: DataFrame, place: list[str]) -> DataFrame:
    """The day or days with the highest temperature of each place and calendar month.

    ``daily`` has the place columns, ``date`` and ``max_temperature`` and may have
    several rows per place and day; once reduced, a group to be ranked has at most 31 rows.
    """
    days = daily.groupBy(*place, "date").agg(F.max("max_temperature").alias("max_temperature"))
    dated = days.withColumns({"year": F.year("date"), "month": F.month("date")})
    month = Window.partitionBy(*place, "year", "month").orderBy(
        F.col("max_temperature").desc_nulls_last()
    )
    return (
        dated.withColumn("_rank", F.rank().over(month))
        .filter((F.col("_rank") == 1) & F.col("max_temperature").isNotNull())
        .select(*place, "year", "month", "date", "max_temperature")
    )


def daily_extremes(hourly: DataFrame, locations: DataFrame, label: str = "city") -> DataFrame:
    """Per day over all locations: average, lowest, and where lowest and highest occurred.

    Of several places with the same temperature the first by name is given.
    """
    return daily_extremes_of(_days_by_location(hourly, locations), label)


def daily_extremes_of(placed: DataFrame, label: str = "city") -> DataFrame:
    """The same from summaries per place and date."""
    by_place = placed.groupBy("date", label).agg(
        F.max("_max").alias("_max"),
        F.min("_min").alias("_min"),
        F.sum("_sum").alias("_sum"),
        F.sum("_count").alias("_count"),
    )
    coldest = F.min(F.when(F.col("_min").isNotNull(), F.struct("_min", label)))
    hottest = F.min(
        F.when(F.col("_max").isNotNull(), F.struct((-F.col("_max")).alias("_neg"), label))
    )
    return by_place.groupBy("date").agg(
        _average().alias("average_temperature"),
        F.min("_min").alias("min_temperature"),
        coldest[label].alias("min_location"),
        hottest[label].alias("max_location"),
    )


def newest_first(mart: DataFrame) -> DataFrame:
    """For the last consumer: dates descending, unknown dates first."""
    return mart.orderBy(F.col("date").desc_nulls_first())
