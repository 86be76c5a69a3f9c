"""Marts that are kept up to date from what a load adds, instead of being computed from all observations.

Stored is one summary per rounded place and day: highest, lowest, sum and number of values, and number of rows. Summaries of summaries are
exact, so a batch's own are put together with the stored ones of its days, and only those days are written anew. Days that are out of
step with the base table, after a run that died in between, are summarised again from it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.operators.rounded_join import ROUNDED_KEY, with_rounded_key
from obsflow.plans.marts import daily_extremes_of, daily_max_of, daily_stats_of, monthly_peak, placed_days, summarize
from obsflow.sinks.day_tables import DayTable, among, days_of, days_out_of_step
from obsflow.sinks.tables import BaseTable

SUMMARY = ["_max", "_min", "_sum", "_count", "_rows"]


def _parts(rows: DataFrame, day: str) -> DataFrame:
    keyed = with_rounded_key(rows)
    days = summarize(keyed, [*ROUNDED_KEY, day], also={"_rows": F.count("*")})
    return days.withColumn("_sum", F.col("_sum").cast("decimal(38,6)"))


def _together(parts: DataFrame, day: str) -> DataFrame:
    return parts.groupBy(*ROUNDED_KEY, day).agg(
        F.max("_max").alias("_max"),
        F.min("_min").alias("_min"),
        F.sum("_sum").cast("decimal(38,6)").alias("_sum"),
        F.sum("_count").alias("_count"),
        F.sum("_rows").alias("_rows"),
    )


@dataclass(frozen=True)
class DaySummaries:
    """Summaries of ``base`` per place and day in the folder ``location``."""

    base: BaseTable
    location: str

    def _table(self, spark: SparkSession) -> DayTable:
        shape = _parts(spark.createDataFrame([], self.base.stored), self.base.partition).schema
        return DayTable(self.location, T.StructType([f for f in shape.fields if f.name != self.base.partition]), self.base.partition)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._table(spark).read(spark).filter("_rows > 0")

    def update(self, added: DataFrame) -> list[dt.date]:
        """Takes in rows that were appended to the base. Gives the days written anew."""
        spark, day = added.sparkSession, self.base.partition
        days = days_of(added, day)
        if not days:
            return []
        table = self._table(spark)
        stored = table.read(spark).filter(among(day, days))
        table.replace(_together(stored.unionByName(_parts(added, day)), day))
        return days

    def heal(self, spark: SparkSession, days: list[dt.date] | None = None) -> list[dt.date]:
        """Summarises the days that are out of step anew from the base. Gives those days."""
        day, table = self.base.partition, self._table(spark)
        wanted = F.lit(True) if days is None else among(day, days)
        held = table.read(spark).filter(wanted).groupBy(day).agg(F.sum("_rows").alias("held"))
        wrong = days_out_of_step(self.base.read(spark).filter(wanted), held, day)
        for first in range(0, len(wrong), 1000):
            part = wrong[first : first + 1000]
            built = _parts(self.base.read(spark).filter(F.col(day).isin(part)), day)
            empty = spark.createDataFrame([(d,) for d in part], f"`{day}` date").join(built, day, "left_anti")
            table.replace(built.unionByName(empty.withColumn("_rows", F.lit(0)), allowMissingColumns=True))
        return wrong

    def placed(self, spark: SparkSession, locations: DataFrame) -> DataFrame:
        days = self.read(spark).withColumnRenamed(self.base.partition, "date")
        return placed_days(days, locations)


def kept_marts(spark: SparkSession, summaries: DaySummaries, locations: DataFrame) -> dict[str, DataFrame]:
    """The daily marts, the monthly peaks and the daily extremes over the stored summaries: no observation is read."""
    placed = summaries.placed(spark, locations)
    highest = daily_max_of(placed)
    return {
        "daily_max": highest,
        "daily_stats": daily_stats_of(placed),
        "monthly_peak": monthly_peak(highest, ["country", "state", "city"]),
        "daily_extremes": daily_extremes_of(placed),
    }
