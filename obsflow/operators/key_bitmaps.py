"""Stored key bitmaps: whether a table holds a key is one bit, so a merge need not read the table.

For a table whose key is a place and a moment, the moments of a day are numbered in steps of ``grain`` seconds; the numbers that occur are bits of
64-bit words. A word is a row (place, day, word, bits): at an hourly grain one row for 24 keys. Words rather than
``bitmap_construct_agg``, whose bitmaps take 4 KB each whatever they hold.

Bitmaps follow the table. A run that died between the two leaves days out of step, which the number of rows of each day tells; those
days are built anew from the table before the bitmaps are used.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.sinks.day_tables import DayTable, among, days_of, days_out_of_step
from obsflow.sinks.tables import BaseTable

WORD = 64
DAY_SECONDS = 86_400


@dataclass(frozen=True)
class KeyBitmaps:
    """Bitmaps of the keys of ``table`` in the folder ``location``."""

    table: BaseTable
    location: str
    grain: int = 3600

    def __post_init__(self) -> None:
        if self.table.partition_from not in self.table.keys:
            raise ValueError("the table must be stored by the day of a key column")
        if self.grain < 1 or DAY_SECONDS % self.grain:
            raise ValueError(f"a day is no multiple of {self.grain} seconds")

    @property
    def place(self) -> list[str]:
        return [k for k in self.table.keys if k != self.table.partition_from]

    @property
    def _words(self) -> DayTable:
        fields = [f for f in self.table.columns if f.name in self.place]
        schema = T.StructType([*fields, T.StructField("word", T.IntegerType()), T.StructField("bits", T.LongType())])
        return DayTable(self.location, schema, self.table.partition)

    def off_grain(self) -> Column:
        """Whether a row's moment lies between two steps and so has no bit; such a row breaks a rule."""
        return F.unix_micros(self.table.partition_from) % (self.grain * 1_000_000) != 0

    def _coded(self, rows: DataFrame) -> DataFrame:
        step = F.expr(f"pmod(unix_seconds(`{self.table.partition_from}`), {DAY_SECONDS}) DIV {self.grain}")
        return rows.withColumn("_step", step.cast("int")).withColumns(
            {"word": F.expr(f"CAST(_step DIV {WORD} AS INT)"), "_bit": F.expr(f"shiftleft(1L, _step % {WORD})")}
        ).drop("_step")

    def _set(self, rows: DataFrame, bit: str) -> DataFrame:
        return rows.groupBy(*self.place, "word", self.table.partition).agg(F.bit_or(bit).alias("bits"))

    def absent(self, rows: DataFrame, days: list[dt.date] | None = None) -> DataFrame:
        """The rows whose key the table does not hold. Reads the bitmaps of their days (``days``, if known), and nothing of the table."""
        day = self.table.partition
        held = self._words.read(rows.sparkSession).filter(among(day, days_of(rows, day) if days is None else days))
        joined = self._coded(rows).join(held, [*self.place, "word", day], "left")
        return joined.filter((F.coalesce("bits", F.lit(0)).bitwiseAND(F.col("_bit"))) == 0).select(*rows.columns)

    def add(self, rows: DataFrame) -> None:
        """Takes in rows that were appended to the table; rewrites the bitmaps of their days."""
        day = self.table.partition
        days = days_of(rows, day)
        if not days:
            return
        stored = self._words.read(rows.sparkSession).filter(among(day, days))
        fresh = self._set(self._coded(rows), "_bit")
        self._words.replace(self._set(stored.unionByName(fresh), "bits"))

    def out_of_step(self, spark: SparkSession, days: list[dt.date] | None = None) -> list[dt.date]:
        """Days whose bitmaps hold another number of keys than the table has rows."""
        day = self.table.partition
        wanted = F.lit(True) if days is None else among(day, days)
        held = self._words.read(spark).filter(wanted).groupBy(day).agg(F.sum(F.bit_count("bits")).alias("held"))
        return days_out_of_step(self.table.read(spark).filter(wanted), held, day)

    def heal(self, spark: SparkSession, days: list[dt.date] | None = None) -> list[dt.date]:
        """Builds the bitmaps of days that are out of step anew from the table. Gives those days."""
        day = self.table.partition
        wrong = self.out_of_step(spark, days)
        for first in range(0, len(wrong), 1000):
            part = wrong[first : first + 1000]
            built = self._set(self._coded(self.table.read(spark).filter(F.col(day).isin(part))), "_bit")
            # A day that the table has lost altogether keeps one row without bits.
            empty = spark.createDataFrame([(d,) for d in part], f"`{day}` date").join(built, day, "left_anti")
            self._words.replace(built.unionByName(empty.withColumn("bits", F.lit(0)), allowMissingColumns=True))
        return wrong
