"""Small derived tables by day, of which only whole days are replaced."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.session import work_folder

#: Up to so many days are named one by one in a filter; more are taken as one span.
NAMED_DAYS = 1000


def days_of(rows: DataFrame, day: str) -> list[dt.date]:
    """The days that occur: all of them, or if there are very many the first and the last. A calendar bounds their number."""
    found = [r[0] for r in rows.select(day).filter(F.col(day).isNotNull()).distinct().orderBy(day).limit(NAMED_DAYS + 1).collect()]
    if len(found) <= NAMED_DAYS:
        return found
    last = rows.agg(F.max(day)).first()[0]
    return [found[0], *found[1:NAMED_DAYS], last]


def among(day: str, days: list[dt.date]) -> Column:
    """A filter on the partition column, known when files are listed."""
    if len(days) <= NAMED_DAYS:
        return F.col(day).isin(days)
    return F.col(day).between(days[0], days[-1])


@dataclass(frozen=True)
class DayTable:
    """A folder of rows partitioned by ``day``."""

    location: str
    schema: T.StructType
    day: str

    @property
    def stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(self.day, T.DateType())])

    def read(self, spark: SparkSession) -> DataFrame:
        spark.createDataFrame([], self.stored).write.mode("ignore").partitionBy(self.day).parquet(self.location)
        return spark.read.schema(self.stored).parquet(self.location)

    def replace(self, rows: DataFrame) -> None:
        """Puts ``rows`` in place of all that is stored for their days; other days' files are not touched.

        The rows are written elsewhere first, as they may be computed from what they replace.
        """
        spark = rows.sparkSession
        folder = work_folder(spark, "days")
        fitted = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.stored.fields])
        fitted.write.parquet(folder)
        staged = spark.read.schema(self.stored).parquet(folder).hint("rebalance", F.col(self.day))
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.day).parquet(self.location)


def days_out_of_step(base: DataFrame, held: DataFrame, day: str) -> list[dt.date]:
    """Days whose number of rows in the base isn't the one held (day, held).

    Counting the base by its partition column reads the ends of its files only.
    """
    counted = base.groupBy(day).agg(F.count("*").alias("rows"))
    both = counted.join(held, day, "full_outer").filter(F.coalesce("rows", F.lit(0)) != F.coalesce("held", F.lit(0)))
    return [r[0] for r in both.select(day).orderBy(day).collect()]
