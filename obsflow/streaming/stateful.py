"""Loading with the keys of the last days in the state store: the first writer wins without reading the base table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.session import pin_utc
from obsflow.sinks.tables import BaseTable

#: A run asks for so many trailing days; neighbouring runs share all but one.
TRAILING_DAYS = 5


@dataclass(frozen=True)
class LoadReport:
    """Rows a run read, rows that came too late to be compared and were left out, and keys it holds in state at its end."""

    read: int
    late: int
    keys_held: int


def first_seen(rows: DataFrame, keys: list[str], moment: str, days: int = TRAILING_DAYS) -> DataFrame:
    """Of a stream, the first row of each key; ``moment`` is the key column that time is told by.

    A key is remembered until the watermark, the latest moment less ``days``, has passed its moment by as much again. So a row that a later run brings again within
    the trailing days is dropped, a row from before the watermark is left out and counted, and the state is bounded by the keys of
    that span however long the stream runs. Of equal keys in one batch any may be the first.
    """
    if moment not in keys:
        raise ValueError(f"{moment} is no part of the key")
    return rows.withWatermark(moment, f"{days} days").dropDuplicatesWithinWatermark(keys)


def load_first_seen(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    table: BaseTable,
    checkpoint: str,
    days: int = TRAILING_DAYS,
    files_per_batch: int | None = None,
) -> LoadReport:
    """Append what a landing folder of JSON rows brings that is new, taking each file once, and stop.

    The table's folder is written by the streaming file sink, whose log names the files of each batch: a batch that is repeated after a
    failure adds nothing twice, and readers see whole batches only. The checkpoint keeps files and keys across restarts.
    """
    if not table.is_path or not table.partition:
        raise ValueError("the file sink needs a folder that is stored by day")
    pin_utc(spark)
    source = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch is not None:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    rows = table.conform(first_seen(source.json(landing), table.keys, table.partition_from, days))
    query = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", table.location)
        .partitionBy(table.partition)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    progress = [p.jsonValue if hasattr(p, "jsonValue") else p for p in query.recentProgress]
    state = [p["stateOperators"][0] for p in progress if p["stateOperators"]]
    return LoadReport(
        sum(p["numInputRows"] for p in progress),
        sum(s["numRowsDroppedByWatermark"] for s in state),
        state[-1]["numRowsTotal"] if state else 0,
    )


def read_loaded(spark: SparkSession, table: BaseTable) -> DataFrame:
    """What the loads have stored, by the log of the file sink."""
    return spark.read.schema(table.stored).parquet(table.location).select(*table.stored.names)


def late_rows(rows: DataFrame, moment: str, days: int = TRAILING_DAYS, latest: str = "latest") -> DataFrame:
    """Rows of a batch from before the watermark that a stream has at the moment ``latest``, a column: what it would leave out."""
    return rows.filter(F.col(moment) < F.col(latest) - F.expr(f"INTERVAL {days} DAYS"))
