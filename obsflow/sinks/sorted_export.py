"""Files in a total order, written by many tasks: reading them by name gives the rows in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.functions.scalars import escape_breaks
from obsflow.sources.tables import read_headerless_csv

#: The part of a file's name that tells its place.
PART = r"part-([0-9]+)"


def in_order(rows: DataFrame, order: list[Column], parts: int) -> DataFrame:
    """Rows cut into ``parts`` ranges of about equal size by a sample of the order, each sorted.

    A value of the first columns that very many rows share would fall into one range; so a hash of the whole row comes last in the order and cuts it further. Rows
    that are equal in ``order`` come out in the order of that hash.
    """
    tie = F.xxhash64(*rows.columns).asc()
    full = [*order, tie]
    return rows.repartitionByRange(parts, *full).sortWithinPartitions(*full)


def write_sorted_csv(rows: DataFrame, path: str, order: list[Column], parts: int) -> None:
    """Overwrite a folder of headerless CSV whose part files, by name, hold the rows in order."""
    names = {f.name: escape_breaks(F.col(f"`{f.name}`")) for f in rows.schema.fields if isinstance(f.dataType, T.StringType)}
    options = dict(header=False, sep=",", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    in_order(rows, order, parts).withColumns(names).write.mode("overwrite").options(**options).csv(path)


def part_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(part, rows) of such a folder."""
    part = F.regexp_extract("_metadata.file_name", PART, 1).cast("int").alias("part")
    return spark.read.text(path).groupBy(part).agg(F.count("*").alias("rows"))


def read_sorted_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows with ``place``, their number in the order of the files' names and lines, from 1.

    Lines are numbered within each part, and parts are placed by what the parts before them hold: one row each.
    """
    part = F.regexp_extract("_metadata.file_name", PART, 1).cast("int").alias("_part")
    # Pieces of one file are told apart by where they start; within a piece lines come in order.
    lines = read_headerless_csv(spark, path, schema).select(
        *schema.names, part, F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line")
    )
    within = F.row_number().over(Window.partitionBy("_part").orderBy("_block", "_line"))
    sizes = lines.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", before.alias("_before"))
    numbered = lines.withColumn("_within", within).join(starts, "_part")
    return numbered.select(*schema.names, (F.col("_before") + F.col("_within")).alias("place"))
