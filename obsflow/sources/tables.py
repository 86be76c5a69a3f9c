"""Reading stored tables, views and remote databases."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.functions.scalars import restore_breaks


def read_layer(
    spark: SparkSession, root: str, layer: str, entity: str, fmt: str = "parquet"
) -> DataFrame:
    """One entity of a raw / bronze / silver / gold folder tree."""
    return spark.read.format(fmt).load(layer_path(root, layer, entity))


def layer_path(root: str, layer: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{entity}"


def read_query(
    spark: SparkSession, sql: str, jdbc: Mapping[str, str] | None = None
) -> DataFrame:
    """The result of a query text.

    The Spark catalog answers it by default. With ``jdbc`` options (url, driver, user,
    password, ...) the text goes to that database, which runs joins, aggregates and sorts
    itself. That read has one partition; use ``read_remote_ranges`` for a large table.
    """
    if jdbc is None:
        return spark.sql(sql)
    return spark.read.format("jdbc").options(**jdbc).option("query", sql).load()


def read_remote_ranges(
    spark: SparkSession,
    table: str,
    jdbc: Mapping[str, str],
    column: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
) -> DataFrame:
    """A remote table read by many tasks, each with its own range of ``column``.

    ``lower`` and ``upper`` only place the cuts: rows outside them are read too.
    """
    return (
        spark.read.format("jdbc")
        .options(**jdbc)
        .option("dbtable", table)
        .option("partitionColumn", column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(partitions))
        .load()
    )


def read_headerless_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, corrupt: str | None = None
) -> DataFrame:
    """Comma-separated files without a header, as ``write_headerless_csv`` leaves them; an empty field is null.

    A row with too few or too many fields, or with one that doesn't fit its type, fails the read. With
    ``corrupt`` it is kept instead, its whole line in a column of that name, which is null in good rows.
    """
    wanted = schema if corrupt is None else T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    reader = spark.read.schema(wanted).options(
        header=False,
        sep=",",
        escape='"',
        nullValue="",
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        enforceSchema=True,
        mode="FAILFAST" if corrupt is None else "PERMISSIVE",
    )
    if corrupt is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    rows = reader.csv(path)
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return rows.withColumns({c: restore_breaks(F.col(f"`{c}`")) for c in texts})
