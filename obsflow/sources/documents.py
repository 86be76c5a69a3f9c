"""Scans of landed JSON: weather documents and resource bundles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.functions.scalars import is_blank
from obsflow.schemas import CORRUPT_COLUMN, WEATHER_DOCUMENT


def read_weather_documents(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """All documents of a folder, one JSON object per line, or per file over any number of lines with ``multiline``.

    The schema is fixed, so there is no inference pass and an error payload cannot
    shift columns. Text that is no JSON lands in the corrupt column. Which fields a
    query touches decides what the parser looks at, so screen documents
    only on a frame that keeps every column (or on a stored copy of it).
    """
    return (
        spark.read.schema(WEATHER_DOCUMENT)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("multiLine", multiline)
        .json(path)
    )


def with_lineage(documents: DataFrame) -> DataFrame:
    """Say for each row of a file scan which file it came from."""
    return documents.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_modified"),
    )


def read_bundles(
    spark: SparkSession,
    path: str | list[str],
    entry_type: T.StructType | None = None,
    layout: str = "auto",
) -> DataFrame:
    """Bundles of one resource folder as ``total`` and ``entry``.

    With ``entry_type`` there is no inference pass, and two layouts are understood:

    * plain: ``{"total": 2, "entry": [..]}``
    * columnar: ``{"total": {"0": 2}, "entry": {"0": [..]}}``, one or more row labels

    ``layout="auto"`` accepts both, even mixed in one folder, and gives an array of pages;
    it looks at each entry as text first. A folder of one known layout is parsed
    in one go, and ``entry`` is then an array of entries or a map of row label to such.
    Without ``entry_type`` the schema is inferred over the whole folder.
    """
    if layout not in ("auto", "plain", "columnar"):
        raise ValueError(f"unknown layout: {layout}")
    if entry_type is None:
        return spark.read.json(path)
    page = T.ArrayType(entry_type)
    labelled = T.MapType(T.StringType(), page)
    if layout == "plain":
        return spark.read.schema(_bundle(T.LongType(), page)).json(path)
    if layout == "columnar":
        totals = T.MapType(T.StringType(), T.LongType())
        return spark.read.schema(_bundle(totals, labelled)).json(path).withColumn(
            "total", _sum(F.map_values("total"))
        )
    raw = spark.read.schema(_bundle(T.StringType(), T.StringType())).json(path)
    text = F.ltrim("entry")
    pages = F.when(
        F.startswith(text, F.lit("{")), F.map_values(F.from_json("entry", labelled))
    ).otherwise(F.array(F.from_json("entry", page)))
    totals = F.map_values(F.from_json("total", T.MapType(T.StringType(), T.LongType())))
    total = F.when(F.startswith(F.ltrim("total"), F.lit("{")), _sum(totals)).otherwise(
        F.col("total").try_cast("long")
    )
    return raw.select(total.alias("total"), F.when(F.col("entry").isNotNull(), pages).alias("entry"))


def read_bundle_variants(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """Landed bundles whole: source_file, text, and bundle as VARIANT, null where the text is no JSON.

    Nothing is inferred or declared, so no field is lost and the folder is read once. A document is a line, or a file
    with ``multiline``. Blank lines are no documents.
    """
    lines = spark.read.text(path, wholetext=multiline)
    named = lines.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("text"))
    return named.filter(~F.coalesce(is_blank(F.col("text")), F.lit(True))).withColumn("bundle", F.try_parse_json("text"))


def _bundle(total: T.DataType, entry: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("total", total), T.StructField("entry", entry)])


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda acc, n: acc + F.coalesce(n, F.lit(0)))
