"""Base tables, layer tables and views."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.sources.tables import layer_path


@dataclass(frozen=True)
class BaseTable:
    """A parquet table with declared columns and key, at a path or in the catalog.

    ``location`` is a folder when it holds a slash, else a table name. ``partition`` is a
    stored date column: the day of the key column ``partition_from``.
    """

    location: str
    schema: T.StructType
    keys: list[str]
    required: list[str] = field(default_factory=list)
    partition: str | None = None
    partition_from: str | None = None

    @property
    def is_path(self) -> bool:
        return "/" in self.location

    @property
    def columns(self) -> list[T.StructField]:
        return self.schema.fields

    @property
    def stored(self) -> T.StructType:
        extra = [T.StructField(self.partition, T.DateType())] if self.partition else []
        return T.StructType([*self.schema.fields, *extra])

    def create(self, spark: SparkSession) -> None:
        """Create the table unless it exists."""
        if self.is_path:
            writer = spark.createDataFrame([], self.stored).write.mode("ignore")
            if self.partition:
                writer = writer.partitionBy(self.partition)
            writer.parquet(self.location)
        else:
            create_table(spark, self.location, self.stored, self.partition)

    def read(self, spark: SparkSession) -> DataFrame:
        if self.is_path:
            return spark.read.schema(self.stored).parquet(self.location)
        return spark.table(self.location)

    def conform(self, rows: DataFrame) -> DataFrame:
        """Columns of the table, by name, plus the partition column."""
        out = rows.select(*self.schema.names)
        if self.partition:
            out = out.withColumn(self.partition, F.to_date(self.partition_from))
        return out

    def append(self, rows: DataFrame) -> None:
        """Add conformed rows.

        A rebalance by partition value keeps files few and still splits a value
        that holds much of the batch over several tasks. The writer sorts by partition
        value anyway; sorting by key as well makes files compress and skip better.
        """
        if self.partition:
            rows = rows.hint("rebalance", F.col(self.partition))
            rows = rows.sortWithinPartitions(self.partition, *self.keys)
        if self.is_path:
            writer = rows.write.mode("append")
            if self.partition:
                writer = writer.partitionBy(self.partition)
            writer.parquet(self.location)
        else:
            rows.select(*self.stored.names).write.mode("append").insertInto(self.location)


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, partition: str | None = None
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioning = f" PARTITIONED BY (`{partition}`)" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partitioning}")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def reload_table(rows: DataFrame, name: str) -> None:
    """Empty a staging table, then load a batch into it."""
    truncate_table(rows.sparkSession, name)
    columns = rows.sparkSession.table(name).columns
    rows.select(*columns).write.mode("append").insertInto(name)


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """A stored view over catalog tables."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def publish_view(rows: DataFrame, name: str) -> None:
    """A view for this session over any frame."""
    rows.createOrReplaceTempView(name)


def write_layer(
    rows: DataFrame,
    root: str,
    layer: str,
    entity: str,
    fmt: str = "parquet",
    evolve: bool = False,
) -> str:
    """Overwrite one entity of a layer.

    With ``evolve`` columns that only the stored table has are kept, as nulls, so readers of
    the old columns go on working. A format that merges schemas itself is told to.
    """
    path = layer_path(root, layer, entity)
    writer_options = {}
    if evolve and fmt == "delta":
        writer_options["mergeSchema"] = "true"
    elif evolve:
        rows = _with_stored_columns(rows, path, fmt)
    rows.write.format(fmt).mode("overwrite").options(**writer_options).save(path)
    return path


def _with_stored_columns(rows: DataFrame, path: str, fmt: str) -> DataFrame:
    spark = rows.sparkSession
    try:
        stored = spark.read.format(fmt).load(path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return rows
        raise
    # Only the stored schema is used: the plan must not read what it overwrites.
    return spark.createDataFrame([], stored).unionByName(rows, allowMissingColumns=True)
