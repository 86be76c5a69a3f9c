"""Insert-only merge: a stored key is never touched again."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.operators.quality import assert_clean, rule_flags, split_by_rules
from obsflow.sinks.tables import BaseTable

# A batch of up to so many rows is looked for in the target; a larger one is compared with all of it.
SMALL_BATCH = 1_000_000
# Up to so many keys that a large batch repeats are sent to every task.
FEW_REPEATED = 100_000


def except_rows(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Distinct rows of the batch that the target does not hold, nulls being equal.

    Both sides are tagged, put together and grouped by all columns. That is one shuffle,
    before which each task collapses its copies, and equal rows meet without a join.
    """
    columns = batch.columns
    tagged = batch.withColumn("_stored", F.lit(False)).unionByName(
        target.select(*columns).withColumn("_stored", F.lit(True))
    )
    return (
        tagged.groupBy(*columns)
        .agg(F.bool_or("_stored").alias("_stored"))
        .filter(~F.col("_stored"))
        .select(*columns)
    )


def first_per_key(
    batch: DataFrame, keys: list[str], order_by: list[str] | None = None
) -> DataFrame:
    """The first row of each key.

    Ties in ``order_by`` are settled by all other columns, so the outcome does not depend
    on partitioning. Spark keeps one row per key in each task before it shuffles, which
    takes the weight off hot keys.
    """
    order = list(order_by or [])
    order += [
        f.name for f in batch.schema.fields
        if f.name not in keys and f.name not in order and not isinstance(f.dataType, T.MapType)
    ]
    order = order or keys
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return batch.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def new_keys(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch whose key the target does not hold.

    Target keys are made distinct, so a key the target holds very often costs one row per
    task. The shuffle this takes is the one the join needs anyway.
    """
    return batch.join(target.select(*keys).distinct(), keys, "left_anti")


def new_keys_of_small(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """The same for a batch that is small beside the target, whose keys are unique.

    The target is first cut to the keys of the batch. That join may build its right side, so
    for a batch of a size that Spark broadcasts the target is only scanned, not shuffled.
    """
    held = target.select(*keys).join(batch.select(*keys), keys, "left_semi")
    return batch.join(held, keys, "left_anti")


def seen_keys(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Each key of the batch, how many of its rows have it, and whether the target holds it.

    Only keys are shuffled, each once per task. A key with a null is never held, as in a join.
    """
    tagged = batch.select(*keys, F.lit(1).alias("_rows"), F.lit(False).alias("_held")).unionByName(
        target.select(*keys, F.lit(0).alias("_rows"), F.lit(True).alias("_held"))
    )
    whole = reduce(and_, (F.col(k).isNotNull() for k in keys))
    seen = tagged.groupBy(*keys).agg(F.sum("_rows").alias("_rows"), F.bool_or("_held").alias("_held"))
    return seen.filter("_rows > 0").withColumn("_held", F.col("_held") & whole)


def first_of_repeated(
    batch: DataFrame, repeated: DataFrame, keys: list[str], order_by: list[str] | None = None
) -> DataFrame:
    """What ``first_per_key`` gives, if only the few keys in ``repeated`` occur more than once.

    Rows of all other keys are neither shuffled nor sorted.
    """
    again = F.broadcast(repeated.select(*[F.col(k).alias(f"_again_{k}") for k in keys]))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_again_{k}")) for k in keys))
    firsts = first_per_key(batch.join(again, same, "left_semi"), keys, order_by)
    return batch.join(again, same, "left_anti").unionByName(firsts)


def new_rows(
    batch: DataFrame, target: DataFrame, keys: list[str], order_by: list[str] | None = None
) -> DataFrame:
    """What an insert that skips stored keys would add.

    Stored rows are unique by key, so removing rows that are stored as they are first
    would change nothing; ``except_rows`` is there for those who want just that.
    """
    return new_keys(first_per_key(batch, keys, order_by), target, keys)


def merge_insert_only(
    batch: DataFrame,
    table: BaseTable,
    on_duplicate: str = "error",
    order_by: list[str] | None = None,
    quarantine: str | None = None,
) -> None:
    """Append the rows whose key is not stored yet. First writer wins.

    A row that breaks a rule of the table fails the merge. With ``quarantine``, a folder, such rows
    are written there instead, as JSON with the rules they break, and the others are merged.

    ``on_duplicate="error"`` refuses a batch that repeats a key; ``"first"`` keeps the first
    row by ``order_by``. The batch is read several times, so pass a stored table, not a
    frame that parses text. A large batch is shuffled whole only if many of its keys repeat or some are stored.
    One writer per table: two merges at once could both add a key.
    """
    if on_duplicate not in ("error", "first"):
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")
    spark = batch.sparkSession
    table.create(spark)
    batch = table.conform(batch)
    target = table.read(spark)
    texts = [f.name for f in table.columns if isinstance(f.dataType, T.StringType)]
    unique = table.keys if on_duplicate == "error" else None
    span = {}
    if table.partition is not None:
        span = {"low": F.min(table.partition), "high": F.max(table.partition)}
    if quarantine is not None:
        batch, broken = split_by_rules(batch, rule_flags(table.required, texts))
        broken.write.mode("overwrite").json(quarantine)
    found = assert_clean(batch, table.required, texts, unique, **span)
    if found["rows"] == 0:
        return
    if span:
        # The partition value follows from the key, so only the partitions the
        # batch spans can hold one of its keys.
        target = target.filter(F.col(table.partition).between(found["low"], found["high"]))
    # It is part of the join as well, so that of a wide span only the days that occur are read.
    keys = [*table.keys, table.partition] if span else table.keys
    if found["rows"] <= SMALL_BATCH:
        if on_duplicate == "first":
            batch = first_per_key(batch, table.keys, order_by)
        table.append(new_keys_of_small(batch, target, keys))
        return
    # Of a large batch the keys are looked at first: often all or none of them are stored, and few repeat.
    seen = seen_keys(batch, target, keys)
    fresh = seen.filter("NOT _held")
    counts = seen.agg(
        F.count_if(~F.col("_held")).alias("fresh"),
        F.count_if(F.col("_held")).alias("held"),
        F.count_if(~F.col("_held") & (F.col("_rows") > 1)).alias("repeated"),
    ).first()
    if counts["fresh"] == 0:
        return
    if on_duplicate == "first" and counts["repeated"] > FEW_REPEATED:
        batch = first_per_key(batch, table.keys, order_by)
    elif on_duplicate == "first" and counts["repeated"]:
        batch = first_of_repeated(batch, fresh.filter("_rows > 1"), table.keys, order_by)
    table.append(new_keys(batch, target, keys) if counts["held"] else batch)
