"""Checks that cost no pass of their own: metrics of a write, taken while it runs, and a merge built on them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.operators.key_bitmaps import KeyBitmaps
from obsflow.operators.merge import SMALL_BATCH, first_per_key, new_keys, new_keys_of_small
from obsflow.operators.quality import QualityError, duplicate_keys, rule_flags
from obsflow.sinks.day_tables import days_of
from obsflow.sinks.tables import BaseTable


def stage_observed(rows: DataFrame, folder: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, dict[str, Any]]:
    """Writes rows to a folder and gives the stored copy, and the metrics (aggregates) of what went by.

    They belong to this one write: a folder is overwritten as a whole, and the metrics of a failed task are not counted.
    """
    watch = Observation()
    # Metric names may be any text; Spark gives them back as field names.
    names = list(metrics)
    watched = rows.observe(watch, *[metrics[name].alias(f"m{k}") for k, name in enumerate(names)])
    watched.write.mode("overwrite").parquet(folder)
    found = watch.get
    stored = rows.sparkSession.read.schema(rows.schema).parquet(folder)
    return stored, {name: found.get(f"m{k}") for k, name in enumerate(names)}


@dataclass(frozen=True)
class Merged:
    """What a merge saw: rows, rows it added, and how many broke each rule. ``added`` is the stored copy of the rows added; if it wasn't kept, they weren't counted either."""

    rows: int
    appended: int | None
    broken: dict[str, int]
    added: DataFrame | None


def merge_observed(
    rows: DataFrame,
    table: BaseTable,
    folder: str,
    on_duplicate: str = "error",
    order_by: list[str] | None = None,
    quarantine: str | None = None,
    bitmaps: KeyBitmaps | None = None,
    flags: Mapping[str, Column] | None = None,
    follow: bool = True,
) -> Merged:
    """Insert-only merge like ``merge_insert_only``, of rows that are expensive to compute.

    They are computed once, into ``folder``, and that write counts what the checks want: rows, nulls, lengths, what breaks one of the further ``flags``
    (conditions over ``rows``), and the span of days. What follows reads the stored columns it needs. A row that breaks a rule fails the merge before the table is touched,
    or goes to the folder ``quarantine``.

    With ``bitmaps`` stored keys are looked up there, whatever the size of the batch; else in the table. ``follow=False`` says that nothing else
    follows the table, so that without bitmaps the rows added need not be kept. The session must run in UTC.
    """
    if on_duplicate not in ("error", "first"):
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")
    spark = rows.sparkSession
    table.create(spark)
    texts = [f.name for f in table.columns if isinstance(f.dataType, T.StringType)]
    rules = rule_flags(table.required, texts) | dict(flags or {})
    if bitmaps is not None:
        rules[f"{table.partition_from} is between two steps"] = bitmaps.off_grain()
    names = F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in rules.items()])) if rules else F.array().cast("array<string>")
    judged = rows.withColumn("broken", names)
    fitted = judged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.columns], "broken")
    if table.partition:
        fitted = fitted.withColumn(table.partition, F.to_date(table.partition_from))
    metrics = {"rows": F.count(F.lit(1))} | {name: F.count_if(F.array_contains("broken", name)) for name in rules}
    if table.partition:
        good_day = F.when(F.size("broken") == 0, F.col(table.partition))
        metrics |= {"low": F.min(good_day), "high": F.max(good_day)}
    staged, found = stage_observed(fitted, f"{folder}/rows", metrics)
    broken = {name: found[name] for name in rules if found[name]}
    if quarantine is not None:
        staged.filter(F.size("broken") > 0).write.mode("overwrite").json(quarantine)
    elif broken:
        raise QualityError(f"rows breaking a rule: {broken}")
    batch = staged.filter(F.size("broken") == 0).drop("broken")
    if on_duplicate == "first":
        batch = first_per_key(batch, table.keys, order_by)
    elif not duplicate_keys(batch, table.keys).isEmpty():
        raise QualityError(f"key {table.keys} occurs more than once in the batch")
    if bitmaps is not None:
        days = days_of(staged.filter(F.size("broken") == 0), table.partition)
        bitmaps.heal(spark, days)
        fresh = bitmaps.absent(batch, days)
    else:
        target, keys = table.read(spark), table.keys
        if table.partition:
            # The partition value follows from the key, so only the days of the batch can hold one of its keys.
            target = target.filter(F.col(table.partition).between(found["low"], found["high"]))
            keys = [*keys, table.partition]
        find = new_keys_of_small if (found["rows"] or 0) <= SMALL_BATCH else new_keys
        fresh = find(batch, target, keys)
    if bitmaps is None and not follow:
        table.append(fresh)
        return Merged(found["rows"] or 0, None, broken, None)
    # Stored once more, so that what is appended and what follows the table get the same rows.
    added, counted = stage_observed(fresh, f"{folder}/added", {"added": F.count(F.lit(1))})
    if counted["added"]:
        table.append(added)
        if bitmaps is not None:
            bitmaps.add(added)
    return Merged(found["rows"] or 0, counted["added"] or 0, broken, added)
