"""An equi-join whose hot keys are spread over many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot when it holds more than this share of the rows, and is split into parts of about that share.
HOT_SHARE = 500


def hot_keys(rows: DataFrame, keys: list[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys that hold more than one row in ``share``, with ``parts``, how many times as many they hold.

    There can be fewer than ``share`` of them, whatever the size of the input, and so can there be parts.
    """
    total = rows.agg(F.count("*").alias("rows")).scalar()
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    return counts.filter(F.col("_n") * share > total).select(*keys, F.ceil(F.col("_n") * share / total).cast("int").alias("parts"))


def salted_join(
    facts: DataFrame,
    dimension: DataFrame,
    keys: list[str],
    how: str = "inner",
    share: int = HOT_SHARE,
    spread: int | None = None,
) -> DataFrame:
    """``facts`` joined to ``dimension``; only hot keys are salted.

    For joins that adaptive execution can't split: those whose result goes on partitioned by the key, as into an aggregate or a
    further join by it, where splitting would cost another shuffle. Others are better left to it.

    A key is split in proportion to its rows, or ``spread`` ways. The rows of a hot key get a salt from a hash of the whole row (the same on a retried
    task), and the dimension rows of that key are repeated once per salt. Broadcast is
    limited to the list of hot keys, whose length is bounded by ``share``.
    """
    if how not in ("inner", "left"):
        raise ValueError("hot keys can be salted in an inner or left join")
    ways = F.col("parts") if spread is None else F.lit(spread)
    hot = F.broadcast(hot_keys(facts.select(*keys), keys, share).select(*keys, ways.alias("_spread")))
    hashed = [f.name for f in facts.schema.fields if not isinstance(f.dataType, T.MapType)]
    salt = F.pmod(F.xxhash64(*hashed), F.col("_spread")).cast("int")
    spread_facts = facts.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_spread").isNotNull(), salt).otherwise(F.lit(0))
    )
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("_spread", F.lit(1)) - 1))
    spread_dimension = dimension.join(hot, keys, "left").withColumn("_salt", salts)
    return spread_facts.drop("_spread").join(
        spread_dimension.drop("_spread"), [*keys, "_salt"], how
    ).drop("_salt")
