"""Fingerprints of multisets of rows: equal for the same rows in any order, and summable over parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRINT = ("n", "hash_sum", "hash_xor")


def unit_hash(text: Column) -> Column:
    return F.xxhash64(text)


def fingerprint(rows: DataFrame, by: list[str], unit: Column) -> DataFrame:
    """n, hash_sum and hash_xor of the units of each group; each task sends one row per group it holds."""
    hashed = rows.select(*by, unit_hash(unit).alias("_hash"))
    return hashed.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sum(F.col("_hash").cast("decimal(38,0)")).alias("hash_sum"),
        F.expr("bit_xor(_hash)").alias("hash_xor"),
    )


def combined(prints: DataFrame, by: list[str]) -> DataFrame:
    """The fingerprint of the union of what several fingerprints stand for."""
    return prints.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("hash_sum").cast("decimal(38,0)").alias("hash_sum"),
        F.expr("bit_xor(hash_xor)").alias("hash_xor"),
    )


def balance(whole: DataFrame, parts: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """For each group the number of units of the whole and of each part, and whether the parts make up the whole.

    ``whole`` and ``parts`` are fingerprints. A group that only one side has counts as zero on the other.
    """
    tagged = [
        frame.select(*by, F.lit(name).alias("_part"), F.col("n").cast("long").alias("n"), F.col("hash_sum").cast("decimal(38,0)").alias("hash_sum"), "hash_xor")
        for name, frame in {"": whole, **parts}.items()
    ]
    rows = tagged[0]
    for frame in tagged[1:]:
        rows = rows.unionByName(frame)
    is_whole = F.col("_part") == ""

    def count(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_part") == name, F.col("n"))), F.lit(0)).cast("long")

    def signed(column: str) -> Column:
        return F.coalesce(F.sum(F.when(is_whole, F.col(column)).otherwise(-F.col(column))), F.lit(0)) == 0

    # The xor of all is zero if the parts' is that of the whole.
    same = signed("n") & signed("hash_sum") & (F.coalesce(F.expr("bit_xor(hash_xor)"), F.lit(0)) == 0)
    return rows.groupBy(*by).agg(count("").alias("landed"), *[count(name).alias(name) for name in parts], same.alias("balanced"))
