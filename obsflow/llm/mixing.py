"""Mixing sources to target weights by balanced sampling (the cube method).

A source whose target is r times its size takes every document floor(r) times, and one time more with
probability r - floor(r). Those extra takes are drawn so that both the number of documents and the number of words taken from a
source come out as expected: in the flight phase, three undecided documents at a time move their probabilities along the
null-space of the two constraints until one of them is 0 or 1. That is done in blocks of bounded size, cut from each source by
a hash; each leaves at most two documents undecided. Those are dealt to blocks anew until a source is one block. Its last few
are a small problem that is settled by trying all ways (the landing phase), nearest to the target first: for these LAST documents the exact
probability gives way to the total.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.llm.staging import cut
from obsflow.llm.words import mix

#: Weights in turn over the sources by name.
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
BLOCK_ROWS = 20_000
#: Documents of a source that the landing phase settles at most.
LAST = 16
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, get the weights in turn. Targets share the sum of all sizes by weight;
    what a target has above ``most`` times its source's size is shared out again by weight among the others. That ends at
    min(most * size, level * weight) for one level, found by sorting sources by the level at which they are full.
    """
    listed = "array(" + ", ".join(f"{w}D" for w in weights) + ")"
    ranked = sizes.selectExpr(
        "source",
        "source_size",
        f"element_at({listed}, CAST(pmod(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1, {len(weights)}) + 1 AS INT)) AS weight",
        f"CAST({most} * source_size AS DOUBLE) AS full",
    )
    filled = ranked.selectExpr(
        "*",
        "CAST(sum(source_size) OVER () AS DOUBLE) AS total",
        "coalesce(sum(full) OVER (ORDER BY full / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0D) AS below",
        "sum(weight) OVER (ORDER BY full / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open",
    )
    # With the sources below this one full, the level of the others; it is highest where no further one gets full.
    level = filled.selectExpr("*", "max((total - below) / open) OVER () AS shared")
    return level.selectExpr("source", "source_size", "least(shared * weight, full) AS target")


def _unit(key: np.ndarray) -> np.ndarray:
    return (mix(key) >> np.uint64(11)).astype(np.float64) / 2.0**53


def flight(share: np.ndarray, size: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Shares moved until at most two are strictly between 0 and 1; their sum and the sum of share * size stay.

    ``chance`` has a number in [0, 1) for each element, which decides the direction of a step.
    """
    share = share.astype(np.float64).copy()
    held: list[int] = []
    for new in np.flatnonzero((share > 0) & (share < 1)).tolist():
        held.append(new)
        while len(held) == 3:
            a, b, c = held
            step = np.array([size[c] - size[b], size[a] - size[c], size[b] - size[a]], dtype=np.float64)
            if not step.any():
                step = np.array([1.0, -1.0, 0.0])
            at = share[held]
            with np.errstate(divide="ignore"):
                up = np.where(step > 0, (1 - at) / step, np.where(step < 0, -at / step, np.inf)).min()
                down = np.where(step > 0, at / step, np.where(step < 0, (at - 1) / step, np.inf)).min()
            move = up if chance[new] < down / (up + down) else -down
            at = at + move * step
            at = np.where(at < 1e-9, 0.0, np.where(at > 1 - 1e-9, 1.0, at))
            share[held] = at
            held = [k for k, v in zip(held, at) if 0 < v < 1]
    return share


def landing(share: np.ndarray, size: np.ndarray, chance: float) -> np.ndarray:
    """The last undecided ones, LAST at most: of all ways to settle them the one nearest to both sums; ``chance`` breaks ties."""
    n = len(share)
    ways = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    words = np.abs(ways @ size - share @ size) / max(size.mean(), 1.0)
    rows = np.abs(ways.sum(axis=1) - share.sum())
    cost = np.round(words + 0.01 * rows, 9)
    best = np.flatnonzero(cost == cost.min())
    return ways[best[int(chance * len(best))]].astype(np.float64)


def settle(share: np.ndarray, size: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Flight and landing of a whole source. A few documents, spread over the sizes, stay out of the flight for the landing."""
    share = share.astype(np.float64).copy()
    open_ = np.flatnonzero((share > 0) & (share < 1))
    if len(open_) > LAST:
        by_size = open_[np.argsort(size[open_], kind="stable")]
        late = by_size[np.linspace(0, len(by_size) - 1, LAST - 2).astype(int)]
        early = np.setdiff1d(open_, late)
        share[early] = flight(share[early], size[early], chance[early])
        open_ = np.flatnonzero((share > 0) & (share < 1))
    if len(open_):
        share[open_] = landing(share[open_], size[open_].astype(np.float64), float(chance[open_[0]]))
    return share


def _flown(pieces: DataFrame, level: int) -> DataFrame:
    def fly(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "size"], kind="stable")
        salt = mix(np.array([level], dtype=np.uint64) + np.uint64(77))
        chance = _unit(rows["key"].to_numpy().view(np.uint64) ^ salt)
        move = settle if rows["last"].iloc[0] else flight
        share = move(rows["share"].to_numpy(), rows["size"].to_numpy(), chance)
        return rows.assign(share=share)[["row", "source", "size", "key", "share"]]

    return pieces.groupBy("source", "block").applyInPandas(fly, "row long, source string, size long, key long, share double")


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, and times (how often it is taken).

    Size is the number of words; a null or blank text has none. A null source is a source of its own, named
    last. If a source has no words its target is 0 and it is not taken. Rows that repeat a doc_id are drawn on
    their own. The draw depends on doc_id, source and size alone, so reruns agree. Other columns are ignored; an empty table gives
    an empty result.
    """
    sized = cut(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col)).alias("size"),
        )
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = source_targets(sources.select("source", "source_size"), weights, most)
    plan = cut(sources.select(F.col("source").alias("s"), "n").join(targets, F.col("s").eqNullSafe(targets["source"])).drop("s"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    ratio = F.least(F.greatest(ratio, F.lit(0.0)), F.lit(float(most)))
    of = plan.select(F.col("source").alias("s"), "n", "source_size", "target", ratio.alias("ratio"))
    drawn = sized.join(of, sized["source"].eqNullSafe(of["s"])).drop("s")
    drawn = drawn.withColumn("whole", F.floor("ratio")).withColumn("share", F.col("ratio") - F.col("whole"))

    undecided = (
        drawn.filter((F.col("share") > 0) & (F.col("size") > 0))
        .select("row", "source", "size", F.xxhash64("doc_id", "size", F.lit("mix")).alias("key"), "share", "n")
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS))
    )
    settled, level = None, 0
    while True:
        block = F.pmod(F.xxhash64("key", F.lit(level)), F.col("blocks"))
        pieces = undecided.withColumn("block", block).withColumn("last", F.col("blocks") <= 1)
        flown = cut(_flown(pieces, level))
        done = flown.filter((F.col("share") <= 0) | (F.col("share") >= 1))
        settled = done if settled is None else settled.unionByName(done)
        rest = flown.filter((F.col("share") > 0) & (F.col("share") < 1))
        counts = rest.groupBy("source").agg(F.count("*").alias("left")).withColumnRenamed("source", "s")
        if rest.isEmpty():
            break
        undecided = rest.join(counts, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("blocks", F.ceil(F.col("left") / BLOCK_ROWS)).drop("left")
        level += 1

    extra = settled.filter("share >= 1").select(F.col("row").alias("r"), F.lit(1).alias("extra"))
    out = drawn.join(extra, drawn["row"] == extra["r"], "left")
    times = (F.col("whole") + F.coalesce("extra", F.lit(0))).cast("long")
    return out.select("doc_id", "size", "source_size", "target", (times * F.col("size")).alias("taken"), times.alias("times"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents as the mix takes them, each as often as it is taken; all columns as they came.

    A row is repeated as its doc_id says; if rows share a doc_id, each is repeated as the one that is taken most.
    Documents without words are in no mix.
    """
    times = mix_sources(docs, id_col=id_col).groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.when(F.col("size") > 0, F.col("times")).otherwise(F.lit(0))).alias("_times"))
    held = docs.select(F.struct("*").alias("_doc"))
    joined = held.join(times, F.col("_doc")[id_col].eqNullSafe(F.col("_id"))).filter("_times > 0")
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_doc.*")
