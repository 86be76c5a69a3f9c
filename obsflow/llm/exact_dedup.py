"""Exact duplicates, with frequent texts split off before the shuffle. DataFrame operations only.

A frequent-items sketch (``approx_top_k``: a mergeable Misra-Gries summary) over the digests names at most HEAVY
candidates. Their rows are counted exactly; those that hold at least one in HEAVY of all
rows are winners, of which there can be no more than HEAVY, so they are broadcast whatever the data, and
their rows are settled where they are read. All other digests are grouped by an ordinary shuffle, in which no
group holds more than one in HEAVY of the rows, unless the sketch missed it; that costs time, not results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.llm.staging import staged

#: A digest is heavy from this share of the rows: one in HEAVY.
HEAVY = 1024
TRACKED = 8 * HEAVY

WHITE_RUN = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE_RUN, " ")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if their normalised forms are; a null text is empty, and empty texts are equal. Of equal texts
    the row with the smallest doc_id stays; rows without doc_id come last. If rows repeat that doc_id too, one of
    them stays. Other columns are ignored; an empty table gives an empty result.
    """
    digests = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    grouped = [F.min(first).alias("first"), F.count("*").alias("group_size")]

    seen = digests.agg(F.expr(f"approx_top_k(xxhash64(digest), {HEAVY}, {TRACKED})").alias("top"), F.count("*").alias("total"))
    frequent = seen.select(F.explode("top.item").alias("item"), "total")
    winners = (
        digests.join(F.broadcast(frequent), F.xxhash64("digest") == F.col("item"))
        .groupBy("digest", "total")
        .agg(*grouped)
        .filter(F.col("group_size") > 1)
        .filter(F.col("group_size") * HEAVY >= F.col("total"))
        .select("digest", "first", "group_size")
    )
    winners = staged(winners, "frequent-digests")

    settled = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(winners), "digest", "left_anti")
    groups = rest.groupBy("digest").agg(*grouped)
    found = settled.unionByName(rest.join(groups, "digest"))
    return found.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, all columns as they came."""
    decided = staged(exact_duplicates(docs, id_col, text_col).select("doc_id", "kept", "text_sha256"), "exact-decisions")
    by_id = decided.groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_rows"), F.max("kept").alias("_any"))
    marked = by_id.filter((F.col("_rows") > 1) | ~F.col("_any"))
    single = docs.join(marked, docs[id_col].eqNullSafe(marked["_id"]), "left_anti")
    repeated = by_id.filter((F.col("_rows") > 1) & F.col("_any")).select("_id")
    if repeated.isEmpty():
        return single
    # Rows that repeat a doc_id: of each text that stays under it, one row.
    stays = decided.filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_text")).distinct()
    stays = stays.join(repeated.withColumnRenamed("_id", "_twice"), F.col("_id").eqNullSafe(F.col("_twice")), "left_semi")
    held = docs.select(F.struct("*").alias("_doc")).withColumn("_sha", F.sha2(normalised(F.col("_doc")[text_col]), 256))
    several = (
        held.join(stays, F.col("_doc")[id_col].eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_text")))
        .dropDuplicates(["_id", "_sha"])
        .select("_doc.*")
    )
    return single.unionByName(several)
