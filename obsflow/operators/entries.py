"""Bundle entries kept whole, as VARIANT: nothing is inferred, declared or cut.

A landed line is a document. Its *units* are what it holds: its entries, or the document or page itself where that
can't be read as such. Every unit goes one of three ways, and ``balance`` shows that none is lost: to the bronze
layer, to the rejects with a reason, or it belongs to a page that is a copy of another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.operators.multiset import unit_hash

ENTRIES = "array<variant>"
PAGES = "map<string,variant>"


def _entry() -> Column:
    return F.try_variant_get("bundle", "$.entry", "variant")


def document_rejection() -> Column:
    """Why a landed line is no bundle, null when it is one.

    A bundle is an object with ``entry`` or ``total``; without entries it is good and empty. Text that is no JSON, names a
    key twice or is too large for a VARIANT is broken. A service error is valid JSON without either field.
    """
    fields = F.try_variant_get("bundle", "$", PAGES)
    known = F.map_contains_key(fields, "entry") | F.map_contains_key(fields, "total")
    entry = _entry()
    absent = entry.isNull() | F.is_variant_null(entry)
    listed = F.try_variant_get(entry, "$", ENTRIES).isNotNull() | F.try_variant_get(entry, "$", PAGES).isNotNull()
    return (
        F.when(F.col("bundle").isNull(), "broken document")
        .when(fields.isNull() | ~known, "no bundle")
        .when(~absent & ~listed, "entries are no list")
    )


def entry_rejection(data: Column) -> Column:
    """Why an entry is unusable, null when it is good."""
    resource = F.try_variant_get(F.try_variant_get(data, "$.resource", "variant"), "$", PAGES)
    return F.when(resource.isNull(), "no resource")


def _pages() -> Column:
    """The pages of a bundle: the list itself, or one for each row label of the columnar layout."""
    plain = F.try_variant_get(_entry(), "$", ENTRIES)
    labelled = F.map_values(F.try_variant_get(_entry(), "$", PAGES))
    page = F.transform(labelled, lambda p: F.struct(F.try_variant_get(p, "$", ENTRIES).alias("entries"), p.alias("whole")))
    return F.when(plain.isNotNull(), F.array(F.struct(plain.alias("entries"), _entry().alias("whole")))).otherwise(page)


def split_pages(bundles: DataFrame) -> DataFrame:
    """One row per page, and one per document that is no bundle.

    source_file, page_id, reason and text (of what is rejected as a whole, else null), entries, digest, and
    n, hash_sum, hash_xor and bad: the number of entries, their fingerprint and how many of them are unusable. The digest is of the page's
    canonical JSON, so white space and the order of fields don't tell pages apart, and every other difference does.
    Write it before use: page_id numbers the rows of a task.
    """
    judged = bundles.withColumn("reason", document_rejection())
    pages = judged.select(
        "source_file",
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("text")).alias("text"),
        F.explode_outer(F.when(F.col("reason").isNull(), _pages())).alias("page"),
    )
    unread = F.col("reason").isNull() & F.col("page").isNotNull() & F.col("page.entries").isNull()
    whole = F.to_json("page.whole")
    pages = pages.select(
        "source_file",
        F.when(unread, "page is no list").otherwise(F.col("reason")).alias("reason"),
        F.when(unread, F.coalesce(whole, F.lit("null"))).otherwise(F.col("text")).alias("text"),
        F.col("page.entries").alias("entries"),
        whole.alias("whole"),
    ).filter("reason IS NOT NULL OR entries IS NOT NULL")
    hashes = F.transform("entries", lambda e: unit_hash(entry_text(e)))
    zero = F.lit(0).cast("decimal(38,0)")
    return pages.select(
        F.monotonically_increasing_id().alias("page_id"),
        "source_file",
        "reason",
        "text",
        "entries",
        F.when(F.col("reason").isNull(), F.sha2("whole", 256)).alias("digest"),
        F.coalesce(F.size("entries"), F.lit(0)).cast("long").alias("n"),
        F.aggregate(hashes, zero, lambda acc, h: (acc + h).cast("decimal(38,0)")).alias("hash_sum"),
        F.aggregate(hashes, F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(h)).alias("hash_xor"),
        F.size(F.filter("entries", lambda e: entry_rejection(e).isNotNull())).alias("bad"),
    )


def entry_text(data: Column) -> Column:
    """An entry as canonical JSON; one that is null in the document is the text null."""
    return F.coalesce(F.to_json(data), F.lit("null"))


def page_copies(pages: DataFrame) -> DataFrame:
    """Pages that repeat another one, with the file of the copy that stays: the first by file, then by page_id.

    Only digests travel, not entries.
    """
    read = pages.filter("reason IS NULL")
    repeated = (
        read.groupBy("digest")
        .agg(F.min(F.struct("source_file", "page_id")).alias("kept"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select("digest", "kept")
    )
    return (
        read.select("page_id", "source_file", "digest", "n", "hash_sum", "hash_xor")
        .join(repeated, "digest")
        .filter("page_id <> kept.page_id")
        .select("page_id", "source_file", "digest", F.col("kept.source_file").alias("kept_file"), "n", "hash_sum", "hash_xor")
    )


def split_entries(pages: DataFrame, copies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bronze, rejects) of the pages that are no copies.

    Bronze: data (VARIANT, the entry whole), source_file, page_digest, position. Rejects: source_file, reason, text.
    """
    kept = pages.join(copies.select("page_id"), "page_id", "left_anti")

    def entries(of: DataFrame) -> DataFrame:
        listed = of.select("source_file", F.col("digest").alias("page_digest"), F.posexplode("entries").alias("position", "data"))
        return listed.withColumn("reason", entry_rejection(F.col("data")))

    good = entries(kept.filter("n > 0")).filter("reason IS NULL").select("data", "source_file", "page_digest", "position")
    bad = entries(kept.filter("bad > 0")).filter("reason IS NOT NULL")
    whole = pages.filter("reason IS NOT NULL").select("source_file", "reason", "text")
    return good, whole.unionByName(bad.select("source_file", "reason", entry_text(F.col("data")).alias("text")))


def landed_units(bundles: DataFrame) -> DataFrame:
    """(source_file, unit) of everything that landed, read another way than ``split_pages`` does: by exploding the document's fields."""
    tvf = bundles.sparkSession.tvf
    judged = bundles.withColumn("reason", document_rejection())
    whole = judged.filter("reason IS NOT NULL").select("source_file", F.col("text").alias("unit"))
    items = judged.filter("reason IS NULL").select("source_file", _entry().alias("entry"))
    items = items.lateralJoin(tvf.variant_explode(F.col("entry").outer())).toDF("source_file", "entry", "pos", "label", "value")
    plain = items.filter("label IS NULL").select("source_file", entry_text(F.col("value")).alias("unit"))
    pages = items.filter("label IS NOT NULL").select("source_file", F.col("value").alias("page"))
    is_list = F.try_variant_get("page", "$", ENTRIES).isNotNull()
    listed = pages.filter(is_list).lateralJoin(tvf.variant_explode(F.col("page").outer()))
    labelled = listed.toDF("source_file", "page", "pos", "label", "value").select("source_file", entry_text(F.col("value")).alias("unit"))
    unread = pages.filter(~is_list).select("source_file", entry_text(F.col("page")).alias("unit"))
    return whole.unionAll(plain).unionAll(labelled).unionAll(unread)
