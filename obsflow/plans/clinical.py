"""Resource bundles through raw, bronze and silver layers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.fixed_values import BUNDLE_RESOURCES
from obsflow.operators.bundles import explode_entries, patient_silver
from obsflow.operators.entries import entry_text, landed_units, page_copies, split_entries, split_pages
from obsflow.operators.multiset import PRINT, balance, combined, fingerprint
from obsflow.schemas import PATIENT_ENTRY
from obsflow.session import staging_folder
from obsflow.sinks.tables import write_layer
from obsflow.sources.documents import read_bundle_variants, read_bundles
from obsflow.sources.tables import layer_path, read_layer

ENTRY_TYPES: dict[str, T.StructType] = {"patient": PATIENT_ENTRY}


def raw_to_bronze(
    spark: SparkSession,
    root: str,
    resources: Iterable[str] = BUNDLE_RESOURCES,
    entry_types: Mapping[str, T.StructType] = ENTRY_TYPES,
    fmt: str = "parquet",
    layout: str = "auto",
) -> list[str]:
    """Each resource folder as a table of entries, repeated pages dropped.

    Resources without a declared entry type have theirs inferred, which reads
    the folder twice. Naming the ``layout`` of the landed bundles saves a second parse.
    """
    written = []
    for resource in resources:
        folder = layer_path(root, "raw", resource)
        bundles = read_bundles(spark, folder, entry_types.get(resource), layout)
        entries = explode_entries(bundles, dedupe="page")
        written.append(write_layer(entries, root, "bronze", resource, fmt, evolve=True))
    return written


def raw_to_whole_bronze(
    spark: SparkSession,
    root: str,
    resources: Iterable[str] = BUNDLE_RESOURCES,
    fmt: str = "parquet",
    multiline: bool = False,
) -> list[str]:
    """Each resource folder as a table of whole entries, repeated pages dropped.

    Beside ``bronze`` two more layers are written: ``rejected``, what couldn't be read as an entry, with its text and a reason, and ``removed``,
    which pages were left out as copies of which. ``bundle_balance`` holds the three against the landed files. Text is
    parsed once, into a staging table that the next run overwrites; entries are never shuffled, only their pages' digests, unless so many
    pages are copies that dropping them takes a join.
    """
    written = []
    for resource in resources:
        raw = layer_path(root, "raw", resource)
        parsed = split_pages(read_bundle_variants(spark, raw, multiline))
        folder = staging_folder(spark, raw)
        parsed.write.mode("overwrite").parquet(folder)
        pages = spark.read.schema(parsed.schema).parquet(folder)
        copies = page_copies(pages)
        write_layer(copies, root, "removed", resource, fmt)
        copies = read_layer(spark, root, "removed", resource, fmt)
        good, rejects = split_entries(pages, copies)
        write_layer(rejects, root, "rejected", resource, fmt)
        written.append(write_layer(good, root, "bronze", resource, fmt))
    return written


def bundle_balance(spark: SparkSession, root: str, resource: str, fmt: str = "parquet", multiline: bool = False) -> DataFrame:
    """For each landed file: its units, how many are in bronze, rejected and removed, and whether these are all of them.

    ``balanced`` compares counts, sums and xors of 64-bit hashes of every unit: of the landed files, read anew, and of what is stored.
    """
    by = ["source_file"]
    raw = landed_units(read_bundle_variants(spark, layer_path(root, "raw", resource), multiline))
    bronze, rejected, removed = (read_layer(spark, root, layer, resource, fmt) for layer in ("bronze", "rejected", "removed"))
    parts = {
        "bronze": fingerprint(bronze, by, entry_text(F.col("data"))),
        "rejected": fingerprint(rejected, by, F.col("text")),
        "removed": combined(removed.select(*by, *PRINT), by),
    }
    return balance(fingerprint(raw, by, F.col("unit")), parts, by)


def patient_to_silver(spark: SparkSession, root: str, fmt: str = "parquet", nested: str = "declared") -> str:
    bronze = read_layer(spark, root, "bronze", "patient", fmt)
    return write_layer(patient_silver(bronze, nested), root, "silver", "patient", fmt)
