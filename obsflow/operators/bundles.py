"""Resource bundles: pages, entries, and the refined patient table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.functions.scalars import as_date, as_long
from obsflow.schemas import PATIENT, SEARCH


def pages(bundles: DataFrame) -> DataFrame:
    """One row per page, ``page`` being its array of entries.

    Accepts every layout of ``entry``: an array of entries, a struct or map from
    row label to such an array, or an array of pages.
    """
    return bundles.select(F.explode(_listed(bundles)).alias("page"))


def _listed(bundles: DataFrame) -> Column:
    kind = bundles.schema["entry"].dataType
    if isinstance(kind, T.MapType):
        return F.map_values("entry")
    if isinstance(kind, T.StructType):
        return F.array(*[F.col("entry").getField(name) for name in kind.names])
    if isinstance(kind.elementType, T.ArrayType):
        return F.col("entry")
    return F.array("entry")


def explode_entries(bundles: DataFrame, dedupe: str | None = "page") -> DataFrame:
    """One row per entry, as column ``data``.

    ``dedupe="page"`` drops repeated pages but keeps an entry that occurs in two different
    pages; ``"entry"`` drops repeated entries; None keeps all. Copies are dropped with a
    plain ``distinct``: each task first collapses its own, and no row ever holds more than
    one page.
    """
    if dedupe not in ("page", "entry", None):
        raise ValueError(f"unknown dedupe: {dedupe}")
    found = pages(bundles)
    if dedupe == "page":
        found = found.distinct()
    entries = found.select(F.explode("page").alias("data"))
    return entries.distinct() if dedupe == "entry" else entries


def reconcile_totals(bundles: DataFrame, by: list[str]) -> DataFrame:
    """Declared against extracted number of entries, per group."""
    sizes = F.transform(_listed(bundles), lambda page: F.coalesce(F.size(page), F.lit(0)))
    size = F.coalesce(F.aggregate(sizes, F.lit(0), lambda acc, n: acc + n), F.lit(0))
    return (
        bundles.select(*by, "total", size.alias("_size"))
        .groupBy(*by)
        .agg(
            F.coalesce(F.sum("total"), F.lit(0)).cast("long").alias("declared"),
            F.sum("_size").cast("long").alias("extracted"),
        )
        .withColumn("missing", F.col("declared") - F.col("extracted"))
    )


#: Silver columns behind ``id``, in order; the last is taken from the entry, the others from its resource.
SILVER = [
    "active", "name", "resourceType", "address", "birthdate", "careProvider", "gender",
    "identifier", "managingOrganization", "maritalStatus", "meta", "telecom", "search",
]


def patient_silver(bronze: DataFrame, nested: str = "declared") -> DataFrame:
    """Patients with typed columns, each distinct row once.

    ``data`` is an entry: a struct, or a VARIANT that keeps it whole. Of a VARIANT, ``nested="whole"`` gives the columns
    that hold lists and objects as VARIANT again, with every field that landed; "declared" gives them the types of the schema.
    """
    if nested not in ("declared", "whole"):
        raise ValueError(f"unknown nested: {nested}")
    if not isinstance(bronze.schema["data"].dataType, T.VariantType):
        if nested == "whole":
            raise ValueError("only bronze with VARIANT entries holds them whole")
        resource = "data.resource"
        columns = [F.col(f"{resource}.{name}").alias(name) for name in SILVER[:-1]]
        columns[SILVER.index("birthdate")] = as_date(F.col(f"{resource}.birthdate")).alias("birthdate")
        return bronze.select(
            as_long(F.col(f"{resource}.id")).alias("id"), *columns, F.col("data.search").alias("search")
        ).distinct()
    kinds = {f.name.lower(): f.dataType for f in PATIENT.fields} | {"search": SEARCH}
    text = "string"
    # Fields go by name whatever their case, as they do in a struct; only this one is spelt in two ways.
    birthdate = F.coalesce(*[F.try_variant_get("data", f"$.resource.{name}", text) for name in ("birthDate", "birthdate")])
    columns = [as_long(F.try_variant_get("data", "$.resource.id", text)).alias("id")]
    for name in SILVER:
        path = "$.search" if name == "search" else f"$.resource.{name}"
        kind = kinds[name.lower()]
        if name == "birthdate":
            columns.append(as_date(birthdate).alias(name))
        elif nested == "whole" and isinstance(kind, (T.ArrayType, T.StructType)):
            columns.append(F.try_variant_get("data", path, "variant").alias(name))
        else:
            columns.append(F.try_variant_get("data", path, kind.simpleString()).alias(name))
    silver = bronze.select(*columns)
    if nested == "declared":
        return silver.distinct()
    # VARIANT columns can't be compared, their canonical text can.
    plain = [F.to_json(f.name) if isinstance(f.dataType, T.VariantType) else F.col(f.name) for f in silver.schema.fields]
    digest = F.sha2(F.to_json(F.struct(*[c.alias(f"c{k}") for k, c in enumerate(plain)])), 256)
    return silver.withColumn("_digest", digest).dropDuplicates(["_digest"]).drop("_digest")
