"""What has changed in the shape of landed documents, from run to run.

The schema of each run is gathered by one aggregate over VARIANT: every task merges the shapes it sees, and one text per run
comes out. The texts are read as types and walked as trees on the driver; their size is that of the schema, not of the data.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT = "run string, path string, change string, before string, after string"

_KINDS = {
    "long": "whole number",
    "decimal": "number",
    "double": "number",
    "float": "number",
    "string": "text",
    "void": "null",
    "variant": "mixed",
}


def run_schemas(landed: DataFrame, run: str = "run", text: str = "text") -> DataFrame:
    """(run, documents, broken, schema): the merged shape of all documents of each run that are JSON."""
    parsed = landed.select(F.col(run).alias("run"), F.try_parse_json(text).alias("_v"))
    return parsed.groupBy("run").agg(
        F.count("*").alias("documents"),
        F.count_if(F.col("_v").isNull()).alias("broken"),
        F.schema_of_variant_agg("_v").alias("schema"),
    )


def shape(schema: str | None) -> dict[str, str]:
    """Path to kind. Elements of a list are at ``path[]``; a field holding several kinds is mixed."""
    if not schema:
        return {}
    # Outside quoted names only.
    parts = re.split(r"(`(?:[^`]|``)*`)", schema)
    named = "".join(p if p.startswith("`") else p.replace("OBJECT<", "STRUCT<") for p in parts)
    found: dict[str, str] = {}
    _walk(T.DataType.fromDDL(named), "$", found)
    return found


def _walk(kind: T.DataType, path: str, found: dict[str, str]) -> None:
    if isinstance(kind, T.StructType):
        found[path] = "object"
        for field in kind.fields:
            _walk(field.dataType, f"{path}.{field.name}", found)
    elif isinstance(kind, T.ArrayType):
        found[path] = "list"
        _walk(kind.elementType, f"{path}[]", found)
    else:
        name = kind.typeName()
        found[path] = _KINDS.get(name, name)


def drift(landed: DataFrame, run: str = "run", text: str = "text") -> DataFrame:
    """(run, path, change, before, after): what differs from the run before, runs in order of name; the first has no rows.

    A field is added, removed or changed. "number" becomes "whole number" when no value of the run had a fraction. A run without a
    single readable document has no shape and is passed over.
    """
    rows, before = [], None
    for found in run_schemas(landed, run, text).filter("documents > broken").orderBy("run").toLocalIterator():
        after = shape(found["schema"])
        if before is not None:
            for path in sorted(before.keys() | after.keys()):
                was, now = before.get(path), after.get(path)
                if was != now:
                    rows.append((found["run"], path, "added" if was is None else "removed" if now is None else "changed", was, now))
        before = after
    return landed.sparkSession.createDataFrame(rows, REPORT)
