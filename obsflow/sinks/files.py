"""CSV and JSON files, and a look at the console."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.fixed_values import PREVIEW_ROWS
from obsflow.functions.scalars import escape_breaks


def write_headerless_csv(rows: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite a folder of comma-separated files without header.

    ``single_file`` puts everything into one task and is meant for small exports only.
    """
    _csv(rows.coalesce(1) if single_file else rows, path, "overwrite")


def append_headerless_csv(rows: DataFrame, path: str) -> None:
    _csv(rows, path, "append")


def _csv(rows: DataFrame, path: str, mode: str) -> None:
    """Every text comes back as it is: blanks at its ends stay, quotes are doubled, line breaks are escaped.

    Escaped breaks keep one row on one line, so that large files can still be split.
    """
    escaped = {
        f.name: escape_breaks(F.col(f"`{f.name}`")) for f in rows.schema.fields if isinstance(f.dataType, T.StringType)
    }
    (
        rows.withColumns(escaped)
        .write.mode(mode)
        .options(header=False, sep=",", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def land_documents(documents: DataFrame, folder: str, stamp: str | None = None) -> None:
    """Write each row as one JSON object per line, under ``run=<stamp>`` if given."""
    path = folder if stamp is None else f"{folder.rstrip('/')}/run={stamp}"
    documents.write.mode("append").json(path)


def as_columnar(documents: DataFrame, label: str = "0") -> DataFrame:
    """Each column wrapped as ``{label: value}``: the column-oriented layout of a frame."""
    return documents.select(
        *[F.create_map(F.lit(label), F.col(c)).alias(c) for c in documents.columns]
    )


def head(rows: DataFrame, count: int = PREVIEW_ROWS) -> DataFrame:
    """The rows that a preview shows."""
    return rows.limit(count)


def preview(rows: DataFrame, count: int = PREVIEW_ROWS) -> None:
    """Print the first rows, uncut, and the schema."""
    rows.show(count, False)
    rows.printSchema()
