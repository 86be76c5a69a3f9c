from __future__ import annotations

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, id string, _id string, place string, size string, label string, rep string"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents with more columns, named like those that operators use inside."""

    def make(rows, lang="en", source="s"):
        full = []
        for r in rows:
            r = (*r, *(lang, source)[len(r) - 2 :]) if len(r) < 4 else r
            full.append((*r, None, "r", "i", None, "p", "z", "l", "q"))
        return spark.createDataFrame(full, COLUMNS)

    return make


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
