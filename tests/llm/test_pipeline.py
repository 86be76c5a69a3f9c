from __future__ import annotations

import hashlib
import sys
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
import sentencepiece

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__
import corpus_pipeline
from obsflow.llm.queries import ORACLES, queries

SF = "/root/testdata/sf0.001"


def test_each_stage_does_its_work(spark, corpus):
    columns, docs = corpus.columns, corpus
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), corpus.schema)
        assert docs.columns == columns
        kept.append({r.doc_id for r in docs.collect()})
    assert kept[0] >= kept[1] >= kept[2] >= kept[3]
    texts = {r.doc_id: r.text for r in corpus.collect()}
    assert len({" ".join(texts[i].split()) for i in kept[1]}) == len(kept[1])
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted((r.doc_id, r.n_tokens) for r in out) == sorted((r.doc_id, len(library.encode(r.text)) + 2) for r in docs.collect())


def test_odd_rows_and_clashing_columns_through_every_stage(spark, documents):
    text = "the house and the garden of the old town are in the north of the country and by the sea " * 4
    rows = [(k, f"{text} number {k} " + f"word{k} and the of to in " * 30, "en", "a" if k % 3 else "b") for k in range(60)]
    rows += [(100, None, "en", None), (101, "", None, "b"), (102, " \n", "en", "b"), (103, rows[5][1], "en", "a"), (None, text, None, None), (104, text * 200, "en", None), (5, rows[5][1], "en", "a")]
    docs = documents(rows)
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns
        left[name] = {r.doc_id for r in docs.collect()}
    assert not {100, 101, 102} & left["language_id"] and 103 not in left["exact_dedup"]
    assert {104, 7} <= left["near_dedup"]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == docs.count()


def test_token_ids_and_spans_come_out(spark, documents):
    texts = {1: "Plain words, and more of them.", 2: "Naïve café \u2460 12", 3: None}
    out = corpus_pipeline.STAGES[-1][1](spark, documents(list(texts.items())), SF).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id for r in out} == set(texts)
    for r in out:
        ids, begins, ends = (memoryview(bytes(x)).cast("I").tolist() for x in (r.ids, r.begins, r.ends))
        text = texts[r.doc_id] or ""
        assert ids[1:-1] == library.encode(text) and len(ids) == len(begins) == len(ends) == r.n_tokens
        assert b"".join(text.encode()[b:e] for b, e in zip(begins, ends)) == text.encode()
        assert hashlib.sha256(r.ids).hexdigest() == r.ids_sha256


def test_run_and_empty_documents(spark, documents, tmp_path):
    assert corpus_pipeline.run(spark, SF).count() > 150
    documents([]).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_like_its_sql(spark, name):
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    said = connection.sql(ORACLES[name])
    found = queries()[name](spark, SF)
    columns = sorted(found.columns)
    assert sorted(said.columns) == columns
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(said.select(", ".join(columns)).fetchall())
