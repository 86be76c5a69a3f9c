from __future__ import annotations

from functools import lru_cache
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest

from obsflow.llm import language
from obsflow.llm.language import MARK, Vocabulary, expected_counts, fit, identify, keep_identified, log_likelihood, predict

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.of_model(MODEL)


def paths(word, vocabulary):
    place = {p: k for k, p in enumerate(vocabulary.pieces)}
    word = MARK + word

    @lru_cache(None)
    def rest(i):
        if i == len(word):
            return [()]
        out = []
        for j in range(i + 1, len(word) + 1):
            piece = place.get(word[i:j], vocabulary.unknown if j == i + 1 else None)
            out += [] if piece is None else [(piece, *tail) for tail in rest(j)]
        return out

    return rest(0)


WORDS = ["the", "ciónque", "straße", "日本語", "a"]


def test_forward_sums_all_segmentations(vocabulary):
    shares = np.random.default_rng(1).random((vocabulary.unknown + 1, 3)) + 0.01
    want = [np.log(sum(np.prod(shares[list(p)], axis=0) for p in paths(w, vocabulary))) for w in WORDS]
    assert np.allclose(log_likelihood(WORDS, vocabulary, shares), want)


def plain_sum(word, vocabulary, shares):
    """The forward pass in whole fractions of logs, place by place."""
    place = {p: k for k, p in enumerate(vocabulary.pieces)}
    word = MARK + word
    logs = np.full((len(word) + 1, shares.shape[1]), -np.inf)
    logs[0] = 0
    for j in range(1, len(word) + 1):
        for i in range(max(0, j - vocabulary.longest), j):
            piece = place.get(word[i:j], vocabulary.unknown if j == i + 1 else None)
            if piece is not None:
                logs[j] = np.logaddexp(logs[j], logs[i] + np.log(shares[piece]))
    return logs[-1]


def test_long_runs_are_scored_whole(vocabulary, monkeypatch):
    shares = np.random.default_rng(3).random((vocabulary.unknown + 1, 3)) * 1e-4 + 1e-9
    long = ["théinternationalisation" * 5, "日本語の" * 40, "a" * 33, "b" * 32, "straßen" * 300, "x" * 1000]
    want = [plain_sum(w, vocabulary, shares) for w in long]
    assert np.allclose(log_likelihood(long, vocabulary, shares), want, rtol=1e-10)
    monkeypatch.setattr(language, "LONG_LETTERS", 100)
    assert np.allclose(log_likelihood(long, vocabulary, shares), want, rtol=1e-10)


def test_a_long_run_is_no_chain_of_words(vocabulary):
    shares = np.full((vocabulary.unknown + 1, 1), 1e-3)
    hundred = "abcdefghij" * 10
    place = {p: k for k, p in enumerate(vocabulary.pieces)}
    marked = np.array([p.startswith(MARK) for p in vocabulary.pieces])
    counts = expected_counts([hundred], np.ones(1), vocabulary, shares[:, 0])
    assert np.isclose(counts[:-1][marked].sum(), 1) and place


def test_expected_counts_are_those_of_all_segmentations(vocabulary):
    share = np.random.default_rng(2).random(vocabulary.unknown + 1) + 0.01
    want = np.zeros(vocabulary.unknown + 1)
    for n, word in enumerate(WORDS, 1):
        each = paths(word, vocabulary)
        weight = np.array([np.prod(share[list(p)]) for p in each])
        for p, w in zip(each, weight / weight.sum()):
            np.add.at(want, list(p), n * w)
    assert np.allclose(expected_counts(WORDS, np.arange(1.0, len(WORDS) + 1), vocabulary, share), want)


def test_held_out_languages_are_told(corpus):
    truth = {r.doc_id: r.lang for r in corpus.collect()}
    found = identify(corpus, MODEL).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_texts(documents, corpus):
    model = fit(corpus, MODEL, fit_rows=50)
    rows = [(1, None), (2, ""), (3, "123 ... ²"), (None, "the and of"), (5, "a" * 50_000), (6, "the and of"), (6, "the and of")]
    found = {r.doc_id: r for r in predict(documents(rows), model).collect()}
    assert [(found[i].lang_pred, found[i].score) for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert found[None].lang_pred == found[6].lang_pred == "en"
    assert predict(documents([]), model).count() == 0


def test_nothing_to_learn_from(documents):
    docs = documents([(1, "some text", None, None), (2, None, "en", "s")])
    assert {r.lang_pred for r in identify(docs, MODEL).collect()} == {"und"}
    assert identify(documents([]), MODEL).count() == 0


def test_the_filter_keeps_what_it_can_tell(corpus, documents):
    kept = keep_identified(corpus, MODEL)
    assert kept.columns == corpus.columns
    assert kept.count() >= 0.98 * corpus.count()
    rows = [(k, "the and of with", "en", "s") for k in range(40)] + [(50, "123", "en", "s"), (51, None, "en", "s")]
    assert sorted(r.doc_id for r in keep_identified(documents(rows), MODEL).collect()) == list(range(40))
