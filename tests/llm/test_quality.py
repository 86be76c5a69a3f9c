from __future__ import annotations

import numpy as np

from obsflow.llm.quality import classify, latent_classes, votes


def test_labels_are_met_without_reading_them(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    found = [r for r in classify(docs).collect() if r.doc_id in truth]
    good = [r.kept for r in found if truth[r.doc_id] == 1]
    bad = [r.kept for r in found if truth[r.doc_id] == 0]
    assert np.mean(good) > 0.98
    assert np.mean(bad) < 0.1


def test_rare_kinds_of_bad_text_are_told_apart():
    counted = {"1111121": 8583, "0110121": 360, "0110021": 347, "0010101": 337, "1111101": 298}
    patterns = np.array([[int(v) for v in p] for p in counted])
    share, accuracy, good = latent_classes(patterns, np.array(list(counted.values()), dtype=float))
    assert 0.8 < share < 0.95
    assert good[0] > 0.9 and (good[1:] < 0.5).all()
    assert (accuracy[0] >= 0.9).all() and (accuracy[1] <= 0.75).all()


def test_a_labeller_that_votes_at_random_is_found_out():
    chance = np.random.default_rng(1)
    truth = chance.random(20_000) < 0.9
    given = np.ones((len(truth), 7), dtype=int)
    for k in (0, 1, 3):
        given[~truth & (chance.random(len(truth)) < 0.8), k] = 0
    given[chance.random(len(truth)) < 0.2, 2] = 0
    given[chance.random(len(truth)) < np.where(truth, 0.97, 0.5), 5] = 2
    patterns, counts = np.unique(given, axis=0, return_counts=True)
    share, accuracy, good = latent_classes(patterns, counts.astype(float))
    assert abs(share - 0.9) < 0.08
    assert abs(accuracy[0][2] - 0.1) < 0.08 and (accuracy[0][[0, 1, 3]] >= 0.9).all()
    of = {tuple(p): g for p, g in zip(patterns, good)}
    assert of[1, 1, 0, 1, 1, 2, 1] > 0.9 and of[0, 0, 1, 0, 1, 1, 1] < 0.1


def test_votes():
    assert votes(np.zeros((1, 7)))[0].tolist().count(0) == 0
    assert votes(np.ones((1, 7)))[0].tolist() == [0] * 7


def test_odd_rows(documents, corpus):
    rows = [(1, None), (2, " \n"), (None, "Plain words, and more of them."), (4, "# $ % & " * 30_000), (5, "x"), (5, "x")]
    found = classify(documents(rows)).collect()
    assert len(found) == len(rows)
    assert all(r.score == 0 and not r.kept for r in found if r.doc_id in (1, 2))
    assert classify(documents([])).count() == 0
    assert sorted(map(tuple, classify(corpus).collect())) == sorted(map(tuple, classify(corpus.repartition(3)).collect()))
