from __future__ import annotations

import numpy as np
import pytest

from obsflow.llm import mixing
from obsflow.llm.mixing import flight, landing, mix_sources, mixed_documents, source_targets


def shared_out(sizes, most=3.0):
    """The rule as told: share by weight, cut, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while left > 1e-9 and open_:
        level = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / level
        left = sum(max(0.0, target[s] - most * sizes[s]) for s in names)
        for s in names:
            if target[s] >= most * sizes[s]:
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 50, "d": 1, "é": 500, None: 70}, {"a": 5}, {"a": 0, "b": 7}, {"a": 0}, {"x": 1, "y": 100000, "z": 3}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in source_targets(frame).collect()}
    assert found == pytest.approx(shared_out(sizes))


def test_flight_keeps_both_sums():
    chance = np.random.default_rng(1)
    size, share = chance.integers(1, 4000, 500), chance.random(500)
    out = flight(share, size, chance.random(500))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(share.sum())
    assert out @ size == pytest.approx(share @ size)


def test_flight_keeps_shares_on_average():
    chance = np.random.default_rng(2)
    size, share = np.array([3, 5, 8, 13, 21, 34]), np.array([0.2, 0.4, 0.5, 0.6, 0.3, 0.7])
    mean = np.mean([flight(share, size, chance.random(6)) for _ in range(4000)], axis=0)
    assert np.abs(mean - share).max() < 0.04


def test_landing_is_near():
    share, size = np.array([0.5, 0.25, 0.5]), np.array([100.0, 50.0, 10.0])
    assert set(landing(share, size, 0.3)) <= {0.0, 1.0}
    assert abs(landing(share, size, 0.3) @ size - share @ size) <= 10


@pytest.mark.parametrize("block", [20_000, 40])
def test_mix_of_the_corpus(corpus, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", block)
    found = mix_sources(corpus).toPandas()
    assert len(found) == corpus.count()
    again = mix_sources(corpus.repartition(3)).toPandas()
    order = ["doc_id"]
    assert found.sort_values(order).reset_index(drop=True).equals(again.sort_values(order).reset_index(drop=True))
    joined = found.merge(corpus.select("doc_id", "source").toPandas())
    assert (joined["taken"] <= 3 * joined["size"]).all()
    for _, own in joined.groupby("source"):
        assert abs(own["taken"].sum() - own["target"].iloc[0]) <= own["size"].max() / 2


def test_odd_rows(documents):
    rows = [(k, "one two three four", "en", "big") for k in range(60)] + [
        (100, None, "en", "none"), (101, " \n", "en", "none"), (102, "a b", "en", None), (None, "a b c", "en", "big"), (5, "one two three four", "en", "big"), (103, "w " * 50_000, "en", "long"),
    ]
    found = mix_sources(documents(rows)).collect()
    assert len(found) == len(rows)
    assert all(r.taken == r.times * r.size and r.taken <= 3 * r.size for r in found)
    assert {r.doc_id: r.size for r in found}[103] == 50_000
    mixed = mixed_documents(documents(rows))
    assert mixed.columns == documents(rows).columns
    assert not {100, 101} & {r.doc_id for r in mixed.collect()}


def test_empty_table(documents):
    assert mix_sources(documents([])).count() == 0
    assert mixed_documents(documents([])).count() == 0
