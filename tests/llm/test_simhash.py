from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from obsflow.llm import simhash
from obsflow.llm.simhash import BLOCKS, anchors_near, fingerprint, fingerprint_links, home_anchor, simhash_duplicates


def plain_fingerprint(text, width=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(max(len(words) - width + 1, 1))]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def components(marks, distance=4):
    """Smallest member of each one's component, by all pairs."""
    top = {m: m for m in marks}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in top:
        for b in top:
            if a < b and (a ^ b).bit_count() <= distance:
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {m: find(m) for m in top}


def near(chance, mark, bits):
    for k in chance.sample(range(64), bits):
        mark ^= 1 << k
    return mark


def signed(mark):
    return mark - (1 << 64) if mark >> 63 else mark


def same_components(spark, marks, distance=4):
    table = spark.createDataFrame([(signed(m),) for m in marks], "mark long")
    links = fingerprint_links(table, distance).collect()
    mask = (1 << 64) - 1
    assert all((r.src ^ r.dst & mask).bit_count() <= 64 for r in links)
    found = {m: m for m in marks}

    def find(x):
        while found[x] != x:
            x = found[x]
        return x

    for r in links:
        x, y = find(r.src & mask), find(r.dst & mask)
        found[max(x, y)] = min(x, y)
    assert {m: find(m) for m in marks} == components(marks, distance)
    return links


def test_every_value_within_reach_meets_at_an_anchor():
    import numpy as np

    chance = random.Random(1)
    for _, bits in BLOCKS:
        values = np.array([chance.getrandbits(bits) for _ in range(50)], dtype=np.uint32)
        homes = home_anchor(values)
        assert max(int(a ^ b).bit_count() for a, b in zip(homes, values)) <= 1
        of, anchor = anchors_near(values, bits, 1)
        for k, v in enumerate(values.tolist()):
            mine = set(anchor[of == k].tolist())
            assert {int(home_anchor(np.array([v ^ f], dtype=np.uint32))[0]) for f in [0, *(1 << j for j in range(bits))]} == mine
            assert all((a ^ v).bit_count() <= 3 for a in mine)


@pytest.mark.parametrize("distance", [1, 2, 4, 5])
def test_links_join_what_all_pairs_join(spark, distance):
    chance = random.Random(distance)
    marks = [chance.getrandbits(64) for _ in range(150)] + [0, (1 << 64) - 1, 1, 31]
    for m in marks[:60]:
        marks += [near(chance, m, b) for b in (1, 3, 4, 5, 6)]
    for _ in range(30):
        marks.append(near(chance, marks[-1], 4))
    same_components(spark, sorted(set(marks)), distance)


def test_more_than_distance_supported(spark):
    with pytest.raises(ValueError):
        fingerprint_links(spark.createDataFrame([(1,)], "mark long"), 6)


def test_a_crowded_anchor_is_split_and_gives_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 40)
    chance = random.Random(2)
    marks = sorted({near(chance, 0xDEADBEEF, chance.randrange(0, 3)) for _ in range(900)})
    links = same_components(spark, marks)
    pairs = sum((a ^ b).bit_count() <= 4 for a in marks for b in marks if a < b)
    assert len(links) < pairs / 4
    monkeypatch.setattr(simhash, "CELL", 4096)
    # About 14 anchors in each of three blocks, and a link that joins two at home.
    assert len(same_components(spark, marks)) < 46 * len(marks) < pairs


def test_fingerprints(spark, corpus):
    chance = random.Random(3)
    texts = [None, "", "  \n", "One", "one two", "a b c d", "A  b\tc\nd", "ÄÖ ö ü é x", " ".join(chance.choice("abcdef") for _ in range(3000))]
    texts += [r.text for r in corpus.limit(40).collect()]
    assert [fingerprint(None if t is None else t.encode()) for t in texts] == [plain_fingerprint(t) for t in texts]
    found = spark.createDataFrame([("one two three four",)], "t string").select(F.xxhash64("t").alias("h")).first().h
    assert signed(fingerprint(b"One two  three four")) == found


def test_a_very_long_text_is_read_in_pieces(monkeypatch):
    chance = random.Random(4)
    text = " ".join("".join(chance.choice("abc") for _ in range(chance.randrange(1, 9))) for _ in range(500)) + "\n\n"
    whole = fingerprint(text.encode())
    for size in (1, 7, 100):
        monkeypatch.setattr(simhash, "PIECE", size)
        assert fingerprint(text.encode()) == whole == plain_fingerprint(text)


def test_like_brute_force(documents, corpus):
    chance = random.Random(5)
    rows = [(r.doc_id + 100, r.text) for r in corpus.collect()]
    long = " ".join(chance.choice("the of and to in that".split()) + str(chance.randrange(50)) for _ in range(4000))
    rows += [(1, None), (90, ""), (2, long), (3, long + " end"), (4, long.upper()), (5, "one"), (6, "one"), (6, "one"), (7, "x " * 20_000)]
    found = simhash_duplicates(documents(rows)).collect()
    marks = [plain_fingerprint(t) for _, t in rows]
    top = components(set(marks))
    first = {}
    for (doc_id, _), m in zip(rows, marks):
        first[top[m]] = min(doc_id, first.get(top[m], doc_id))
    expected = sorted((d, f"{m:016x}", first[top[m]], first[top[m]] == d) for (d, _), m in zip(rows, marks))
    assert sorted(map(tuple, found)) == expected


def test_rows_without_id_repeated_ids_and_empty_table(documents):
    text = "a text of some words that is here three times"
    rows = simhash_duplicates(documents([(5, text), (None, text), (3, text), (5, "another text with other words in it")])).collect()
    by = {(r.doc_id, r.component_id, r.kept) for r in rows}
    assert by == {(5, 3, False), (None, None, True), (3, 3, True), (5, 5, True)}
    assert {r.fingerprint for r in rows if r.doc_id != 5} == {f"{plain_fingerprint(text):016x}"}
    assert simhash_duplicates(documents([])).count() == 0


def test_hashes_of_an_arrow_slice():
    column = pa.array(["a b", None, "c"])
    assert [fingerprint(x.as_py()) for x in column.cast(pa.large_binary())[1:]] == [0, plain_fingerprint("c")]
