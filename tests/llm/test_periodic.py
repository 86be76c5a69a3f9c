from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from obsflow.llm.periodic import collapse_periodic, looped, periodic_runs, summary


def plain_runs(words):
    """By all periods and all stretches."""
    out, n = [], len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            part = words[start:end]
            if len(part) >= max(24, 3 * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                out.append((start, end - start, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4

    def digest(x):
        return hashlib.sha256(x.encode()).hexdigest()

    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *top, digest(lines), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("seed", range(40))
def test_runs_like_all_periods(seed):
    chance = random.Random(seed)
    words = []
    for _ in range(chance.randrange(1, 6)):
        letters = chance.choice(["a", "ab", "abc", "abcdefgh", "".join(map(chr, range(200, 420)))])
        piece = [chance.choice(letters) for _ in range(chance.choice([1, 2, 3, 7, 9, 31, 32, 33, 40, 64, 70, 90]))]
        words += piece * chance.randrange(1, 6) + piece[: chance.randrange(0, len(piece) + 1)]
        words += [chance.choice(letters) for _ in range(chance.randrange(0, 12))]
    words = [w.encode() for w in words]
    assert periodic_runs(words) == plain_runs(words)


def test_nested_and_adjoining_runs():
    inner = ["x"] * 30 + ["y"]
    words = [w.encode() for w in inner * 4 + list("ab" * 12) + list("ba" * 12)]
    found = periodic_runs(words)
    assert found == plain_runs(words)
    assert (0, 124, 31) in found and (0, 30, 1) in found


def test_borders_of_length():
    def runs(text):
        return periodic_runs([w.encode() for w in text])

    assert runs("a" * 23) == [] and runs("a" * 24) == [(0, 24, 1)]
    nine = "abcdefghi"
    assert runs(nine * 3) == [(0, 27, 9)] and runs((nine * 3)[:-1]) == []


def test_a_very_long_run_takes_little_time():
    words = [b"a", b"b", b"c"] * 200_000
    assert periodic_runs(words) == [(0, 600_000, 3)]
    chance = random.Random(1)
    piece = [str(chance.randrange(1000)).encode() for _ in range(50_000)]
    assert periodic_runs(piece * 4) == [(0, 200_000, 50_000)]


def test_loops_begin_and_end_as_stated():
    words = [str(k).encode() for k in range(200)]
    doc_id = next(k for k in range(1000) if zlib.crc32(str(k).encode()) % 10 == 0)
    h = zlib.crc32(str(doc_id).encode()) // 10
    a = h % 200
    p = 1 + (200 - a) // (3 + h % 8)
    assert looped(words, doc_id) == [words[i] if i < a else words[a + (i - a) % p] for i in range(200)]
    assert looped([], doc_id) == [] and looped(words, None) == words


def test_like_brute_force(documents, corpus):
    chance = random.Random(2)
    rows = [(r.doc_id, r.text) for r in corpus.filter("n_chars < 3000").collect()]
    rows += [(10_000, None), (10_001, ""), (10_002, " \n"), (10_003, "the " * 500), (10_003, "the " * 500), (None, "ab cd " * 40), (10_004, "Ä é " * 30)]
    rows += [(20_000 + k, " ".join(chance.choice(["ab", "c", "d", "\te"]) for _ in range(120))) for k in range(40)]
    found = summary(collapse_periodic(documents(rows), loop=True)).collect()
    key = repr
    assert sorted(map(tuple, found), key=key) == sorted((plain_row(*r) for r in rows), key=key)
    assert sum(r.n_runs > 0 for r in found) > 20


def test_without_loops_and_empty_table(documents):
    doc_id = next(k for k in range(1000) if zlib.crc32(str(k).encode()) % 10 == 0)
    text = " ".join(f"w{k}" for k in range(100))
    kept = collapse_periodic(documents([(doc_id, text), (1, "x y " * 30 + "z")])).collect()
    assert {r.doc_id: (len(r.runs), r.collapsed) for r in kept} == {doc_id: (0, text), 1: (1, "x y z")}
    assert collapse_periodic(documents([])).count() == 0
    assert summary(collapse_periodic(documents([]))).count() == 0
