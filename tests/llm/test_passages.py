from __future__ import annotations

import random

import numpy as np

from obsflow.llm import passages
from obsflow.llm.passages import remove_repeated_passages
from obsflow.llm.words import text_blocks, words_of


def prose(chance, words):
    out = []
    for k in range(words):
        w = "".join(chance.choice("abcdefghij") for _ in range(chance.randrange(2, 8)))
        out.append(w + (". " if chance.random() < 0.1 else " ") + ("\n" if chance.random() < 0.02 else ""))
    return "".join(out)


def brute(rows):
    """The same by a plain loop over the shortest runs from and up to each sentence, in order."""
    import pyarrow as pa

    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        block = next(iter(text_blocks(pa.array([text or ""]), 10**9)), None)
        words = words_of(block[1], block[2])
        ends = passages.sentences(words)
        close = np.flatnonzero(ends).tolist()
        begin = [0] + [c + 1 for c in close[:-1]] if close else []
        gone = set()
        said = data.lower().split()
        both = set()
        for s in range(len(close)):
            fits = [e for e in range(s + passages.SENTENCES - 1, min(s + 40, len(close))) if close[e] + 1 - begin[s] >= passages.WORDS]
            both |= {(s, e) for e in fits[:1]}
        for e in range(len(close)):
            fits = [s for s in range(e - passages.SENTENCES + 1, max(e - 40, -1), -1) if s >= 0 and close[e] + 1 - begin[s] >= passages.WORDS]
            both |= {(s, e) for s in fits[:1]}
        for s, e in sorted(both):
            run = tuple(said[begin[s] : close[e] + 1])
            if run in seen:
                gone |= set(range(s, e + 1))
            seen.add(run)
        parts = [words.start[begin[k]] if k else 0 for k in range(len(close))] + [len(data)]
        out[doc_id] = (b"".join(data[parts[k] : parts[k + 1]] for k in range(len(close)) if k not in gone) if close else data).decode(), len(gone)
    return out


def test_like_a_plain_loop(documents, corpus):
    chance = random.Random(4)
    shared = prose(chance, 60)
    rows = [(k, prose(chance, 80) + (shared if k % 3 == 0 else "") + prose(chance, 40)) for k in range(12)]
    rows += [(20, rows[1][1]), (21, None), (22, ""), (23, "the " * 400), (24, "the " * 300), (25, prose(chance, 20_000)), (26, shared + " " + shared)]
    rows += [(100 + r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    found = {r.doc_id: (r.text, r.n_removed) for r in remove_repeated_passages(documents(rows)).collect()}
    assert found == brute(rows)
    assert found[20][0] == ""
    assert found[0][0] == rows[0][1] and found[1][0] == rows[1][1]


def test_a_passage_of_over_fifty_words_is_found_wherever_it_stands(documents):
    chance = random.Random(6)
    missed = 0
    for trial in range(3):
        rows = []
        for k in range(30):
            passage = prose(chance, 55).strip()
            rows += [(2 * k, prose(chance, 100) + passage + prose(chance, 30)), (2 * k + 1, prose(chance, 33) + "glued" + passage + "end " + prose(chance, 70))]
        found = {r.doc_id: r.n_removed for r in remove_repeated_passages(documents(rows)).collect()}
        assert not any(found[2 * k] for k in range(30))
        missed += sum(found[2 * k + 1] == 0 for k in range(30))
    assert missed == 0


def test_rows_without_id_and_empty_table(documents):
    text = prose(random.Random(7), 100)
    found = remove_repeated_passages(documents([(1, text), (None, text), (1, text)])).collect()
    assert [r.n_removed for r in found] == [0, 0, 0]
    assert remove_repeated_passages(documents([])).count() == 0


def test_rows_of_one_id_with_different_texts(documents):
    chance = random.Random(10)
    shared, short, long = prose(chance, 100), prose(chance, 40), prose(chance, 400)
    rows = [(1, long + shared), (1, short), (1, shared), (2, short + shared), (2, short), (3, long)]
    found = remove_repeated_passages(documents(rows)).collect()
    assert len(found) == 6
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append((r.n_removed, r.text))
    # Of document 1 one of the two texts with the shared passage keeps it, and all of document 3 has been said.
    kept = sorted(text for n, text in by[1] if n == 0)
    assert short in kept and len(kept) == 2
    assert [n > 0 for n, _ in by[3]] == [True] and all(n > 0 for n, _ in by[2])


def every_run(rows):
    """By a plain loop over all runs of any length, in order."""
    import pyarrow as pa

    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = text.encode()
        words = words_of(*next(iter(text_blocks(pa.array([text]), 10**9)))[1:])
        close = np.flatnonzero(passages.sentences(words)).tolist()
        begin = [0] + [c + 1 for c in close[:-1]]
        gone, said = set(), data.lower().split()
        for s in range(len(close)):
            for e in range(s + passages.SENTENCES - 1, len(close)):
                if close[e] + 1 - begin[s] >= passages.WORDS:
                    run = tuple(said[begin[s] : close[e] + 1])
                    if run in seen:
                        gone |= set(range(s, e + 1))
                    seen.add(run)
        parts = [words.start[begin[k]] if k else 0 for k in range(len(close))] + [len(data)]
        out[doc_id] = (b"".join(data[parts[k] : parts[k + 1]] for k in range(len(close)) if k not in gone).decode(), len(gone))
    return out


def spoken(chance, low, high, words):
    out = []
    while len(out) < words:
        out += ["".join(chance.choice("abcdefghij") for _ in range(5)) for _ in range(chance.randint(low, high))]
        out[-1] += "."
    return out[:words]


def test_like_a_loop_over_all_runs(documents):
    chance = random.Random(8)
    rows = []
    for k in range(30):
        passage = " ".join(spoken(chance, 2, 12, 60)) + ". "
        rows += [(3 * k + j, " ".join(spoken(chance, 2, 12, 30)) + ". " + passage + " ".join(spoken(chance, 2, 12, 30))) for j in range(2)]
    ended = " ".join(w + ("." if i in (9, 19, 29, 31, 33) else "") for i, w in enumerate(spoken(chance, 99, 99, 34)))
    rows += [(200, ended), (201, ended), (202, "the " * 100), (203, ended + " " + ended)]
    found = {r.doc_id: (r.text, r.n_removed) for r in remove_repeated_passages(documents(rows)).collect()}
    assert found[201][0] == ""
    assert found == every_run(rows)


def test_no_passage_of_51_words_is_missed(documents):
    chance = random.Random(9)
    rows = []
    for k, (low, high) in enumerate([(10, 16), (14, 16), (2, 12), (8, 30), (999, 999)] * 60):
        passage = spoken(chance, low, high, 51)
        rows += [(2 * k + j, " ".join(spoken(chance, low, high, 40 + 9 * j) + passage + spoken(chance, low, high, 45 + 7 * j))) for j in range(2)]
        rows[-1] = (rows[-1][0], rows[-1][1].replace(" " + " ".join(passage) + " ", " x" + " ".join(passage) + "x "))
    found = {r.doc_id: r.n_removed for r in remove_repeated_passages(documents(rows)).collect()}
    assert not any(found[2 * k] for k in range(300))
    assert sum(found[2 * k + 1] == 0 for k in range(300)) == 0
