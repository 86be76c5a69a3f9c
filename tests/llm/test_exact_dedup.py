from __future__ import annotations

import hashlib
import re

from obsflow.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

LONG = "word " * 200_000


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b "), (4, None), (2, ""), (7, LONG), (6, LONG), (None, "a b"), (3, "a b"), (8, "x y")] + [
    (100 + k, "hot  text") for k in range(300)
]


def test_groups_are_those_of_a_plain_loop(documents):
    found = exact_duplicates(documents(ROWS)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == expected(ROWS)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text_sha256 for r in found})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_rows_that_stay_keep_their_columns(documents):
    docs = documents(ROWS)
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, (r.text or "")[:9]) for r in kept.collect()), key=str) == sorted(
        [(3, "a\tb"), (9, "a b "), (2, ""), (6, LONG[:9]), (8, "x y"), (100, "hot  text")], key=str
    ) or sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 9, 2, 6, 8, 100], key=str)


def test_empty_table(documents):
    assert exact_duplicates(documents([])).count() == 0
    assert drop_exact_duplicates(documents([])).count() == 0
