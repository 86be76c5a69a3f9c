from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from obsflow.llm.boosting import boost, score_of, sql_of
from obsflow.llm.pii import KINDS, calibrated, personal_data, redacted, running_sums, summary

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"\D", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, m.end()))
    return [f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(out)]


ODD = [
    None,
    "",
    "a@b.c_d@e.f and x@y",
    "é🎉 write to ö.me@mail.example.com, 1.2.3.4.5.6.7.8 or 0001.2.3.256",
    "4539 1488 0343 6467 4539148803436467",
    "4539148803436467 and +1 (017) 555-7713 or +49..30 1234567-",
    "no-one@" + "a" * 5000,
    "1" * 30_000,
    "a" * 100_000 + " x@y.zz " + "9 " * 20_000,
    "+1(((((((((((((((((( 5",
]


def check(rows, found):
    assert len(found) == len(rows)
    for r in found:
        want = base_spans(dict(rows)[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), r.doc_id
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in KINDS]
        assert set(want) <= set(filter(None, r.spans.split(",")))


def test_base_spans_of_odd_texts(documents):
    rows = list(enumerate(ODD))
    check(rows, summary(personal_data(documents(rows))).collect())


def test_base_spans_of_the_corpus(corpus):
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    check(rows, summary(personal_data(corpus)).collect())


def cards(count):
    out, k = [], 0
    while len(out) < count:
        k += 1
        digits = f"4{k * 7919 % 10**14:014d}"
        out += [digits + str(c) for c in range(10) if luhn(digits + str(c))]
    return out[:count]


def test_cards_that_run_together_are_added(documents):
    some = cards(300)
    rows = [(k, f"paid by {c} then") for k, c in enumerate(some)] + [(1000 + k, f"number {k:016d} here") for k in range(1, 200, 3)]
    rows += [(5000, f"first {some[0]} {some[1]} last"), (5001, "nothing of that kind")]
    found = {r.doc_id: r for r in summary(personal_data(documents(rows))).collect()}
    assert found[5000].n_card == 0
    assert found[5000].spans == "card:6:22,card:23:39"
    assert found[5001].spans == ""


def test_spelled_out_data_is_added_and_plain_numbers_are_not(documents):
    chance = __import__("random").Random(7)
    rows = []

    def put(text, span, kind):
        at = text.find(span) if span else None
        rows.append((len(rows), text, f"{kind}:{at}:{at + len(span)}" if span else ""))

    for k in range(160):
        name, part = f"ann{k}", "".join(chance.choice("abcdefgh") for _ in range(6))
        spelled = f"{name} (at) {part} [dot] org" if k % 2 else f"{name}[at]{part}(dot)com"
        put(f"You can write to {spelled} any day", spelled, "email")
        ip = ",".join(str(chance.randrange(256)) for _ in range(4))
        put(f"the server at {ip} is down", ip, "ip")
        put(f"scores were {ip} in the end", "", "")
        put(f"the server at {chance.randrange(300, 900)},{chance.randrange(900)},1,2 is a joke", "", "")
        phone = f"{chance.randrange(200, 999)}-{chance.randrange(200, 999)}-{chance.randrange(1000, 9999)}"
        put(f"tel. {phone} after six", phone, "phone")
        put(f"part no {phone} is sold out", "", "")
        put(f"call before 2024-{chance.randrange(10, 13)}-{chance.randrange(10, 28)} please", "", "")
        put(f"Nothing but {chance.randrange(10)} words here", "", "")
    found = {r.doc_id: r.spans for r in summary(personal_data(documents([(k, t) for k, t, _ in rows]))).collect()}
    wrong = [(t, found[k], want) for k, t, want in rows if found[k] != want]
    assert not wrong, wrong[:5]


def test_redaction(documents):
    rows = [(1, "Write é@x.yy or me@x.yy or 1.2.3.4!"), (2, None)]
    assert {r.doc_id: r.text for r in redacted(documents(rows)).collect()} == {1: "Write é@x.yy or [email] or [ip]!", 2: ""}


def test_empty_table(documents):
    assert personal_data(documents([])).count() == 0


@pytest.mark.parametrize("size", [0, 1, 255, 256, 257, 1000])
def test_running_sums(spark, size):
    values = [(k * 37) % 11 for k in range(size)]
    found = spark.createDataFrame([(values,)], "v array<int>").select(running_sums(__import__("pyspark").sql.functions.col("v")).alias("s")).first().s
    assert found == np.cumsum(values).tolist()


def test_trees_find_a_rule_and_say_it_in_sql(spark):
    grid = [(a, b) for a in range(4) for b in range(3)]
    cells = {"a": np.array([a for a, _ in grid]), "b": np.array([b for _, b in grid])}
    rows = np.full(len(grid), 50.0)
    good = np.where((cells["a"] >= 2) & (cells["b"] == 1), 49.0, 1.0)
    base, trees = boost(cells, ["a", "b"], rows, good)
    score = score_of(base, trees, cells)
    assert ((score > 0) == (good > 25)).all()
    said = spark.createDataFrame(grid, "a int, b int").selectExpr(sql_of(base, trees) + " AS s").collect()
    assert np.allclose([r.s for r in said], score)


def test_threshold():
    assert calibrated(np.array([3.0, 2.0, 1.0]), np.array([30.0, 30, 30]), np.array([30.0, 29, 10]), 0.95) == 2.0
    assert calibrated(np.array([3.0]), np.array([5.0]), np.array([5.0]), 0.95) is None
