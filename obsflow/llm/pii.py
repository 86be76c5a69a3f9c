"""Personal data in text: exact base rules, and further spans chosen by boosted trees. DataFrame operations only.

Base rules find e-mail addresses, IP addresses, card and phone numbers. Generators with wide patterns propose
further spans, which may overlap. Each has features of format and context. Its label is evidence that doesn't rest on the base rule alone: a spelled-out address that is one once its
signs are put in, four numbers in the range of an address that commas part behind a word that announces one, a number of a phone's length behind such a word or a country
code, a card's checksum. What has no evidence counts as wrong. All candidates of the corpus are counted by kind
and features (of which there are a fixed number of combinations), trees are boosted on the counts of three quarters of the documents, and
for each kind the counts of the other quarter give the lowest score at which at least PRECISION of the candidates were right. A
candidate at or above it that overlaps no base span is added.

Positions are code points. They are sums of the lengths of what a pattern matches and of what lies between, so a text is
scanned once for each and never cut at a position.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.llm.boosting import boost, score_of, sql_of
from obsflow.llm.staging import staged

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
#: Fewest held-out candidates that a threshold rests on.
SUPPORT = 20
CONTEXT = 24

# The base patterns. What is put in front of them only spares vain starts inside a run: a match
# begins where the run does, or where the match before has ended. Repeated groups are possessive: nothing follows
# them, so they match the same, but without a call on the stack for each repetition of a long run.
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
VALID_IP = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"

# Wide patterns of the generators.
WIDE_EMAIL = r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]{1,64}(?:@|\x20?[\[(]at[\])]\x20?)[\p{L}0-9-]{1,63}(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[\p{L}0-9-]{1,63}){1,8}"
WIDE_IP = r"(?<![0-9.,])[0-9]{1,3}(?:[.,][0-9]{1,3}){3}(?![0-9])"
WIDE_CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20.-][0-9]{4}){2}[\x20.-][0-9]{1,7})(?![0-9])"
WIDE_PHONE = r"(?<![0-9])(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[\x20./-][0-9]{2,4}){2,4}(?![0-9])"
#: Words that announce such data.
PHONE_CUES = r"(?i)(?:tel|phone|fon|mobil|call|fax|ruf)[^\n]{0,12}$"
IP_CUES = r"(?i)(?:server|host|address|\bip\b)[^\n]{0,12}$"
#: Four digits of a year at either end of three groups.
DATE = r"^(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2})"
CUES = r"(?i)(?:mail|tel|phone|fon|mobil|call|fax|card|visa|pay|konto|server|host|address|\bip\b)[^\n]{0,12}$"

FEATURES = ["f_digits", "f_groups", "f_joint", "f_check", "f_before", "f_after", "f_cue"]


def running_sums(values: Column) -> Column:
    """Sums of an integer array up to each place. In blocks, so that long arrays aren't copied at every step."""
    block = 256
    zero = F.struct(F.lit(0).alias("sum"), F.expr("CAST(array() AS array<int>)").alias("out"))

    def add(state: Column, x: Column) -> Column:
        return F.struct((state["sum"] + x).alias("sum"), F.array_append(state["out"], state["sum"] + x).alias("out"))

    def before(state: Column, x: Column) -> Column:
        return F.struct((state["sum"] + F.element_at(x, -1)).alias("sum"), F.array_append(state["out"], state["sum"]).alias("out"))

    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(values) / block).cast("int") - 1, F.lit(0)))
    inner = F.transform(starts, lambda b: F.aggregate(F.slice(values, b * block + 1, F.lit(block)), zero, add, lambda s: s["out"]))
    pair = F.struct(inner.alias("inner"))
    shift = lambda p: F.aggregate(p["inner"], zero, before, lambda s: s["out"])
    moved = F.transform(
        F.array(pair),
        lambda p: F.flatten(F.zip_with(p["inner"], shift(p), lambda xs, by: F.transform(xs, lambda x: x + by))),
    )
    return F.when(F.size(values) > 0, F.element_at(moved, 1)).otherwise(F.expr("CAST(array() AS array<int>)"))


def _scanned(docs: DataFrame, scans: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds for each name an array of (hit, before, after, start, end): the matches of its pattern, if its condition holds."""
    empty = F.expr("CAST(array() AS array<string>)")
    cut, hit = {}, {}
    for name, (pattern, where) in scans.items():
        hit[f"{name}_hits"] = F.when(where, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(empty)
    docs = docs.withColumns(hit)
    for name, (pattern, _) in scans.items():
        cut[f"{name}_cut"] = F.when(F.size(f"{name}_hits") > 0, F.split("text", pattern, -1)).otherwise(empty)
    docs = docs.withColumns(cut)
    ends = {f"{n}_ends": running_sums(F.zip_with(F.slice(f"{n}_cut", F.lit(1), F.size(f"{n}_hits")), f"{n}_hits", lambda a, b: F.length(a) + F.length(b))) for n in scans}
    docs = docs.withColumns(ends)

    def item(name: str):
        def make(h: Column, i: Column) -> Column:
            end = F.get(f"{name}_ends", i)
            return F.struct(
                h.alias("hit"),
                F.right(F.get(f"{name}_cut", i), F.lit(CONTEXT)).alias("before"),
                F.left(F.get(f"{name}_cut", i + 1), F.lit(CONTEXT)).alias("after"),
                (end - F.length(h)).alias("start"),
                end.alias("end"),
            )

        return make

    return docs.withColumns({n: F.transform(f"{n}_hits", item(n)) for n in scans}).drop(*hit, *cut, *ends)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _valid(kind: str, hit: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return hit.rlike(VALID_IP)
    n = F.length(_digits(hit))
    if kind == "card":
        return n.between(14, 19) & F.call_function("luhn_check", F.when(n.between(14, 19), _digits(hit)))
    return n.between(10, 15)


def _neighbour(text: Column) -> Column:
    """0 none, 1 white space, 2 letter, 3 digit, 4 other."""
    return (
        F.when(F.length(text) == 0, 0).when(text.rlike(r"^\s$"), 1).when(text.rlike(r"^\p{L}$"), 2).when(text.rlike(r"^[0-9]$"), 3).otherwise(4)
    )


def _candidate(kind: int, c: Column) -> Column:
    """The span with its features, whether it is right, and whether a base span has it already."""
    name, hit = KINDS[kind], c["hit"]
    digits = F.length(_digits(hit))
    if name == "email":
        plain = r"^" + _LOCAL + r"+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$"
        signs = F.regexp_replace(F.regexp_replace(hit, r"\x20?[\[(]at[\])]\x20?", "@"), r"\x20?[\[(]dot[\])]\x20?", ".")
        based = hit.rlike(plain)
        right = signs.rlike(plain) & signs.rlike(r"(?i)\.[a-z]{2,10}$")
        check = F.when(hit.rlike(r"(?i)(\.|dot[\])]\x20?)[a-z]{2,10}$"), 1).otherwise(0)
    elif name == "ip":
        based = hit.rlike(VALID_IP)
        ranged = F.translate(hit, ",", ".").rlike(VALID_IP)
        right, check = based | (ranged & c["before"].rlike(IP_CUES)), F.when(ranged, 1).otherwise(0)
    elif name == "card":
        right = digits.between(14, 19) & F.call_function("luhn_check", _digits(hit))
        check = F.when(F.call_function("luhn_check", _digits(hit)), 1).otherwise(0)
        based = F.lit(False)  # a longer run of digits decides; overlaps with base spans are sorted out later
    else:
        based = c["before"].rlike(r"\+[0-9]{1,3}[\x20.(-]*$")
        right = based | (c["before"].rlike(PHONE_CUES) & digits.between(9, 15) & ~hit.rlike(DATE))
        check = F.when(hit.rlike(DATE), 3).when(hit.rlike(r"^\("), 2).when(hit.rlike(r"[-/.]"), 1).otherwise(0)
    joint = F.when(hit.contains("-"), 1).otherwise(0) + F.when(hit.contains(" "), 2).otherwise(0) + F.when(hit.contains("."), 4).otherwise(0)
    groups = F.least(F.length(F.regexp_replace(hit, r"[^\x20.,/()\[\]@-]", "")), F.lit(7))
    # A phone's own country code is its label, not its context.
    before = F.regexp_replace(c["before"], r"\+?[0-9]{0,3}[\x20.(-]*$", "") if name == "phone" else c["before"]
    return F.struct(
        F.lit(kind).alias("kind"),
        c["start"].alias("start"),
        c["end"].alias("end"),
        right.alias("right"),
        based.alias("based"),
        F.least(digits, F.lit(20)).alias("f_digits"),
        groups.alias("f_groups"),
        joint.alias("f_joint"),
        check.alias("f_check"),
        _neighbour(F.right(before, F.lit(1))).alias("f_before"),
        _neighbour(F.left(c["after"], F.lit(1))).alias("f_after"),
        F.when(before.rlike({"ip": IP_CUES, "phone": PHONE_CUES}.get(name, CUES)), 2).when(before.rlike(CUES), 1).otherwise(0).alias("f_cue"),
    )


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base (start, kind, end; sorted) and candidates of each row."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    at = F.col("text").contains("@")
    texts = texts.withColumns({"_at": at, "_num": F.col("text").rlike("[0-9][^A-Za-z0-9]{0,2}[0-9]")}).withColumn(
        "_dots", F.col("_num") & F.col("text").rlike(r"[0-9][.,][0-9]")
    )
    spelled = F.col("_at") | F.col("text").contains("at)") | F.col("text").contains("at]")
    scans = {
        "email": (EMAIL, F.col("_at")),
        "ip": (IP, F.col("_dots")),
        "card": (CARD, F.col("_num")),
        "phone": (PHONE, F.col("text").contains("+")),
        "wide_email": (WIDE_EMAIL, spelled),
        "wide_ip": (WIDE_IP, F.col("_dots")),
        "wide_card": (WIDE_CARD, F.col("_num")),
        "wide_phone": (WIDE_PHONE, F.col("_num")),
    }
    scanned = _scanned(texts, scans)

    def based(kind: int):
        name = KINDS[kind]
        kept = F.filter(name, lambda c: F.coalesce(_valid(name, c["hit"]), F.lit(False)))
        return F.transform(kept, lambda c: F.struct(c["start"].alias("start"), F.lit(kind).alias("kind"), c["end"].alias("end")))

    def proposed(kind: int):
        return F.transform(f"wide_{KINDS[kind]}", lambda c: _candidate(kind, c))

    every = range(len(KINDS))
    return scanned.select(
        "doc_id",
        F.array_sort(F.concat(*[based(k) for k in every])).alias("base"),
        F.concat(*[proposed(k) for k in every]).alias("candidates"),
    )


def learned_rules(found: DataFrame, precision: float = PRECISION) -> dict[int, tuple[str, float]]:
    """For each kind the score as SQL over the features, and its threshold. Only counts of cells reach the driver."""
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    counted = (
        found.select(fold.alias("held"), F.explode("candidates").alias("c"))
        .select("held", "c.*")
        .groupBy("held", "kind", *FEATURES)
        .agg(F.count("*").alias("n"), F.sum(F.col("right").cast("long")).alias("good"))
        .orderBy("held", "kind", *FEATURES)
        .collect()
    )
    rules = {}
    for kind in range(len(KINDS)):
        fit, held = ([r for r in counted if r["kind"] == kind and bool(r["held"]) == x] for x in (False, True))
        if not fit or not held:
            continue
        table = lambda rows: {f: np.array([r[f] for r in rows], dtype=np.int64) for f in FEATURES}
        of = lambda rows, name: np.array([r[name] or 0 for r in rows], dtype=np.float64)
        base, trees = boost(table(fit), FEATURES, of(fit, "n"), of(fit, "good"))
        score = np.round(score_of(base, trees, table(held)), 6)
        threshold = calibrated(score, of(held, "n"), of(held, "good"), precision)
        if threshold is not None:
            rules[kind] = sql_of(base, trees), threshold
    return rules


def calibrated(score: np.ndarray, rows: np.ndarray, good: np.ndarray, precision: float) -> float | None:
    """The lowest score such that of all candidates with it, and of those from it on, ``precision`` are right."""
    lowest, total, right = None, 0.0, 0.0
    for at in np.unique(score)[::-1]:
        here = score == at
        total, right = total + rows[here].sum(), right + good[here].sum()
        if good[here].sum() < precision * rows[here].sum() or right < precision * total:
            break
        if total >= SUPPORT:
            lowest = float(at)
    return lowest


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, base and spans as arrays of (start, kind, end), kind as a number into KINDS.

    ``spans`` has all of ``base`` and the further ones, by start, then kind. A null text is empty and has none. Repeated rows and rows
    without doc_id are each returned; if the corpus has too few candidates of a kind for a threshold, none of it is
    added. Texts of any length are read whole. Other columns are ignored; an empty table gives an empty result.
    """
    found = staged(found_spans(docs, id_col, text_col), "personal-data")
    rules = learned_rules(found)
    chosen = "false"
    for kind, (score, threshold) in rules.items():
        for feature in FEATURES:
            score = score.replace(feature + " ", f"c.{feature} ")
        chosen += f" OR (c.kind = {kind} AND {score} >= {threshold - 1e-6!r}D)"
    picked = found.withColumn("_picked", F.expr(f"filter(candidates, c -> NOT c.based AND ({chosen}))"))
    extra = F.expr(
        "transform(filter(_picked, c -> NOT exists(base, b -> b.start < c.end AND c.start < b.end)),"
        " c -> named_struct('start', c.start, 'kind', c.kind, 'end', c.end))"
    )
    return picked.select("doc_id", "base", F.array_sort(F.array_distinct(F.concat("base", extra))).alias("spans"))


def summary(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    counts = [F.expr(f"CAST(size(filter(base, b -> b.kind = {k})) AS BIGINT)").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text with every span replaced by its kind in brackets; spans that overlap are one, named by the first."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = personal_data(docs, id_col, text_col).select("doc_id", "spans").distinct()
    both = texts.join(spans.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")))
    names = "array(" + ", ".join(f"'[{k}]'" for k in KINDS) + ")"
    step = (
        "aggregate(spans, named_struct('at', 0, 'out', ''), (a, s) -> IF(s.end <= a.at, a, IF(s.start < a.at,"
        " named_struct('at', s.end, 'out', a.out),"
        f" named_struct('at', s.end, 'out', concat(a.out, substring(text, a.at + 1, s.start - a.at), {names}[s.kind])))),"
        " a -> concat(a.out, substring(text, a.at + 1)))"
    )
    return both.select("doc_id", F.expr(step).alias("text"))
