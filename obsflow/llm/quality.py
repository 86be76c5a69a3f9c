"""Quality of a text from weak labels.

Heuristic labellers each vote good, bad or nothing on a text. Their votes overlap and differ in accuracy; expectation-maximisation
over the counts of vote patterns of the whole corpus estimates how accurate each is, and the
share of good texts. There are at most 3 ** len(LABELLERS) patterns, so only those counts reach the driver. The
posterior of a text's pattern is its label for a linear scorer over hashed features: runs of three character classes, and
the levels of the labellers' measures. It is fitted on a sample of at most about FIT_ROWS rows, in PARTS parts whose weights are
averaged, and scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.staging import staged
from obsflow.llm.words import mix, text_blocks, words_of

#: (name, good at most or never, bad from) for measures of which less is better. Most only ever speak against a text.
LABELLERS = (
    ("symbols", -1.0, 0.05),
    ("capitals", -1.0, 0.30),
    ("digits", -1.0, 0.12),
    ("marked_words", -1.0, 0.10),
    ("one_word", -1.0, 0.25),
    ("repeated_pairs", 0.25, 0.50),
    ("few_words", -1.0, 0.67),
)
ROUNDS = 100
#: Between which bounds the accuracy of votes against and for a text is estimated.
AGAINST, FOR = (0.9, 0.995), (0.5, 0.75)
#: The same for a labeller that speaks against texts without regard to what the others say: it may well be wrong most times.
UNRELATED = (0.05, 0.995)
#: Votes against are unrelated to the others' if they are so many times as frequent with them as without, and this many would meet by chance.
RATIO, BY_CHANCE = (0.5, 2.0), 10.0
FIT_ROWS = 20_000
PARTS = 8
BITS = 14
STEPS, RATE, DECAY = 300, 4.0, 1e-4
#: A text whose posterior lies between the share of good texts and certainty scores above this; a vote against it brings it below.
KEEP_FROM = 0.75

_CLASS = np.array(
    [
        4 if b in b"\n\r" else 3 if b in b"\t\v\f " else 2 if chr(b).isdigit() and b < 128 else 0 if 97 <= b <= 122 else 1 if 65 <= b <= 90 else 5 if b >= 192 else 6 if b >= 128 else 7 + b % 25
        for b in range(256)
    ],
    dtype=np.uint32,
)
_SYMBOL = np.array([33 <= b < 127 and not chr(b).isalnum() and chr(b) not in ".,;:'\"-?()" for b in range(256)])
_CAPITAL = np.array([65 <= b <= 90 for b in range(256)])
_LETTER = np.array([chr(b).isalpha() or b >= 128 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
LEVELS = 12
#: Value of a measure's level as a feature, beside shares whose squares sum to 1.
LEVEL_VALUE = 1.0
SIZE = (1 << BITS) + len(LABELLERS) * LEVELS


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of measures between 0 and 1 for each text, as LABELLERS names them; 0 where there is nothing to measure."""
    n = len(offsets) - 1
    words = words_of(data, offsets, lower=False)
    first = words.of_text(n)
    count = np.diff(first)

    def share(flag: np.ndarray, of: np.ndarray) -> np.ndarray:
        both = [np.concatenate([[0], np.cumsum(x)])[offsets] for x in (flag, of)]
        return np.diff(both[0]) / np.maximum(np.diff(both[1]), 1)

    solid = data > 32
    marked = np.concatenate([[0], np.cumsum(_SYMBOL[data[words.end - 1]])])[first]
    one, pairs = np.zeros(n), np.zeros(n)
    for i in np.flatnonzero(count >= 8):
        h = words.hash[first[i] : first[i + 1]]
        one[i] = np.unique(h, return_counts=True)[1].max() / len(h)
        pairs[i] = 1 - len(np.unique(mix(h[1:] + h[:-1] * np.uint64(3)))) / (len(h) - 1)
    return np.stack(
        [
            share(_SYMBOL[data], solid),
            share(_CAPITAL[data], _LETTER[data]),
            share(_DIGIT[data], solid),
            np.diff(marked) / np.maximum(count, 1),
            one,
            pairs,
            1 / (1 + count / 2),
        ],
        axis=1,
    )


def votes(found: np.ndarray) -> np.ndarray:
    """2 good, 0 bad, 1 nothing."""
    good, bad = (np.array([x[k] for x in LABELLERS]) for k in (1, 2))
    return np.where(found <= good, 2, np.where(found >= bad, 0, 1)).astype(np.int8)


def unrelated(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each labeller, whether its votes against are about as frequent where another one votes against as elsewhere."""
    against = patterns == 0
    out = np.zeros(patterns.shape[1], dtype=bool)
    for k in range(patterns.shape[1]):
        other = np.delete(against, k, axis=1).any(axis=1)
        cast, spoken = counts[against[:, k]].sum(), counts[other].sum()
        both = counts[against[:, k] & other].sum()
        with_others, alone = (both + 0.5) / (spoken + 1), (cast - both + 0.5) / (counts.sum() - spoken + 1)
        out[k] = cast * spoken / counts.sum() >= BY_CHANCE and RATIO[0] <= with_others / alone <= RATIO[1]
    return out


def latent_classes(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of good texts, accuracies of each labeller's votes against and for, posterior of good by pattern).

    A labeller votes as often on good texts as on bad ones and is right with a probability of its own for either vote, kept
    within AGAINST and FOR. The bounds keep a rare kind of bad text, on which one labeller alone votes, from passing as good
    because all others have nothing to say. A labeller whose votes against are unrelated to the others' has UNRELATED in place of AGAINST.
    """
    least = np.where(unrelated(patterns, counts), UNRELATED[0], AGAINST[0])
    side = patterns.astype(float) - 1
    good = np.clip(0.5 + side.sum(axis=1) / 2, 0.05, 0.95)
    share, accuracy = 0.5, np.zeros((2, patterns.shape[1]))
    for _ in range(rounds):
        share = float(np.clip((counts * good).sum() / counts.sum(), 0.01, 0.99))
        odds = np.full(len(counts), np.log(share / (1 - share)))
        for k, (vote, belief, bounds) in enumerate(((-1, 1 - good, (least, AGAINST[1])), (1, good, FOR))):
            cast = (side == vote) * counts[:, None]
            right = ((cast * belief[:, None]).sum(axis=0) + 4.0) / (cast.sum(axis=0) + 5.0)
            accuracy[k] = np.clip(right, *bounds)
            odds += vote * ((side == vote) @ np.log(accuracy[k] / (1 - accuracy[k])))
        good = 1 / (1 + np.exp(-odds))
    return share, accuracy, good


def features(data: np.ndarray, offsets: np.ndarray, found: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, values) of each text's hashed features."""
    kind = _CLASS[data]
    level = np.minimum((np.sqrt(found) * LEVELS).astype(int), LEVELS - 1) + np.arange(len(LABELLERS)) * LEVELS + (1 << BITS)
    for i in range(len(offsets) - 1):
        k = kind[offsets[i] : offsets[i + 1]]
        places, values = level[i], np.full(len(LABELLERS), LEVEL_VALUE)
        if len(k) > 2:
            code = (k[:-2] * 1024 + k[1:-1] * 32 + k[2:]) * np.uint32(2654435761) >> np.uint32(32 - BITS)
            seen = np.bincount(code, minlength=1 << BITS)
            at = np.flatnonzero(seen)
            places, values = np.concatenate([at, places]), np.concatenate([np.sqrt(seen[at] / len(code)), values])
        yield places, values


def _fit_part(texts: pd.DataFrame) -> np.ndarray:
    rows, places, values = [], [], []
    done = 0
    for start, data, offsets in text_blocks(pa.array(texts["text"], pa.string())):
        for at, x in features(data, offsets, measures(data, offsets)):
            rows.append(np.full(len(at), done))
            places.append(at)
            values.append(x)
            done += 1
    rows, places, values = map(np.concatenate, (rows, places, values))
    wanted, weights, bias = texts["label"].to_numpy(), np.zeros(SIZE), 0.0
    for _ in range(STEPS):
        error = wanted - 1 / (1 + np.exp(-np.bincount(rows, values * weights[places], minlength=done) - bias))
        weights = weights * (1 - DECAY) + RATE * np.bincount(places, values * error[rows], minlength=SIZE) / done
        bias += RATE * error.mean()
    return np.append(weights, bias)


def vote_patterns(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, pattern): the labellers' votes on each text, in order."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data, offsets in text_blocks(batch.column(1)):
                given = votes(measures(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(given)), pa.array(["".join(map(str, row)) for row in given], pa.string())], names=["doc_id", "pattern"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text_col).cast("string").alias("text")).mapInArrow(vote, f"doc_id {kind}, pattern string")


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, dict[str, float]]:
    """(weights and bias of the scorer, posterior of good by vote pattern). An empty corpus gives weights of 0."""
    patterns = staged(vote_patterns(docs), "quality-votes")
    counted = sorted((r["pattern"], r["n"]) for r in patterns.groupBy("pattern").agg(F.count("*").alias("n")).collect())
    if not counted:
        return np.zeros(SIZE + 1), {}
    _, _, good = latent_classes(np.array([[int(v) for v in p] for p, _ in counted]), np.array([n for _, n in counted], dtype=float))
    believed = {p: round(float(g), 9) for (p, _), g in zip(counted, good)}
    total = sum(n for _, n in counted)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1_000_000)) < min(1.0, fit_rows / total) * 1_000_000
    sample = docs.filter(drawn).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("text", kind="stable")
        given = np.concatenate([votes(measures(data, offsets)) for _, data, offsets in text_blocks(pa.array(rows["text"], pa.string()))])
        rows = rows.assign(label=[believed.get("".join(map(str, v)), 0.5) for v in given])
        return pd.DataFrame({"n": [len(rows)], "weights": [_fit_part(rows)]})

    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(PARTS))
    fitted = sample.groupBy(part).applyInPandas(train, "n long, weights array<double>").collect()
    if not fitted:
        return np.zeros(SIZE + 1), believed
    fitted = sorted(fitted, key=lambda r: (r["n"], r["weights"][-1]))
    shares = np.array([r["n"] for r in fitted], dtype=float)
    return np.round((np.array([r["weights"] for r in fitted]) * shares[:, None]).sum(axis=0) / shares.sum(), 9), believed


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value[:-1], sent.value[-1]
        for batch in batches:
            for start, data, offsets in text_blocks(batch.column(1)):
                margins = [float(x @ weights[at]) for at, x in features(data, offsets, measures(data, offsets))]
                empty = np.diff(words_of(data, offsets).of_text(len(offsets) - 1)) == 0
                scores = np.where(empty, 0.0, 1 / (1 + np.exp(-np.clip(np.array(margins) + bias, -50, 50))))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(margins)), pa.array(np.round(scores, 6))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def classify(docs: DataFrame) -> DataFrame:
    """doc_id, score (probability of good text), kept (score of at least KEEP_FROM), for each row.

    A null or blank text scores 0. Repeated rows score alike; rows without doc_id are scored too. Labels are
    never read. Other columns are ignored; an empty table gives an empty result.
    """
    weights, _ = fit(docs)
    return score(docs, weights).withColumn("kept", F.col("score") >= KEEP_FROM)
