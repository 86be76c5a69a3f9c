"""Runs of words that repeat with a period, found by recursive frequency splitting.

A run of at least LENGTH words and three times its period holds each of its words three times or more. So a word that occurs less often
within a segment can't be part of a run inside it: such words split the segment, what is too short goes, and the rest is counted and split again until
nothing changes. Segments that survive are scanned at their lags.

Lags below SMALL are scanned over the whole segment. For lags from Q to 2 * Q - 1, a run holds a whole block of Q words that starts at a multiple
of Q, and the same block one lag further: hashes of all windows of Q words name the lags at which a block comes again, and each is confirmed on the words and extended
to both sides. A lag inside a run found before, of a smaller period, has that smaller period as well and is passed over. So a segment of n words takes on the order
of n log n steps, also if it is one long run.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.words import mix, powers

LENGTH = 24
TIMES = 3
SMALL = 32
_STEP = np.uint64(0x9E3779B185EBCA87)


def splits(codes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of the segments in which every word occurs often enough."""
    todo = [(0, len(codes))]
    while todo:
        start, end = todo.pop()
        if end - start < LENGTH:
            continue
        part = codes[start:end]
        _, part, count = np.unique(part, return_inverse=True, return_counts=True)
        rare = np.flatnonzero(count[part] < TIMES)
        if not len(rare):
            yield start, end
            continue
        at = np.concatenate([[start - 1], start + rare, [end]])
        for k in np.flatnonzero(np.diff(at) > LENGTH)[::-1]:
            todo.append((int(at[k]) + 1, int(at[k + 1])))


class Lags:
    """The runs of one segment, smallest period first."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.n = codes, len(codes)
        self.runs: list[tuple[int, int, int]] = []
        # For each word, the end of the furthest run found so far that holds it.
        self.covered = np.zeros(self.n + 1, dtype=np.int64)
        value = mix(codes.astype(np.uint64) + np.uint64(1))
        self.power = powers(_STEP, self.n + 1)
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * self.power[: self.n], dtype=np.uint64)])

    def found(self, start: int, length: int, period: int) -> None:
        self.runs.append((start, length, period))
        held = self.covered[start : start + length]
        np.maximum(held, start + length, out=held)

    def small(self) -> None:
        for q in range(1, min(SMALL, self.n // TIMES + 1)):
            same = np.concatenate([[False], self.codes[q:] == self.codes[:-q], [False]])
            edge = np.flatnonzero(same[1:] != same[:-1])
            for start, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
                if end + q - start >= max(LENGTH, TIMES * q) and self.covered[start] < end + q:
                    self.found(start, end + q - start, q)

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all windows of ``size`` words, brought to the same power."""
        raw = self.total[size:] - self.total[:-size]
        return raw * self.power[self.n - size :: -1][: len(raw)]

    def same_until(self, a: int, b: int) -> int:
        """How many words from a and from b (later) on are the same."""
        done, step = 0, 64
        while b + done < self.n:
            m = min(step, self.n - b - done)
            other = np.flatnonzero(self.codes[a + done : a + done + m] != self.codes[b + done : b + done + m])
            if len(other):
                return done + int(other[0])
            done, step = done + m, step * 2
        return done

    def same_back(self, a: int, b: int) -> int:
        """How many words before a and before b (later) are the same."""
        done, step = 0, 64
        while a - done > 0:
            m = min(step, a - done)
            other = np.flatnonzero(self.codes[a - done - m : a - done] != self.codes[b - done - m : b - done])
            if len(other):
                return done + m - 1 - int(other[-1])
            done, step = done + m, step * 2
        return done

    def large(self) -> None:
        size = SMALL
        while TIMES * size <= self.n:
            hashes = self.windows(size)
            pairs = []
            for c in range(0, self.n - 2 * size + 1, size):
                near = np.flatnonzero(hashes[c + size : c + 2 * size] == hashes[c])
                # Without one for each repeat inside a run of a smaller period.
                if len(near):
                    near = near[c + near + 2 * size > self.covered[c]]
                pairs += [(int(p) + size, c) for p in near]
            for q, c in sorted(pairs):
                if self.covered[c] >= c + q + size:
                    continue
                ahead, back = self.same_until(c, c + q), self.same_back(c, c + q)
                if ahead + back + q >= max(LENGTH, TIMES * q):
                    self.found(c - back, ahead + back + q, q)
            size *= 2

    def all(self) -> list[tuple[int, int, int]]:
        self.small()
        self.large()
        return self.runs


def periodic_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    if len(words) < LENGTH:
        return []
    known: dict[bytes, int] = {}
    codes = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    runs = [(start + s, length, q) for start, end in splits(codes) for s, length, q in Lags(codes[start:end]).all()]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def looped(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Every tenth document, by the checksum of its id, goes on with a loop of its own words."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    piece = words[a : a + p]
    return words[:a] + (piece * ((n - a) // p + 1))[: n - a]


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Without what a run holds behind its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, q in runs:
        depth[start + q] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0).tolist()]


def _finder(loop: bool):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for begin in range(0, len(texts), 256):
                part = batch.slice(begin, 256)
                found, short = [], []
                for i in range(len(part)):
                    words = (texts[begin + i].as_py() or b"").split()
                    if loop:
                        words = looped(words, part.column(0)[i].as_py())
                    runs = periodic_runs(words)
                    found.append([{"start": s, "length": m, "period": q} for s, m, q in runs])
                    short.append(b" ".join(kept_words(words, runs)))
                kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, kind), pa.array(short, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"]
                )

    return find


def collapse_periodic(docs: DataFrame, loop: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, runs (array of start, length, period, by start, then period), collapsed (the text without repeats), for each row.

    A run is a stretch of words (divided by ASCII white space) of smallest period q, at least LENGTH and 3 * q words long, that can't be extended. What it holds behind its first
    period is left out of ``collapsed``, whose words are joined by one space. ``loop`` first makes every tenth document, by its id, repeat its own words, to have some to find.

    A null or blank text has no words and no runs. Rows are judged each by its own text, so repeated rows and ids are alike; a row without doc_id is never looped. Texts of any length
    are read whole, one at a time. Other columns are ignored; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(_finder(loop), "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def _ahead(a, b):
    """Order of two runs: the greater length by period comes first, then the smaller start, then the smaller period."""
    left, right = a["length"] * b["period"], b["length"] * a["period"]
    return (
        F.when(left != right, F.when(left > right, -1).otherwise(1))
        .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
        .otherwise(F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))
    )


def summary(found: DataFrame) -> DataFrame:
    """For each document the number of runs, the one of greatest exponent, and digests of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    top = F.try_element_at(F.array_sort("runs", _ahead), F.lit(1))
    return found.withColumn("_top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_top.start").alias("start"),
        F.col("_top.length").alias("length"),
        F.col("_top.period").alias("period"),
        F.expr("_top.length * 1000 div _top.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
