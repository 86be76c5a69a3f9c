"""Repeated passages: runs of consecutive sentences that occur before, in any text, are removed.

A sentence ends at ``.``, ``!`` or ``?`` or at a line break. Where WINDOW words in a row hold no such end, the word of the smallest hash among
them (the last, if several are equal) ends a piece too. Whether a word does depends on the words around it only, so equal text is cut alike
wherever it stands, and pieces have at most WINDOW words. Any 5 * WINDOW - 1 whole words of a repeated passage hold SENTENCES pieces and WORDS words
between cuts that all its copies share: WINDOW words up to the first, at most 3 * WINDOW in the pieces, and WINDOW - 1 that may be cut otherwise by what follows.

From every sentence on, and up to every sentence, the shortest run of at least SENTENCES sentences and WORDS words is hashed (lower-cased words,
white space aside) to 128 bits. Every longer run is covered by such runs inside it. Runs are sorted globally by hash; the first by
doc_id and place stays, and the sentences of every other are removed.

Words are divided by ASCII white space, so in scripts without spaces a line, or what stands between two spaces, is one word, and only passages of
WORDS such words are found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.words import mix, text_blocks, words_of

SENTENCES = 3
WORDS = 20
#: So many words in a row hold an end of a piece.
WINDOW = 10

_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in ".!?"]] = True
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[10, 11, 12, 13]] = True
_STEPS = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x9FB21C651E98DF25))


def _inverse(step: np.uint64) -> np.uint64:
    return np.uint64(pow(int(step), -1, 1 << 64))


def sentences(words) -> np.ndarray:
    """For each word, whether a sentence ends with it; the end of a text always does."""
    n = len(words.start)
    if not n:
        return np.zeros(0, dtype=bool)
    last = np.append(words.text[1:] != words.text[:-1], True)
    # A line break in the white space behind the word.
    breaks = np.concatenate([[0], np.cumsum(_BREAK[words.data])])
    behind = np.append(words.start[1:], words.end[-1])
    ends = last | _ENDS[words.data[words.end - 1]] | (breaks[np.maximum(behind, words.end)] > breaks[words.end])
    if n < WINDOW:
        return ends
    value = np.where(ends, np.uint64(0), words.hash | np.uint64(1))
    # Backwards, so that the first smallest is the last.
    at = n - 1 - (np.lib.stride_tricks.sliding_window_view(value[::-1], WINDOW).argmin(axis=1) + np.arange(n - WINDOW + 1))
    ends[at] = True
    return ends


def runs(words, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first sentence, sentence behind the last, two hashes) of the shortest runs from and up to each sentence, in order; sentences count through the block."""
    close = np.flatnonzero(ends) + 1
    begin = np.concatenate([[0], close[:-1]]).astype(np.int64)
    text = words.text[begin] if len(begin) else begin
    place = np.arange(len(begin))
    last = np.maximum(place + SENTENCES - 1, np.searchsorted(close, begin + WORDS))
    first = np.minimum(place - SENTENCES + 1, np.searchsorted(begin, close - WORDS, side="right") - 1)
    on, up = last < len(begin), first >= 0
    on[on] = text[last[on]] == text[on]
    up[up] = text[first[up]] == text[up]
    # A run found both ways counts once.
    both = np.unique(np.concatenate([place[on] * len(begin) + last[on], first[up] * len(begin) + place[up]]))
    first, last = both // max(len(begin), 1), both % max(len(begin), 1)
    out = []
    for step in _STEPS:
        power = np.full(len(words.hash) + 1, step, dtype=np.uint64)
        power[0] = 1
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.hash * np.multiply.accumulate(power)[:-1], dtype=np.uint64)])
        back = np.full(len(words.hash) + 1, _inverse(step), dtype=np.uint64)
        back[0] = 1
        a, b = begin[first], close[last]
        out.append(mix((total[b] - total[a]) * np.multiply.accumulate(back)[a] + (b - a).astype(np.uint64)))
    return first, last + 1, *out


def _new(of: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Which runs are the first of their hash in their text."""
    new = np.zeros(len(a), dtype=bool)
    new[np.unique(mix(a + mix(of.astype(np.uint64))), return_index=True)[1]] = True
    return new


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, data, offsets in text_blocks(batch.column(1)):
            words = words_of(data, offsets)
            ends = sentences(words)
            if not len(ends):
                continue
            first, _, a, b = runs(words, ends)
            of = words.text[np.flatnonzero(ends)][first]
            place = np.arange(len(of)) - np.searchsorted(of, of) + (batch.column(2).to_numpy().astype(np.int64)[start + of] << 32)
            # Later repeats within a text are found again when it is cut.
            new = _new(of, a)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(start + of[new])),
                    pa.array(place[new]),
                    pa.array(a[new].view(np.int64)),
                    pa.array(b[new].view(np.int64)),
                ],
                names=["row", "place", "a", "b"],
            )


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, place) of the runs, sorted by hash, row and place, that aren't the first of their hash."""
    before = np.zeros((4, 0), dtype=np.int64)
    for batch in batches:
        # The first run of the hash that the last batch ended with stands before this one.
        runs = np.concatenate([before, [c.to_numpy().astype(np.int64) for c in batch.columns]], axis=1)
        if not runs.shape[1]:
            continue
        new = np.append(True, (runs[2:, 1:] != runs[2:, :-1]).any(axis=0))
        first = runs[:2, np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        later = (runs[:2] != first).any(axis=0)
        before = np.concatenate([first[:, -1:], runs[2:, -1:]])
        yield pa.RecordBatch.from_arrays([pa.array(runs[0, later]), pa.array(runs[1, later])], names=["row", "place"])


def _without(data: np.ndarray, offsets: np.ndarray, named: list[bool], removed: list[list[int] | None]) -> Iterator[tuple[bytes, int, int]]:
    """(text without the sentences of the runs at the given places and of repeats within a named text, sentences, removed sentences) of each text."""
    words = words_of(data, offsets)
    ends = sentences(words)
    close = np.flatnonzero(ends)
    of = words.text[close] if len(close) else close
    bound = np.searchsorted(of, np.arange(len(offsets)))
    first, behind, hashed, _ = runs(words, ends)
    new = _new(of[first], hashed)
    run = np.searchsorted(of[first], np.arange(len(offsets)))
    for i, places in enumerate(removed):
        a, b = bound[i], bound[i + 1]
        text = data[offsets[i] : offsets[i + 1]]
        gone = ~new[run[i] : run[i + 1]]
        gone[places or []] = True
        if not named[i] or not gone.any():
            yield text.tobytes(), int(b - a), 0
            continue
        at = run[i] + np.flatnonzero(gone)
        depth = np.zeros(b - a + 1, dtype=np.int64)
        np.add.at(depth, first[at] - a, 1)
        np.add.at(depth, behind[at] - a, -1)
        keep = np.cumsum(depth)[:-1] == 0
        # A sentence reaches to the first word of the next, so white space goes with it.
        begin = words.start[np.concatenate([[close[a - 1] + 1 if a else 0], close[a : b - 1] + 1])]
        begin[0] = offsets[i]
        size = np.diff(np.append(begin, offsets[i + 1]))
        yield text[np.repeat(keep, size)].tobytes(), int(b - a), int((~keep).sum())


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, data, offsets in text_blocks(batch.column(1)):
            n = len(offsets) - 1
            named = batch.column(0).slice(start, n).is_valid().to_pylist()
            rows = list(_without(data, offsets, named, batch.column(2).slice(start, n).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(start, n),
                    pa.array([t for t, _, _ in rows], pa.binary()).cast(pa.string()),
                    pa.array([k for _, k, _ in rows], pa.int64()),
                    pa.array([k for _, _, k in rows], pa.int64()),
                ],
                names=["doc_id", "text", "n_sentences", "n_removed"],
            )


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (without repeated sentences), n_sentences, n_removed, for each row.

    A null text is empty. The first occurrence is the one of the smallest doc_id, then the earliest place; within one text
    later repeats go as well. Rows that share a doc_id and a text count as one document, so the passages stay in each; with different texts they are documents of
    their own, in the order of a hash of the text. A row without doc_id takes no part and keeps its text. A whole copy of an earlier document ends up empty, if it has
    SENTENCES sentences and WORDS words. Texts of any length are taken whole. Other columns are ignored; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # 31 bits that tell texts of one doc_id apart; they travel in the upper half of the place.
    own = F.xxhash64("text").bitwiseAND(0x7FFFFFFF).cast("int").alias("own")
    source = source.select("doc_id", "text", own)
    hashed = source.filter("doc_id IS NOT NULL").mapInArrow(_hash_runs, "row long, place long, a long, b long")
    # One shuffle; sorted runs pass by, so that no hash's runs are gathered.
    again = hashed.repartition("a", "b").sortWithinPartitions("a", "b", "row", "place").mapInArrow(_later, "row long, place long")
    # Places of one document are gathered: no more than it has sentences.
    places = again.distinct().select("row", F.shiftright("place", 32).cast("int").alias("of"), F.col("place").bitwiseAND(0xFFFFFFFF).cast("int").alias("place"))
    spans = places.groupBy("row", "of").agg(F.collect_list("place").alias("removed"))
    joined = source.join(spans, (source["doc_id"] == spans["row"]) & (source["own"] == spans["of"]), "left").select("doc_id", "text", "removed")
    return joined.mapInArrow(_remove, "doc_id long, text string, n_sentences long, n_removed long")
