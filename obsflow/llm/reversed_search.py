"""Ranked lexical search the other way round: the items' terms are the index, and documents stream through it.

The items of a block, with their distinct terms, make an inverted index that every task gets by broadcast. A first pass reads each document once and writes how many
terms it has and how often those of the index occur in it; from that come the number of documents, all their terms, and in how many documents a
term occurs. A second pass streams the written counts through the index: each term of a document adds to the scores of its items, and a score that
beats the worst of an item's heap of k goes in. A task's heaps come out when its documents end, and are merged by score and doc_id.

Items are dealt to blocks so that an index holds about BLOCK_TERMS terms of items, whatever their number; a document's counts are then written and read once for each block.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.staging import staged

#: Terms of items in one index; an item whose text has more is a block of its own.
BLOCK_TERMS = 1_000_000
#: Scores (documents times items), and additions to them, that are in memory at once.
TOGETHER = 1 << 20
#: Bytes of a text whose terms are in memory at once.
PIECE = 1 << 20

_LETTERS = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms_of(text: bytes | None) -> Iterator[list[bytes]]:
    """Digits, ASCII letters (lower-cased) and all beyond ASCII, in maximal runs; lists of the runs of about PIECE bytes."""
    text, start = (text or b"").translate(_LETTERS), 0
    while start < len(text):
        end = text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        for i in range(len(batch)):
            found = sorted({t for terms in terms_of(texts[i].as_py()) for t in terms})
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * len(found), pa.int64()), pa.array(found, pa.binary()).cast(pa.string())], names=["item_id", "term"]
                )


class Index:
    """Items of each term: those of term t are item[start[t]:start[t + 1]]."""

    def __init__(self, pairs: list[tuple[int, str]]):
        self.items = sorted({i for i, _ in pairs})
        self.terms = {t: k for k, t in enumerate(sorted({t.encode() for _, t in pairs}))}
        at = {i: k for k, i in enumerate(self.items)}
        posting = sorted((self.terms[t.encode()], at[i]) for i, t in pairs)
        self.item = np.array([i for _, i in posting], dtype=np.int64)
        self.start = np.searchsorted([t for t, _ in posting], np.arange(len(self.terms) + 1))


def _counter(index):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value.terms
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            size, terms, times = [], [], []
            for i in range(len(batch)):
                n, found = 0, Counter()
                for part in terms_of(texts[i].as_py()):
                    n += len(part)
                    found.update(map(known.get, part))
                found.pop(None, None)
                size.append(n)
                terms.append(list(found.keys()))
                times.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "times"],
            )

    return count


class Heaps:
    """The k best documents of each item so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n_items)]
        # What has to be beaten: the worst score, and of equal ones the largest doc_id.
        self.worst = np.zeros(n_items, dtype=np.int64)
        self.worst_id = np.full(n_items, np.iinfo(np.int64).min)

    def offer(self, docs: np.ndarray, scores: np.ndarray) -> None:
        """scores: documents by items."""
        better = (scores > self.worst) | ((scores == self.worst) & (docs[:, None] < self.worst_id))
        for row, item in zip(*(x.tolist() for x in np.nonzero(better))):
            heap, entry = self.heaps[item], (int(scores[row, item]), -int(docs[row]))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.worst[item], self.worst_id[item] = heap[0][0], -heap[0][1]


def _searcher(index, weights, documents: int, all_terms: int, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, posting, start = index.value.items, index.value.item, index.value.start
        fan, weight = np.diff(start), np.array(weights.value, dtype=np.int64)
        heaps = Heaps(len(items), k)
        rows = max(TOGETHER // max(len(items), 1), 1)
        for batch in batches:
            for begin in range(0, len(batch), rows):
                part = batch.slice(begin, rows)
                docs, n = part.column(0).to_numpy(), part.column(1).to_numpy()
                terms, times = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()
                row = np.repeat(np.arange(len(part)), part.column(2).value_lengths().to_numpy())
                m = 10 + (90 * n * documents) // all_terms
                value = weight[terms] * ((1_000_000_000 * times) // (1000 * times + 8 * m[row]))
                scores = np.zeros(len(part) * len(items), dtype=np.int64)
                ends = np.cumsum(fan[terms])
                i = 0
                while i < len(terms):
                    j = max(int(np.searchsorted(ends, (ends[i - 1] if i else 0) + TOGETHER, side="right")), i + 1)
                    count = fan[terms[i:j]]
                    within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                    item = posting[np.repeat(start[terms[i:j]], count) + within]
                    np.add.at(scores, np.repeat(row[i:j], count) * len(items) + item, np.repeat(value[i:j], count))
                    i = j
                heaps.offer(docs, scores.reshape(len(part), len(items)))
        for item, heap in zip(items, heaps.heaps):
            if heap:
                best = sorted(heap, reverse=True)
                columns = [[item] * len(best), [-d for _, d in best], [s for s, _ in best]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

    return search


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _block_heaps(texts: DataFrame, pairs: list[tuple[int, str]], k: int) -> DataFrame:
    """(item_id, doc_id, score): the heaps of all tasks for one block of items."""
    spark = texts.sparkSession
    index = spark.sparkContext.broadcast(Index(pairs))
    counts = staged(texts.mapInArrow(_counter(index), "doc_id long, n long, terms array<int>, times array<long>"), "search-counts")
    documents, all_terms = counts.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = counts.select(F.explode("terms").alias("term")).groupBy("term").count()
    # One row for each term of the index at most.
    holding = dict(held.toLocalIterator())
    weights = spark.sparkContext.broadcast([term_weight(documents, holding.get(t, 0)) for t in range(len(index.value.terms))])
    return counts.filter("n > 0").mapInArrow(_searcher(index, weights, documents, all_terms, k), "item_id long, doc_id long, score long")


def ranked_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's k documents of highest score above 0 (all, if fewer), equal scores by ascending doc_id.

    A term's weight is floor(1000 * ln((2N + 2) / (2df + 1))); it is multiplied by its saturated count in the document, set against the document's length, in whole
    numbers. Each of an item's terms counts once, texts are read whole.

    A null or blank text, of a document or an item, has no terms: it is counted nowhere and found nowhere. Rows that share a doc_id are documents of their own; rows that
    share an item's id are one item, with the terms of all. Rows without id take no part. Other columns are ignored; an empty table, of documents or items,
    gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id IS NOT NULL")
    named = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).filter("item_id IS NOT NULL")
    pairs = staged(named.mapInArrow(_item_terms, "item_id long, term string").distinct(), "search-items")
    blocks = max(math.ceil(pairs.count() / block_terms), 1)
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = []
    for number in range(blocks):
        own = [(r.item_id, r.term) for r in pairs.filter(block == number).toLocalIterator()]
        if own:
            heaps = _block_heaps(texts, own, k)
            found.append(heaps if blocks == 1 else staged(heaps, "search-heaps"))
    merged = reduce(DataFrame.unionAll, found) if found else texts.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    ranked = merged.withColumn("rank", F.expr("row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)"))
    return ranked.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
