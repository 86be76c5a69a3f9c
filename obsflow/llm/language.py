"""Language of a text by unigram pieces, summed over all segmentations.

Every language has a probability for each piece of a fixed public vocabulary. A word, lower-cased and with a word mark in
front, scores the sum over all ways to write it as pieces of the product of their probabilities, by a
forward pass. A text scores the product over its words, and languages start out equal. The probabilities are expected counts
of the training words (forward and backward), from equal ones on, repeated ROUNDS times.

Words are runs of letters of any length, scored whole: the forward pass keeps the last states and a running scale, so memory doesn't grow with the run. In training alone a run of more
than BLOCK letters is counted in parts of that many, of which only the first has the word mark; pieces over their borders are not counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.llm.staging import staged
from obsflow.llm.words import mix

MARK = "▁"
BLOCK = 32
ROUNDS = 2
#: Training documents for each language, at most about so many, chosen by a hash of the doc_id.
FIT_ROWS = 3000
#: Least share of a piece, and of a letter that is no piece.
SMOOTH = 0.05
UNKNOWN_SHARE = 1e-7
CHUNK = 400_000
#: Letters of long words that are looked up together, and steps after which their states are scaled.
LONG_LETTERS = 50_000
RESCALE = 8
KNOWN_WORDS = 200_000
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_TIMES = np.uint64(0x9E3779B97F4A7C15)


def words_in(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    return [w for w in _LETTERS.findall((text or "").lower()) if w.isalpha() or any(map(str.isalpha, w))]


class Vocabulary:
    """The pieces that can be part of a word, found by the hash of their letters."""

    def __init__(self, pieces: list[str]):
        pieces = sorted(set(pieces))
        keys = np.zeros(len(pieces), dtype=np.uint64)
        for size in {len(p) for p in pieces}:
            at = [i for i, p in enumerate(pieces) if len(p) == size]
            keys[at] = _hash(np.array([[ord(c) for c in pieces[i]] for i in at], dtype=np.uint64))
        order = np.argsort(keys)
        self.pieces = [pieces[i] for i in order]
        self.keys = keys[order]
        self.longest = max(map(len, pieces), default=1)
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[self.keys & np.uint64((1 << 20) - 1)] = True

    @classmethod
    def of_model(cls, path: str) -> Vocabulary:
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [lib.id_to_piece(i) for i in range(len(lib)) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        return cls([p for p in usable if re.fullmatch(f"{MARK}?[^\\W\\d_]*", p) and p == p.lower() and p])

    @property
    def unknown(self) -> int:
        return len(self.pieces)

    def edges(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For marked words of one length: (from, to, rows, pieces) of all pieces at these places, by rising ``to``."""
        size = len(words[0])
        letters = np.array(words, dtype=f"<U{size}").view(np.uint32).reshape(len(words), size).astype(np.uint64)
        rolled = [np.zeros(len(words), dtype=np.uint64)] * size
        for to in range(1, size + 1):
            new = letters[:, to - 1]
            for start in range(max(0, to - self.longest), to):
                rolled[start] = _roll(rolled[start], new)
                key = mix(rolled[start])
                rows = np.flatnonzero(self.seen[key & np.uint64((1 << 20) - 1)])
                place = np.minimum(np.searchsorted(self.keys, key[rows]), len(self.keys) - 1)
                hit = self.keys[place] == key[rows] if len(self.keys) else np.zeros(len(rows), dtype=bool)
                rows, pieces = rows[hit], place[hit]
                if to - start == 1:
                    other = np.setdiff1d(np.arange(len(words)), rows, assume_unique=True)
                    rows = np.concatenate([rows, other])
                    pieces = np.concatenate([pieces, np.full(len(other), self.unknown)])
                if len(rows):
                    yield start, to, rows, pieces


    def edges_at(self, letters: np.ndarray, start: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index in ``start``, length, piece) of all pieces that begin at the places ``start`` of ``letters`` and are no longer than ``room``."""
        found = []
        state = np.zeros(len(start), dtype=np.uint64)
        for size in range(1, self.longest + 1):
            at = np.flatnonzero(room >= size)
            state[at] = _roll(state[at], letters[start[at] + size - 1])
            key = mix(state[at])
            place = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
            hit = self.keys[place] == key if len(self.keys) else np.zeros(len(at), dtype=bool)
            if size == 1:
                place, hit = np.where(hit, place, self.unknown), np.ones(len(at), dtype=bool)
            found.append((at[hit], np.full(int(hit.sum()), size), place[hit]))
        return tuple(np.concatenate(column) for column in zip(*found))


def _roll(state: np.ndarray, letter: np.ndarray) -> np.ndarray:
    return (state + letter + np.uint64(1)) * _TIMES


def _hash(letters: np.ndarray) -> np.ndarray:
    state = np.zeros(len(letters), dtype=np.uint64)
    for k in range(letters.shape[1]):
        state = _roll(state, letters[:, k])
    return mix(state)


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        for k in range(0, len(at), 20_000):
            yield at[k : k + 20_000]


def log_likelihood(words: list[str], vocabulary: Vocabulary, shares: np.ndarray) -> np.ndarray:
    """Log probability of each word under each column of ``shares``, over all segmentations."""
    out = np.zeros((len(words), shares.shape[1]))
    short = [i for i, w in enumerate(words) if len(w) <= BLOCK]
    for at in _by_length([words[i] for i in short]):
        group = [MARK + words[short[i]] for i in at]
        size = len(group[0])
        forward = np.zeros((size + 1, len(group), shares.shape[1]))
        forward[0] = 1
        for start, to, rows, pieces in vocabulary.edges(group):
            forward[to, rows] += forward[start, rows] * shares[pieces]
        out[[short[i] for i in at]] = np.log(forward[size])
    long = sorted((i for i, w in enumerate(words) if len(w) > BLOCK), key=lambda i: len(words[i]))
    k = 0
    while k < len(long):
        end, letters = k, 0
        while end < len(long) and (end == k or letters + len(words[long[end]]) <= LONG_LETTERS):
            letters += len(words[long[end]]) + 1
            end += 1
        out[long[k:end]] = _long_likelihood([MARK + words[i] for i in long[k:end]], vocabulary, shares)
        k = end
    return out


def _long_likelihood(words: list[str], vocabulary: Vocabulary, shares: np.ndarray) -> np.ndarray:
    """The same for marked words of any lengths, side by side: the states of the last places only, scaled as they shrink."""
    size = np.array([len(w) for w in words])
    first = np.cumsum(size) - size
    letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    ring = vocabulary.longest + 1
    states = np.zeros((len(words), ring, shares.shape[1]))
    states[:, 0] = 1
    scale = np.zeros((len(words), shares.shape[1]))
    out = np.zeros_like(scale)
    step = max(LONG_LETTERS // len(words), ring)
    for begin in range(0, int(size.max()), step):
        stop = min(begin + step, int(size.max()))
        low = max(begin - ring, 0)
        # Every place of every word from which a piece can end in this stretch.
        span = np.minimum(size, stop) - np.minimum(size, low)
        word = np.repeat(np.arange(len(words)), span)
        place = low + np.arange(len(word)) - np.repeat(np.cumsum(span) - span, span)
        at, length, piece = vocabulary.edges_at(letters, first[word] + place, size[word] - place)
        to = place[at] + length
        now = np.flatnonzero((to > begin) & (to <= stop))
        now = now[np.argsort(to[now], kind="stable")]
        bounds = np.searchsorted(to[now], np.arange(begin + 1, stop + 2))
        of = word[at[now]]
        for t in range(begin + 1, stop + 1):
            e = slice(bounds[t - begin - 1], bounds[t - begin])
            rows = of[e]
            states[:, t % ring] = 0
            np.add.at(states, (rows, t % ring), states[rows, (t - length[now[e]]) % ring] * shares[piece[now[e]]])
            done = size == t
            if done.any():
                out[done] = np.log(states[done, t % ring]) + scale[done]
            if t % RESCALE == 0:
                most = states.max(axis=1)
                most[most == 0] = 1
                states /= most[:, None]
                scale += np.log(most)
    return out


def expected_counts(words: list[str], counts: np.ndarray, vocabulary: Vocabulary, share: np.ndarray) -> np.ndarray:
    """How often each piece is used in the words, each segmentation weighed by its probability."""
    total = np.zeros(vocabulary.unknown + 1)
    marked = [MARK + w for w in words]
    parts = [(w[k : k + BLOCK + 1], n) for w, n in zip(marked, counts) for k in range(0, len(w), BLOCK + 1)]
    counts = np.array([n for _, n in parts], dtype=np.float64)
    for at in _by_length([w for w, _ in parts]):
        group = [parts[i][0] for i in at]
        size = len(group[0])
        edges = list(vocabulary.edges(group))
        forward, backward = np.zeros((size + 1, len(group))), np.zeros((size + 1, len(group)))
        forward[0] = backward[size] = 1
        for start, to, rows, pieces in edges:
            forward[to, rows] += forward[start, rows] * share[pieces]
        weight = counts[at] / forward[size]
        for start, to, rows, pieces in sorted(edges, key=lambda e: -e[0]):
            flow = backward[to, rows] * share[pieces]
            backward[start, rows] += flow
            np.add.at(total, pieces, forward[start, rows] * flow * weight[rows])
    return total


class LanguageModel:
    def __init__(self, languages: list[str], vocabulary: Vocabulary, shares: np.ndarray):
        self.languages, self.vocabulary, self.shares = languages, vocabulary, shares
        self.place: dict[str, int] = {}
        self.known = np.zeros((0, len(languages)))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and its posterior share; the smallest name on a tie, UNDETERMINED with 0 without letters."""
        found = [words_in(t) for t in texts]
        sizes = np.array([len(w) for w in found], dtype=np.int64)
        flat = [w for words in found for w in words]
        if not self.languages or not flat:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        new = sorted({w for w in flat if w not in self.place}, key=len)
        place, scores = self.place, self.known
        if new:
            scores = np.concatenate([self.known, log_likelihood(new, self.vocabulary, self.shares)])
            number = {w: len(self.known) + i for i, w in enumerate(new)}
            # Words that come again are kept, long ones hardly do.
            kept = sum(len(w) <= BLOCK for w in new) if len(self.place) < KNOWN_WORDS else 0
            if kept:
                self.place = self.place | {w: number[w] for w in new[:kept]}
                self.known = scores[: len(self.known) + kept]
            place = self.place if kept == len(new) else _Later(self.place, number)
        at = np.fromiter(map(place.__getitem__, flat), dtype=np.int64, count=len(flat))
        begins = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        some = sizes > 0
        total = np.zeros((len(texts), len(self.languages)))
        total[some] = np.add.reduceat(scores[at], begins[some], axis=0)
        best = np.argmax(total, axis=1)
        with np.errstate(under="ignore"):
            share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        names = [self.languages[k] if s else UNDETERMINED for k, s in zip(best, some)]
        return names, np.where(some, share, 0.0)


class _Later(dict):
    """Lookups in one dictionary, then in another."""

    def __init__(self, first: dict, second: dict):
        super().__init__(second)
        self.first = first

    def __getitem__(self, key: str) -> int:
        found = self.first.get(key)
        return super().__getitem__(key) if found is None else found


def fit(docs: DataFrame, model_path: str, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learns from ``docs``: text and label, at most about ``fit_rows`` rows of each language.

    Counts are added up by language and piece in the tasks; the driver gets those sums, of which there are no
    more than pieces times languages. Rows without language or text are left out.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary.of_model(model_path)
    named = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r["lang"]: r["n"] for r in named.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], vocabulary, np.zeros((vocabulary.unknown + 1, 0)))
    rates = spark.createDataFrame([(k, min(1.0, fit_rows / n)) for k, n in sizes.items()], "_lang string, _rate double")
    drawn = F.pmod(F.xxhash64(F.col(id_col), F.lit("fit")), F.lit(1_000_000)) < F.col("_rate") * 1_000_000
    sample = staged(
        named.join(F.broadcast(rates), named[lang_col] == rates["_lang"]).filter(drawn).select("_lang", F.col(text_col).alias("text")),
        "language-sample",
    )
    sample = sample.repartition("_lang", F.pmod(F.xxhash64("text"), F.lit(16)))
    equal = np.full((vocabulary.unknown + 1, len(languages)), 1.0 / (vocabulary.unknown + 1))
    shares = equal
    for _ in range(ROUNDS):
        current = spark.sparkContext.broadcast((vocabulary, languages, shares))

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            vocabulary, languages, shares = current.value
            totals = np.zeros((vocabulary.unknown + 1, len(languages)))
            for batch in batches:
                for lang, texts in batch.groupby("_lang")["text"]:
                    words, counts = np.unique([w for t in texts for w in words_in(t)], return_counts=True)
                    k = languages.index(lang)
                    totals[:, k] += expected_counts(words.tolist(), counts, vocabulary, shares[:, k])
            piece, lang = np.nonzero(totals)
            yield pd.DataFrame({"piece": piece, "lang": lang, "uses": totals[piece, lang]})

        summed = sample.mapInPandas(count, "piece long, lang long, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toPandas()
        totals = np.zeros_like(equal)
        totals[summed["piece"], summed["lang"]] = summed["uses"]
        common = totals.sum(axis=1, keepdims=True) + 1.0
        totals += SMOOTH * common / common.sum() * totals.sum(axis=0, keepdims=True) + 1e-3
        shares = totals / totals.sum(axis=0, keepdims=True)
        # Sums come in any order: keep the digits that don't depend on it.
        shares = np.maximum(np.round(shares, 12), 1e-9)
        shares[vocabulary.unknown] = UNKNOWN_SHARE
    return LanguageModel(languages, vocabulary, shares)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row: the most probable language and its posterior share.

    A text that is null or has no letter gets ``und`` and 0, as does every text if no language was learned. Equal
    scores go to the language whose name is smaller. Texts of any length are read whole, runs of letters of any length scored whole. Other columns are ignored; repeated rows are
    predicted alike; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.vocabulary, model.shares))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel(*sent.value)
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            start = 0
            while start < len(batch):
                before = sizes[start - 1] if start else 0
                stop = max(int(np.searchsorted(sizes, before + CHUNK, side="right")), start + 1)
                part = batch.slice(start, stop - start)
                names, scores = model.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"]
                )
                start = stop

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def is_held_out(doc_id: Column) -> Column:
    """The fold that is never learned from: CRC-32 of the id as text is 2 modulo 4. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, learned from the rows of ``docs`` that are not held out."""
    model = fit(docs.filter(~is_held_out(F.col("doc_id"))), model_path)
    return predict(docs, model).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model_path: str, least: float = 0.5) -> DataFrame:
    """The documents whose language is told with a share of at least ``least``; all columns as they came.

    Text without letters has no language and goes. A doc_id goes if all its rows go.
    """
    model = fit(docs.filter(~is_held_out(F.col("doc_id"))), model_path)
    verdicts = predict(docs, model).select(F.col("doc_id").alias("_id"), ((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).alias("_ok"))
    rejected = staged(verdicts.groupBy("_id").agg(F.max("_ok").alias("_ok")).filter(~F.col("_ok")).select("_id"), "no-language")
    return docs.join(rejected, docs["doc_id"].eqNullSafe(rejected["_id"]), "left_anti")
