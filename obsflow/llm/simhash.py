"""SimHash near-duplicates, found at the anchors of a covering code.

The 64 bits of a fingerprint are cut into three blocks. Fingerprints that differ in up to ``distance`` bits differ in no more than
a third of them, rounded down, in some block. A block's anchors are the words of a covering code: of the block's first 15 bits those of the perfect Hamming code,
whose balls of radius 1 hold each word exactly once, and any bits after them. So each block value has one anchor at home, no further than 1 away, and
a value that differs by ``reach`` bits has its home within 1 + 2 * reach. A fingerprint stands at its home anchor and is replicated to every anchor within covering
radius plus threshold of it that is the home of some value within the threshold: about 14 anchors a block, out of 2 ** 18.

At an anchor, those at home meet all that were replicated there. Anchors with more than CELL at home are split into cells of about CELL, and replicas go to every cell, so that
no task holds a group; replicas stream past the cell's fingerprints. Links go out as a spanning forest, not as pairs: a replica gives one link in each
of its cells, and those at home no more links than they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.components import connected_components
from obsflow.llm.staging import staged

SEED = 42
#: (first bit, number of bits)
BLOCKS = ((0, 22), (22, 21), (43, 21))
CODED = 15
#: Fingerprints at home in one cell of an anchor.
CELL = 4096
#: Pairs compared at once.
PAIRS = 1 << 20
#: Bytes of a text whose words are in memory at once.
PIECE = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _hamming_homes() -> np.ndarray:
    """The nearest code word of each word of 15 bits: the parity check names the bit to flip."""
    word = np.arange(1 << CODED, dtype=np.uint32)
    check = np.zeros_like(word)
    for k in range(CODED):
        check ^= np.where(word >> np.uint32(k) & 1, np.uint32(k + 1), np.uint32(0))
    return np.where(check > 0, word ^ (np.uint32(1) << (np.maximum(check, 1) - 1)), word).astype(np.uint32)


_HOME = _hamming_homes()


def home_anchor(values: np.ndarray) -> np.ndarray:
    values = values.astype(np.uint32)
    return _HOME[values & np.uint32((1 << CODED) - 1)] | (values >> np.uint32(CODED) << np.uint32(CODED))


def anchors_near(values: np.ndarray, bits: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the value, anchor) for the homes of all values that differ by up to ``reach`` (0 or 1) bits."""
    flips = np.concatenate([[0], 1 << np.arange(bits if reach else 0)]).astype(np.uint32)
    found = np.sort(home_anchor(values[:, None].astype(np.uint32) ^ flips), axis=1)
    new = np.ones(found.shape, dtype=bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    return np.nonzero(new)[0], found[new]


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of about PIECE bytes."""
    start = 0
    while start < len(text):
        space = _SPACE.search(text, start + PIECE) if len(text) - start > PIECE else None
        end = space.start() if space else len(text)
        yield text[start:end].lower().split()
        start = end


def shingle_hashes(text: bytes, width: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``width`` words joined by spaces, repeats included; of the whole, if it has fewer words."""
    held: list[bytes] = []
    found = False
    for words in _pieces(text):
        words = held + words
        if len(words) >= width:
            joined = b" ".join(words)
            end = np.cumsum([len(w) + 1 for w in words])
            start = (end - [len(w) + 1 for w in words])[: len(words) - width + 1].tolist()
            end = (end - 1)[width - 1 :].tolist()
            found = True
            yield np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(start, end)], dtype=np.uint64)
        held = words[len(words) - min(width - 1, len(words)) :]
    if held and not found:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], dtype=np.uint64)


def fingerprint(text: bytes | None, width: int = 4) -> int:
    """Bit j is set if it is set in over half the shingles' hashes; zero without words."""
    ones, total = np.zeros(64, dtype=np.int64), 0
    for h in shingle_hashes(text or b"", width):
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(h)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _signer(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = np.array([fingerprint(texts[i].as_py(), width) for i in range(len(texts))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "mark"])

    return sign


def _placer(reach: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(0).to_numpy().view(np.uint64)
            for number, (shift, bits) in enumerate(BLOCKS):
                value = (marks >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.uint32)
                of, anchor = anchors_near(value, bits, reach)
                keys = np.concatenate([home_anchor(value), anchor]).astype(np.int64) + (number << 32)
                copy = np.arange(len(keys)) >= len(marks)
                rows = [keys, copy, np.concatenate([marks, marks[of]]).view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=["anchor", "copy", "mark"])

    return place


class _Forest:
    """Links among the rows of a batch as a spanning forest."""

    def __init__(self, marks: np.ndarray):
        self.marks, self.root = marks, np.arange(len(marks))
        self.src: list[np.ndarray] = []
        self.dst: list[np.ndarray] = []

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        self.src.append(self.marks[a])
        self.dst.append(self.marks[b])

    def one(self, rows: slice) -> bool:
        return bool((self.root[rows] == self.root[rows.start]).all())

    def join(self, copy: np.ndarray, home: np.ndarray) -> None:
        """Linked pairs, sorted by copy: each copy goes to its first home, whose other homes join that one."""
        if not len(copy):
            return
        new = np.append(True, copy[1:] != copy[:-1])
        self.link(copy[new], home[new])
        first = home[new][np.cumsum(new) - 1]
        a, b = self.root[first], self.root[home]
        parent = {}

        def top(x):
            while x in parent:
                x = parent[x]
            return x

        for x, y in np.unique(np.stack([a, b])[:, a != b], axis=1).T.tolist():
            x, y = top(x), top(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                self.link(np.array([x]), np.array([y]))
        if parent:
            new_root = np.arange(len(self.root))
            for x in parent:
                new_root[x] = top(x)
            self.root = new_root[self.root]


def _comparer(distance: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool), np.zeros(0, np.int64)]
        for batch in batches:
            # Those at home in the cell that the last batch ended with go on.
            anchor, cell, copy, mark = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns)]
            if not len(anchor):
                continue
            new = np.append(True, (anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1]))
            start = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            homes = np.bincount(group[~copy], minlength=len(start))
            behind = np.append(start[1:], len(anchor))
            marks = mark.view(np.uint64)
            forest = _Forest(marks)
            big = homes * (behind - start - homes) > PAIRS
            for k in np.flatnonzero(big):
                at = slice(start[k], start[k] + homes[k])
                step = max(PAIRS // int(homes[k]), 1)
                for i in range(at.stop, behind[k], step):
                    rows = marks[i : min(i + step, behind[k])]
                    apart = rows[:, None] ^ marks[at]
                    near = (np.bitwise_count(apart) <= distance) & (apart != 0)
                    if forest.one(at):
                        any_near = np.flatnonzero(near.any(axis=1))
                        forest.link(i + any_near, at.start + near[any_near].argmax(axis=1))
                    else:
                        r, h = np.nonzero(near)
                        forest.join(i + r, at.start + h)
            small = np.flatnonzero(copy & ~big[group])
            counts = homes[group[small]]
            ends = np.cumsum(counts)
            i = 0
            while i < len(small):
                j = max(int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PAIRS, side="right")), i + 1)
                n = counts[i:j]
                left = np.repeat(small[i:j], n)
                right = np.repeat(start[group[small[i:j]]], n) + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
                apart = marks[left] ^ marks[right]
                near = (np.bitwise_count(apart) <= distance) & (apart != 0)
                forest.join(left[near], right[near])
                i = j
            last = slice(start[-1], start[-1] + homes[-1])
            held = [anchor[last].copy(), cell[last].copy(), copy[last].copy(), mark[last].copy()]
            if forest.src:
                a, b = np.concatenate(forest.src).view(np.int64), np.concatenate(forest.dst).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["src", "dst"])

    return compare


def fingerprint_links(marks: DataFrame, distance: int = 4) -> DataFrame:
    """(src, dst): links that join the distinct fingerprints ``mark`` as all pairs at up to ``distance`` bits would."""
    reach = distance // len(BLOCKS)
    if not 0 <= reach <= 1:
        raise ValueError(f"up to {2 * len(BLOCKS) - 1} bits, not {distance}")
    placed = marks.select("mark").mapInArrow(_placer(reach), "anchor long, copy boolean, mark long")
    crowded = placed.filter("NOT copy").groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > CELL)
    # A written table, so that Spark knows its size when it chooses the join.
    crowded = staged(crowded.select("anchor", F.ceil(F.col("n") / CELL).cast("int").alias("cells")), "crowded-anchors")
    cells = F.coalesce("cells", F.lit(1))
    own = F.array(F.pmod(F.xxhash64("mark"), cells).cast("int"))
    dealt = placed.join(crowded, "anchor", "left").select(
        "anchor", F.explode(F.when(F.col("copy"), F.sequence(F.lit(0), cells - 1)).otherwise(own)).alias("cell"), "copy", "mark"
    )
    sorted_cells = dealt.repartition("anchor", "cell").sortWithinPartitions("anchor", "cell", "copy")
    return sorted_cells.mapInArrow(_comparer(distance), "src long, dst long").distinct()


def simhash_duplicates(docs: DataFrame, width: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id, kept.

    Documents whose fingerprints differ in up to ``distance`` bits are linked; a component's id is the smallest doc_id that can be reached,
    which is the document that is kept. Texts of any length are read whole.

    A null or blank text has the fingerprint zero and is linked like any other. Rows that share a doc_id are compared each by its own text. A row
    without doc_id takes no part: it has a fingerprint, no component, and is kept. Other columns are ignored; an empty table gives an
    empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = staged(source.mapInArrow(_signer(width), "doc_id long, mark long"), "simhash-marks")
    marks = staged(signed.filter("doc_id IS NOT NULL").groupBy("mark").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    labels = connected_components(fingerprint_links(marks, distance))
    linked = marks.join(labels.withColumnRenamed("node", "mark"), "mark")
    smallest = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    named = linked.select("mark", "component").join(smallest, "component").select("mark", "component_id")
    found = marks.join(named, "mark", "left").select("mark", F.coalesce("component_id", "first").alias("component_id"))
    out = signed.join(found, "mark", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return out.select(
        "doc_id",
        F.lpad(F.lower(F.hex("mark")), 16, "0").alias("fingerprint"),
        "component_id",
        F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
