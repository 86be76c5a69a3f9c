"""SentencePiece encoding that keeps, for every piece, the bytes of the text that it stands for.

The normaliser is written here: at each place it takes the longest prefix that the model's compiled character map
knows (a double array over bytes) and notes, for each byte it writes, the source byte it came from. The pieces of
the normalised text are found by the library; their lengths, summed, give places in the normalised text, and the
alignment projects those to bytes of the text.

In a BPE model whose pieces never hold a space mark behind another character, no merge crosses such a place, so a text is
cut there and the library encodes each distinct segment once per worker, in a cache of bounded size. Other models get whole texts.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

MARK = "▁"
CACHED, CACHED_CHARS = 300_000, 48
#: Characters of text handled at a time; a longer text is handled alone.
CHUNK = 300_000
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class CharacterMap:
    """A compiled character map: a double array of prefixes, then their replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist() if blob else []
        self.replacements = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes taken, replacement) of the longest known prefix of data[at:]."""
        if not self.units:
            return None
        found = None
        place = _offset(self.units[0])
        for k in range(at, len(data)):
            byte = data[k]
            place ^= byte
            if place >= len(self.units):
                break
            unit = self.units[place]
            if unit & 0x800000FF != byte:
                break
            place ^= _offset(unit)
            if unit >> 8 & 1:
                begin = self.units[place] & 0x7FFFFFFF
                found = k + 1 - at, begin
        if found is None:
            return None
        taken, begin = found
        return taken, self.replacements[begin : self.replacements.index(b"\0", begin)]


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & 1 << 9) >> 6)


class PieceModel:
    """A model with its normaliser and a cache of encoded segments."""

    def __init__(self, model: bytes):
        described = proto.ModelProto()
        described.ParseFromString(model)
        self.rules = described.normalizer_spec
        self.map = CharacterMap(self.rules.precompiled_charsmap)
        kinds = [p.type for p in described.pieces]
        texts = [p.piece for p in described.pieces]
        self.symbols = sorted((t.encode() for t, k in zip(texts, kinds) if k == USER_DEFINED), key=len, reverse=True)
        # Bytes of the normalised text under a piece; unknown ones vary.
        self.size = np.array(
            [1 if k == BYTE else 0 if k in (CONTROL, UNKNOWN) else len(t.encode()) for t, k in zip(texts, kinds)], dtype=np.int64
        )
        self.lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.begin, self.end, self.unknown = self.lib.bos_id(), self.lib.eos_id(), self.lib.unk_id()
        self.plain = not (self.map.units or self.symbols or self.rules.remove_extra_whitespaces) and (
            self.rules.escape_whitespaces and self.rules.add_dummy_prefix
        )
        self.segmented = (
            self.plain
            and described.trainer_spec.model_type == proto.TrainerSpec.BPE
            and not described.trainer_spec.treat_whitespace_as_suffix
            and not any(re.search(f"[^{MARK}]{MARK}", t) for t in texts)
            and BYTE in kinds
        )
        self.segment = re.compile(" +[^ ]*")
        self.cache: dict[str, bytes] = {}

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """(normalised text, source byte of each of its bytes and of its end)."""
        data = text.encode()
        if self.plain:
            return self._marked(data)
        out, source = bytearray(), []
        mark = MARK.encode() if self.rules.escape_whitespaces else b" "
        thin = self.rules.remove_extra_whitespaces

        def put(piece: bytes, at: int) -> None:
            out.extend(piece)
            source.extend([at] * len(piece))

        at, spaced = 0, thin
        if thin:
            while at < len(data) and self._prefix(data, at)[1] == b" ":
                at += self._prefix(data, at)[0]
        if self.rules.add_dummy_prefix and at < len(data):
            put(mark, at)
        while at < len(data):
            taken, piece = self._prefix(data, at)
            if spaced:
                piece = piece.lstrip(b" ")
            if piece:
                put(piece.replace(b" ", mark), at)
                spaced = thin and piece.endswith(b" ")
            at += taken
        end = len(data)
        while thin and out.endswith(mark) and out:
            end = source[-len(mark)]
            del out[-len(mark) :], source[-len(mark) :]
        return bytes(out), np.array([*source, end], dtype=np.int64)

    def _prefix(self, data: bytes, at: int) -> tuple[int, bytes]:
        for symbol in self.symbols:
            if data.startswith(symbol, at):
                return len(symbol), symbol
        found = self.map.longest(data, at)
        if found:
            return found
        lead = data[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return size, data[at : at + size]

    def _marked(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The same without a character map: a mark in front, and one for each space."""
        if not data:
            return b"", np.zeros(1, dtype=np.int64)
        mark = MARK.encode()
        wide = np.where(np.frombuffer(data, dtype=np.uint8) == 32, len(mark), 1)
        source = np.repeat(np.arange(len(data)), wide)
        head = np.zeros(len(mark), dtype=np.int64)
        return mark + data.replace(b" ", mark), np.concatenate([head, source, [len(data)]])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text between the begin and end ids."""
        edge = np.array([self.begin], dtype="<u4").tobytes(), np.array([self.end], dtype="<u4").tobytes()
        if not self.segmented:
            found = self.lib.encode(texts, num_threads=1)
            return [np.array([self.begin, *ids, self.end], dtype="<u4") for ids in found]
        split = [self._segments(text) for text in texts]
        cache = self.cache
        found = [list(map(cache.get, segments)) for segments in split]
        missing = [(i, k) for i, ids in enumerate(found) if None in ids for k, x in enumerate(ids) if x is None]
        fresh = list({split[i][k] for i, k in missing})
        new = {s: array("I", ids).tobytes() for s, ids in zip(fresh, self.lib.encode(fresh, num_threads=1))}
        if "" in new:  # a mark alone; the library gives nothing for an empty text
            new[""] = array("I", [self.lib.piece_to_id(MARK)]).tobytes()
        for i, k in missing:
            found[i][k] = new[split[i][k]]
        joined = [b"".join(ids) for ids in found]
        for s, ids in new.items():
            if len(cache) >= CACHED:
                break
            if len(s) <= CACHED_CHARS:
                cache[s] = ids
        return [np.frombuffer(edge[0] + x + edge[1], dtype="<u4") for x in joined]

    def _segments(self, text: str) -> list[str]:
        """The text cut before each run of spaces, each segment without its first space. The library adds one."""
        if not text:
            return []
        text = text.replace(MARK, " ")  # the same after normalising
        if text[0] == " " or "  " in text:
            return [s[1:] for s in self.segment.findall(" " + text)]
        return text.split(" ")

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte of the text under each piece, and the byte after its last; controls are empty."""
        normal, source = self.normalise(text)
        sizes = self.size[ids]
        if self.unknown in ids[1:-1]:
            pieces = self.lib.encode(text, return_type="proto").pieces
            sizes[1:-1] = [1 if self.lib.is_byte(p.id) else len(p.piece.encode()) for p in pieces]
        ends = np.cumsum(sizes)
        if int(ends[-1]) != len(normal):
            raise ValueError("pieces and normalised text differ in length")
        return source[ends - sizes].astype("<u4"), source[ends].astype("<u4")

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.lib.decode([x.tolist() for x in ids], num_threads=1)


@lru_cache(maxsize=2)
def _loaded(model: bytes) -> PieceModel:
    return PieceModel(model)


def encode_pieces(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", spans: bool = True, decode: bool = True, packed: bool = False
) -> DataFrame:
    """doc_id, ids, and if wanted begins, ends (bytes of the text under each piece) and decoded (the text back from the ids).

    ids hold the begin and end ids of the model; those two have empty spans. Lists are array<int>, or
    with ``packed`` binary columns of little-endian unsigned 32-bit numbers. Text is taken whole. A null
    text is empty: only the begin and end ids. Rows, also repeated ones and those without
    doc_id, are independent; other columns are ignored; an empty table gives an empty result.
    The model file is read by the driver and sent to the tasks, so only the driver needs its path.
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    number = "binary" if packed else "array<int>"
    fields = [("doc_id", docs.schema[id_col].dataType.simpleString()), ("ids", number)]
    fields += [("begins", number), ("ends", number)] if spans else []
    fields += [("decoded", "string")] if decode else []

    def listed(arrays: list[np.ndarray]) -> pa.Array:
        if packed:
            return pa.array([x.tobytes() for x in arrays], pa.binary())
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
        flat = np.concatenate(arrays) if arrays else np.zeros(0)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(model.value)
        for batch in batches:
            for start, stop in _chunks(batch.column(1)):
                part = batch.slice(start, stop - start)
                texts = [x or "" for x in part.column(1).to_pylist()]
                ids = pieces.encode(texts)
                columns = [part.column(0), listed(ids)]
                if spans:
                    both = [pieces.spans(text, x) for text, x in zip(texts, ids)]
                    columns += [listed([b for b, _ in both]), listed([e for _, e in both])]
                if decode:
                    columns.append(pa.array(pieces.decode(ids), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])

    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in fields))


def _chunks(column: pa.Array) -> Iterator[tuple[int, int]]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(sizes):
        before = sizes[start - 1] if start else 0
        stop = max(int(np.searchsorted(sizes, before + CHUNK, side="right")), start + 1)
        yield start, stop
        start = stop


def digests(encoded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256 of packed lists, and the columns to keep."""
    return encoded.select(
        "doc_id",
        F.floor(F.length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2(F.concat("begins", "ends"), 256).alias("spans_sha256"),
        *keep,
    )
