"""SentencePiece encoding with byte offsets, and decoding.

A text is normalised by longest-prefix matches in the model's compiled
character map; every normalised byte records the source byte it comes from.
The pieces tile the normalised bytes, so cumulated piece lengths look up the
original byte span of each piece. Merges never cross the place where a space
mark follows another character (checked against the vocabulary when the model
is loaded), so the distinct words of the texts are encoded once per worker.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from hearth.llm.common import arrow, map_texts

SPACE_MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values of the model format
BPE = 2
#: Bytes of words and ids that a worker's cache may hold.
CACHE_BYTES = 48 << 20


class CharacterMap:
    """Longest-prefix lookups in a compiled character map (a double-array trie and its replacement strings)."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = memoryview(blob[4:4 + size]).cast("I").tolist() if size else []
        self.strings = blob[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(source bytes, replacement) of the longest entry that ``text`` has at ``at``."""
        units, found, node = self.units, None, 0
        if not units:
            return None
        unit = units[0]
        node = self._child_base(node, unit)
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node = self._child_base(node, unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if not found:
            return None
        start = found[1]
        return found[0], self.strings[start:self.strings.index(b"\0", start)]

    @staticmethod
    def _child_base(node: int, unit: int) -> int:
        return node ^ (unit >> 10 << ((unit & 1 << 9) >> 6))


@dataclass(frozen=True)
class Rules:
    """The model's normalisation settings."""

    dummy_prefix: bool = True
    collapse_spaces: bool = False


def normalise(text: str, cmap: CharacterMap, rules: Rules) -> tuple[bytes, np.ndarray]:
    """Normalised bytes with spaces still as spaces, and for each byte, and the end, its source byte."""
    raw = text.encode("utf-8")
    if not cmap.units and not rules.collapse_spaces:  # every character stands for itself
        out = raw.replace(SPACE_MARK.encode(), b" ") if SPACE_MARK in text else raw
        if out is raw:
            source = np.arange(len(raw) + 1, dtype=np.int64)
        else:
            plain = np.frombuffer(raw, dtype=np.uint8)
            mark = (plain[:-2] == 0xE2) & (plain[1:-1] == 0x96) & (plain[2:] == 0x81)
            keep = np.ones(len(raw), dtype=bool)
            keep[np.flatnonzero(mark)[:, None] + np.array([1, 2])] = False
            source = np.append(np.flatnonzero(keep), len(raw))
    else:
        pieces: list[bytes] = []
        places: list[int] = []
        at, after_space = 0, rules.collapse_spaces
        while at < len(raw):
            width = 1 if raw[at] < 0x80 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
            used, piece = cmap.longest(raw, at) or (width, raw[at:at + width])
            piece = piece.replace(SPACE_MARK.encode(), b" ")
            if rules.collapse_spaces:
                if after_space:
                    piece = piece.lstrip(b" ")
                after_space = piece.endswith(b" ") if piece else after_space
            pieces.append(piece)
            places += [at] * len(piece)
            at += used
        out = b"".join(pieces)
        if rules.collapse_spaces:
            short = out.rstrip(b" ")
            end = places[len(short)] if len(short) < len(out) else len(raw)
            out, places = short, places[:len(short)]
        else:
            end = len(raw)
        source = np.array([*places, end], dtype=np.int64)
    if rules.dummy_prefix and out:
        return b" " + out, np.concatenate((source[:1], source))
    return out, source


class Encoder:
    """Encodes and decodes with one model, remembering the ids of words."""

    words = re.compile(r" +[^ ]*|[^ ]+")

    def __init__(self, path: str):
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        model = model_pb2.ModelProto()
        model.ParseFromString(self.lib.serialized_model_proto())
        spec = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != BPE or not spec.escape_whitespaces or kinds & {USER_DEFINED, UNUSED} \
                or model.trainer_spec.treat_whitespace_as_suffix or not spec.add_dummy_prefix:
            raise ValueError("a BPE model with plain pieces and a leading space mark is needed")
        if any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p.piece) for p in model.pieces if p.type == NORMAL):
            raise ValueError("a piece holds a space mark after another character: words can't be encoded alone")
        self.cmap = CharacterMap(spec.precompiled_charsmap)
        self.rules = Rules(spec.add_dummy_prefix, spec.remove_extra_whitespaces)
        self.lengths = np.array([1 if p.type == BYTE else 0 if p.type == CONTROL else len(p.piece.encode()) for p in model.pieces], dtype=np.int64)
        self.mark = self.lib.piece_to_id(SPACE_MARK)
        self.ends = struct.pack("<I", self.lib.bos_id()), struct.pack("<I", self.lib.eos_id())
        self.cache: dict[str, bytes] = {}
        self.held = 0

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids with begin and end, span starts, span ends); spans are original bytes."""
        norm, source = normalise(text, self.cmap, self.rules)
        words = self.words.findall(norm.decode("utf-8"))
        if self.held > CACHE_BYTES:
            self.cache, self.held = {}, 0
        cache = self.cache
        new = [w for w in set(words) if w not in cache]
        if new:
            # the library puts the word's own leading mark back; a lone mark would be an empty text to it
            for word, ids in zip(new, self.lib.encode([w[1:] for w in new], num_threads=1), strict=True):
                cache[word] = np.array(ids if len(word) > 1 else [self.mark], dtype="<u4").tobytes()
                self.held += 2 * len(word) + len(cache[word]) + 200
        ids = np.frombuffer(b"".join([self.ends[0], *map(cache.__getitem__, words), self.ends[1]]), dtype="<u4")
        # in the pieces a space is a mark of three bytes
        wide = np.frombuffer(norm, dtype=np.uint8) == 0x20
        at = np.concatenate(([0], np.cumsum(self.lengths[ids])))
        places = np.concatenate((np.repeat(source[:-1], np.where(wide, 3, 1)), source[-1:]))
        if at[-1] != len(places) - 1:
            raise ValueError("the pieces don't tile the normalised text")
        bounds = places[at]
        return ids, bounds[:-1], bounds[1:]

    def decode(self, ids: np.ndarray) -> str:
        return self.lib.decode(ids.tolist())


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, spans, decoded) for every row; ``model`` is a path that every executor has.

    ``ids`` holds little-endian unsigned 32-bit ids with begin and end, ``spans``
    a start and an end (original bytes, end exclusive, same integers) for each of
    them, and ``decoded`` the library's text for the ids. Null and empty texts
    have the begin and end ids alone, with empty spans. Rows stay one to one,
    whatever their ids; other columns are ignored.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(model)
        ids, spans, decoded = [], [], []
        for text in batch.column(1).to_pylist():
            got, start, end = enc.encode(text or "")
            ids.append(got.tobytes())
            spans.append(np.stack((start, end), axis=1).astype("<u4").tobytes())
            decoded.append(enc.decode(got))
        return arrow(id=batch.column(0), ids=pa.array(ids, pa.binary()), spans=pa.array(spans, pa.binary()),
                     decoded=pa.array(decoded, pa.string()))

    return map_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), kernel,
                     f"id {id_type}, ids binary, spans binary, decoded string")
