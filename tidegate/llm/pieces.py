"""SentencePiece encoding that keeps, for every piece, the bytes of the text it stands for; and decoding.

A text is normalised here: from each place the longest prefix that the model's compiled character map holds is replaced, anything else is
kept, and every byte written remembers the byte of the text it was read at.  White space is then collapsed, prefixed and escaped as the model
asks.  The library, loaded with the same pieces and a normaliser that changes nothing, merges the result; the lengths of its pieces lead
back through the remembered bytes to spans of the text.  Bytes of a character that has no piece share its place, and the last one has its span.

Cases: null texts are empty; an empty text has its begin and end ids only, if these are asked for.  Null and repeated ids and rows stay as they
are, each row is a document.  Very long texts are taken whole, one to a batch.  No rows give no rows.  Other columns are not read.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidegate.llm.common import slices

MARK = "▁"  # stands for a blank inside pieces
UNKNOWN, CONTROL, SYMBOL, BYTE = 2, 3, 4, 6  # kinds of pieces other than plain ones
ENCODED = "doc_id long, ids binary, starts array<int>, ends array<int>"


# --- the model's file ------------------------------------------------------------------------------


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """Number, value and raw bytes of each field of a protocol buffer message."""
    at = 0
    while at < len(data):
        start = at
        key, at = varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = varint(data, at)
        else:
            size, at = varint(data, at) if kind == 2 else (4 if kind == 5 else 8, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value, data[start:at]


@dataclass
class Spec:
    """What the model's normaliser does.  The numbers are those of its message's fields."""

    charsmap: bytes = b""  # 2
    prefix: bool = True  # 3
    collapse: bool = True  # 4
    escape: bool = True  # 5


@dataclass
class File:
    spec: Spec
    pieces: list[str]
    kinds: np.ndarray
    suffix: bool  # the prefix goes behind the text
    plain: bytes  # the same model with a normaliser that changes nothing
    symbols: list[str] = field(default_factory=list)


def read_model(data: bytes) -> File:
    spec, pieces, kinds, suffix, rest = Spec(), [], [], False, []
    for number, value, raw in fields(data):
        if number == 3:
            for n, v, _ in fields(value):
                if n == 2:
                    spec.charsmap = v
                elif n in (3, 4, 5):
                    setattr(spec, {3: "prefix", 4: "collapse", 5: "escape"}[n], bool(v))
            continue
        rest.append(raw)
        if number == 1:
            own = {n: v for n, v, _ in fields(value)}
            pieces.append(own.get(1, b"").decode())
            kinds.append(own.get(3, 1))
        elif number == 2:
            suffix = any(n == 24 and v for n, v, _ in fields(value))
    nothing = b"".join(bytes([n << 3, 0]) for n in (3, 4, 5))
    plain = b"".join(rest) + bytes([3 << 3 | 2, len(nothing)]) + nothing
    symbols = [p for p, k in zip(pieces, kinds) if k == SYMBOL]
    return File(spec, pieces, np.array(kinds), suffix, plain, symbols)


def character_map(blob: bytes) -> dict[str, str]:
    """The prefixes of a compiled character map and what they become.

    The map is the size of a double array, the array of 32-bit units, and the replacements, each ended by a zero byte.
    All nodes of a depth are walked at once.
    """
    if not blob:
        return {}
    size = struct.unpack_from("<I", blob)[0]
    units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64)
    texts = blob[4 + size :]
    shift = lambda u: (u >> 10) << ((u & 512) >> 6)
    labels = np.arange(1, 256)
    rules: dict[str, str] = {}
    nodes, keys = shift(units[:1]), [b""]
    while len(nodes):
        children = nodes[:, None] ^ labels
        inside = children < len(units)
        found = units[np.where(inside, children, 0)]
        parent, label = np.nonzero(inside & ((found & 0x800000FF) == labels))
        child, unit = children[parent, label], found[parent, label]
        keys = [keys[p] + bytes([c + 1]) for p, c in zip(parent.tolist(), label.tolist())]
        nodes = child ^ shift(unit)
        for k in np.flatnonzero(unit & 256).tolist():
            at = int(units[nodes[k]]) & 0x7FFFFFFF
            rules[keys[k].decode()] = texts[at : texts.index(b"\0", at)].decode()
    return rules


# --- normalisation ---------------------------------------------------------------------------------


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def byte_lengths(points: np.ndarray) -> np.ndarray:
    return 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)


class Normalizer:
    """Gives a text as the model reads it, and for each of its bytes (and the end) the byte of the text it comes from."""

    def __init__(self, spec: Spec, symbols: list[str] = (), suffix: bool = False) -> None:
        self.spec, self.suffix = spec, suffix
        # Symbols of the user go before the map and stay as they are.
        self.symbols = {s: s for s in symbols}
        self.rules = character_map(spec.charsmap)
        keys = [*self.rules, *self.symbols]
        self.longest: dict[str, int] = {}
        for k in keys:
            self.longest[k[0]] = max(self.longest.get(k[0], 0), len(k))

        def some(chars: set[str]) -> str:
            return "[" + "".join(re.escape(c) for c in sorted(chars)) + "]"

        long = [k for k in keys if len(k) > 1]
        forms = [some({k[0] for k in long}) + some({k[1] for k in long})] if long else []
        if short := {k for k in keys if len(k) == 1}:
            forms.append(some(short))
        self.candidate = re.compile("|".join(forms), re.DOTALL) if forms else None

    def longest_prefix(self, text: str, at: int) -> tuple[str, int] | None:
        """What the longest known prefix of the text from a place on becomes, and its length."""
        for known in (self.symbols, self.rules):
            for size in range(min(self.longest[text[at]], len(text) - at), 0, -1):
                if (to := known.get(text[at : at + size])) is not None:
                    return to, size
        return None

    def replaced(self, text: str) -> tuple[str, np.ndarray, np.ndarray]:
        """The text after replacements; for each character the one it was read at, and whether only blanks of its replacement precede it."""
        parts, origins, heads, done, at = [], [], [], 0, 0
        while self.candidate and (hit := self.candidate.search(text, at)):
            at = hit.start()
            found = self.longest_prefix(text, at)
            if not found:
                at += 1
                continue
            to, size = found
            parts += [text[done:at], to]
            origins += [np.arange(done, at), np.full(len(to), at)]
            blanks = len(to) - len(to.lstrip(" "))
            heads += [np.ones(at - done, bool), np.arange(len(to)) <= blanks]
            at += size
            done = at
        parts.append(text[done:])
        origins.append(np.arange(done, len(text)))
        heads.append(np.ones(len(text) - done, bool))
        return "".join(parts), np.concatenate(origins), np.concatenate(heads)

    def leading(self, text: str) -> int:
        """How many characters at the start become one blank each."""
        at = 0
        while at < len(text):
            to, size = (self.longest_prefix(text, at) if text[at] in self.longest else None) or (text[at], 1)
            if to != " ":
                break
            at += size
        return at

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        spec = self.spec
        starts = np.concatenate([[0], np.cumsum(byte_lengths(code_points(text)))])
        skipped = self.leading(text) if spec.collapse else 0
        if skipped == len(text):
            return "", starts[-1:]
        changed, origin, head = self.replaced(text)
        points = code_points(changed)
        if spec.collapse and len(points):
            blank = points == 32
            before = np.concatenate([[True], blank[:-1]])
            # Of a replacement the blanks before its first other character go if a blank comes before the replacement.
            keep = ~(blank & head & before[np.searchsorted(origin, origin)])
            points, origin = points[keep], origin[keep]
        mark = np.uint32(ord(MARK) if spec.escape else 32)
        points = np.where(points == 32, mark, points)
        source, end = starts[origin], int(starts[-1])
        if spec.prefix and not self.suffix:
            points, source = np.concatenate([[mark], points]), np.concatenate([starts[[skipped]], source])
        if spec.collapse:
            solid = np.flatnonzero(points != mark)
            stop = int(solid[-1]) + 1 if len(solid) else 0
            if stop < len(points):
                points, source, end = points[:stop], source[:stop], int(source[stop])
        if spec.prefix and self.suffix:
            points, source = np.append(points, mark), np.append(source, end)
        out = points.astype("<u4").tobytes().decode("utf-32-le")
        return out, np.append(np.repeat(source, byte_lengths(points)), end)


# --- encoding --------------------------------------------------------------------------------------


class Model:
    """A model's pieces, normaliser and merges."""

    def __init__(self, data: bytes) -> None:
        import sentencepiece

        self.file = read_model(data)
        self.normalize = Normalizer(self.file.spec, self.file.symbols, self.file.suffix)
        self.merge = sentencepiece.SentencePieceProcessor(model_proto=self.file.plain, num_threads=1)
        self.own = sentencepiece.SentencePieceProcessor(model_proto=data, num_threads=1)
        kinds = self.file.kinds
        lengths = np.array([len(p.encode()) for p in self.file.pieces], np.int64)
        self.lengths = np.where(kinds == BYTE, 1, np.where(kinds == UNKNOWN, -1, lengths))

    @cached_property
    def piece_bytes(self) -> list[bytes]:
        """What each piece says: a byte, or its text with blanks."""
        kinds = self.file.kinds.tolist()
        return [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, " ").encode() for p, k in zip(self.file.pieces, kinds)]

    def merged(self, normal: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a normalised text, and the lengths of their pieces in bytes."""
        ids = np.asarray(self.merge.encode(normal, return_type="numpy"), np.int64)
        lengths = self.lengths[ids]
        if (lengths < 0).any():  # unknown pieces are as long as what they stand for
            found = self.merge.encode(normal, return_type="proto").pieces
            lengths = np.fromiter((p.end - p.begin for p in found), np.int64, len(found))
        return ids, lengths

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in the text's bytes each piece starts and ends."""
        normal, source = self.normalize(text)
        ids, lengths = self.merged(normal)
        ends = np.cumsum(lengths)
        return ids, source[ends - lengths], source[ends]

    def decode(self, ids: np.ndarray) -> str:
        return self.own.decode(ids.tolist())


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    """The model of this worker, kept from task to task."""
    if path not in _MODELS:
        with open(path, "rb") as f:
            _MODELS[path] = Model(f.read())
    return _MODELS[path]


def encode(docs: DataFrame, path: str, begin: bool = True, end: bool = True, decoded: bool = False) -> DataFrame:
    """One row per document: its ids as little-endian 32-bit numbers, and the bytes of the text at which each piece starts and ends.

    The begin id stands before byte 0, the end id behind the last byte.  ``decoded`` adds the text of the ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        head = np.array([own.own.bos_id()] if begin else [], np.int64)
        tail = np.array([own.own.eos_id()] if end else [], np.int64)
        for part in slices(batches):
            ids, starts, ends, sizes, texts = [], [], [], [], []
            for text in pc.fill_null(part.column("text"), "").to_pylist():
                found, a, b = own.encode(text)
                all_ids = np.concatenate([head, found, tail])
                last = np.full(len(tail), len(text.encode()))
                ids.append(all_ids.astype("<u4").tobytes())
                starts += [0 * head, a, last]
                ends += [0 * head, b, last]
                sizes.append(len(all_ids))
                if decoded:
                    texts.append(own.decode(all_ids))
            bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            spans = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(x).astype(np.int32))) for x in (starts, ends)]
            columns = [part.column("doc_id"), pa.array(ids, pa.binary()), *spans]
            names = ["doc_id", "ids", "starts", "ends"]
            if decoded:
                columns.append(pa.array(texts, pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names)

    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return read.mapInArrow(run, ENCODED + (", decoded string" if decoded else ""))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The texts of ``doc_id, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            texts = [None if ids is None else own.decode(np.frombuffer(ids, "<u4")) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
