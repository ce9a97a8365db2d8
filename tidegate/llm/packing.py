"""Packing of documents into sequences by the online sum-of-squares rule.

Each partition of the documents packs its own sequences.  A document's ids fill whole sequences first; the
rest of under one sequence goes into the open sequence whose fill level, once raised, makes the sum over
all levels of the squared number of open sequences smallest.  Only the level array is searched, so a
placement costs the same however many sequences are open.  What is still open at the end of the partition
is cut anew into full sequences, and the last rest into lengths that are powers of two, which take no padding.

Cases: null texts are empty; an empty text is its end id alone.  Null and repeated ids stay as they
are; each row is a document.  Very long texts give many full sequences.  No rows give no rows.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidegate.llm.common import Words, slices

END_ID = 1
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

Encode = Callable[[list[str]], list[list[int]]]


def tokenizer(path: str) -> Encode:
    """The encoding of texts by a tokenizers file, without special tokens around them."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]


MARKS = ".,;:!?"
MARKED = r"([A-Za-z])([.,;:!?]+)([\x20\x09-\x0D]|$)"


def splits_marks(encode: Encode) -> bool:
    """Whether the tokenizer takes a word without regard to ASCII case and apart from the marks behind it."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    pairs = [(word, mark) for word in (*letters, *letters.upper(), "Word", "WORDS") for mark in (*MARKS, "...", "?!")]
    joined, parted = encode([w + m for w, m in pairs]), encode([f"{w.lower()} {m}" for w, m in pairs])
    return joined == parted


class Encoder:
    """Encodes texts word by word, each distinct word once.

    This equals encoding whole texts where the tokenizer never joins across white space, as word tokenizers
    do.  If it also folds case and parts words from marks, fewer words are distinct.  At most ``LIMIT`` words are remembered.
    """

    LIMIT = 1_500_000

    def __init__(self, encode: Encode) -> None:
        self.encode = encode
        self.parts = splits_marks(encode)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.empty(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def learn(self, new: list[str]) -> None:
        """Append the ids of new words to the flat store."""
        ids = self.encode(new)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        self.flat = np.concatenate([self.flat, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        lower = False
        # The names of special tokens are told by their case.
        if self.parts and not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts, lower = pc.replace_substring_regex(texts, MARKED, r"\1 \2\3"), True
        found = Words(texts, lower)
        vocabulary = found.vocabulary.to_pylist()
        if len(self.known) > self.LIMIT:
            self.forget()
        known = self.known
        if new := [w for w in vocabulary if w not in known]:
            self.learn(new)
        own = np.fromiter(map(known.__getitem__, vocabulary), np.int64, len(vocabulary))[found.codes]
        starts, lengths = self.ends[own], self.ends[own + 1] - self.ends[own]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]
        cut = np.concatenate([[0], ends])[found.bounds]
        return [np.append(ids[a:b], np.uint32(END_ID)) for a, b in zip(cut[:-1], cut[1:])]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(tokenizer(path))
    return _ENCODERS[path]


class Packer:
    """Sequences of one partition.  A piece is (document, start, ids); ``closed`` gets (pieces of a sequence)."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.levels = np.zeros(size + 1, np.int64)  # open sequences by fill level; empty and full ones count nothing
        self.open: list[list[list]] = [[] for _ in range(size + 1)]

    def level_for(self, need: int) -> int:
        """The level to raise by ``need``: 0 opens a sequence."""
        levels = self.levels
        # Raising from h to h+need changes the sum of squares by 2 (N[h+need] - N[h]) + 2; opening by 2 N[need] + 1,
        # and filling a sequence up by 1 - 2 N[h].
        fits = np.flatnonzero(levels[: self.size - need + 1])
        fits = fits[fits > 0]
        if not len(fits):
            return 0
        cost = 2 * (levels[fits + need] - levels[fits]) + 2
        cost[fits + need == self.size] -= 1
        best = int(np.argmin(cost[::-1]))
        best = len(fits) - 1 - best  # of equal costs the fullest
        new = 0 if need == self.size else 2 * int(levels[need]) + 1
        return int(fits[best]) if cost[best] <= new else 0

    def add(self, doc: int, ids: np.ndarray) -> Iterator[list]:
        """Place one document; gives the sequences that are full."""
        whole = len(ids) // self.size * self.size
        for start in range(0, whole, self.size):
            yield [(doc, start, ids[start : start + self.size])]
        need = len(ids) - whole
        if not need:
            return
        level = self.level_for(need)
        pieces = self.open[level].pop() if level else []
        if level:
            self.levels[level] -= 1
        pieces.append((doc, whole, ids[whole:]))
        if level + need == self.size:
            yield pieces
        else:
            self.levels[level + need] += 1
            self.open[level + need].append(pieces)

    def rest(self) -> Iterator[list]:
        """What is open, cut anew: full sequences, then powers of two.  Those are left whole that need no padding."""
        pieces = []
        for level in range(self.size, 0, -1):
            for sequence in self.open[level]:
                if level & (level - 1) == 0:
                    yield sequence
                else:
                    pieces.extend(sequence)
        left = sum(len(p[2]) for p in pieces)
        room = 0
        current: list = []
        for doc, start, ids in pieces:
            while len(ids):
                if not room:
                    room = self.size if left >= self.size else 1 << (left.bit_length() - 1)
                part = ids[:room]
                current.append((doc, start, part))
                room -= len(part)
                left -= len(part)
                start += len(part)
                ids = ids[len(part) :]
                if not room:
                    yield current
                    current = []


def pack(docs: DataFrame, path: str, size: int = 2048) -> DataFrame:
    """The pieces of all documents: one row each, with its place in its sequence.

    Sequence ids hold the partition in their upper bits, so that a task that runs again gives the same ones.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("the sequence size must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        packer = Packer(size)
        ids_of: list = []
        totals: list[int] = []
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def told(pieces: list) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids in pieces:
                rows.append((ids_of[doc], start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), totals[doc], sequence, offset))
                offset += len(ids)
            sequence += 1

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 7
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
            rows.clear()
            return batch

        for part in slices(batches):
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text"))):
                ids_of.append(doc_id)
                totals.append(len(ids))
                for full in packer.add(len(ids_of) - 1, ids):
                    told(full)
            yield out()
        for pieces in packer.rest():
            told(pieces)
        yield out()

    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return read.mapInArrow(run, SCHEMA)
