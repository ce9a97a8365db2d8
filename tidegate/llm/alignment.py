"""Alignment of two tokenizers' tokens over the bytes of the same text.

A byte-level tokenizer (A) reads a blank and the text, a SentencePiece model (B) the text, before which it puts a blank itself.  Texts are
grouped by their full text, and each distinct one is tokenised and aligned once: byte offsets at which a token of both ends cut
it into groups, and tokens whose bytes overlap are linked.  A pair's count is the number of documents that hold it linked, so each
text adds its number of copies.  Counts come back to the texts: those of frequent pairs, of which there is a proven maximum, by
broadcast, the others by a shuffle; and the measures of a text to all its documents.

Inside a task a text is taken in units, cut where neither tokenizer ever joins: before a blank, and around a line feed, between visible
characters.  Each distinct unit is tokenised and aligned once and remembered.  Tokenizers that do not promise such cuts get whole texts.

Cases: null and empty texts, and texts whose tokens' bytes are not those of a blank and the text (a U+2581 in it, which B reads as a blank)
have no tokens: all numbers are zero, the digest is empty.  Null and repeated ids and rows stay as they are; each row is a document and counts.  Names of special tokens
are plain text.  Very long texts are one unit's worth of state each.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import distinct, join_groups, slices, stored
from tidegate.llm.pieces import MARK, Model, model

ALIGNED = (
    "digest binary, times long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " pairs array<long>, links array<int>"
)
CUT = "\x01"  # put between units; texts that hold it are one unit
SLICE = 3_000_000  # bytes of text at once
SEEN = r"[!-~\p{L}]"  # visible characters: no white space in either tokenizer's eyes


# --- the tokenizers ------------------------------------------------------------------------------------


def byte_values() -> dict[str, int]:
    """The characters that a byte-level vocabulary writes for bytes: visible ones for themselves, the others from U+0100 on."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(same)]
    return {chr(b): b for b in same} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A from its file."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        first = parts.get("pre_tokenizer") or {}
        self.splits = not parts.get("normalizer") and first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space")
        value = byte_values()
        vocabulary = self.own.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * (max(self.own.get_vocab().values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(value[c] for c in token)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.own.encode_batch_fast(texts, add_special_tokens=False)]


def splits_at_blanks(own: Model) -> bool:
    """Whether B never joins a blank, or a line feed, to what precedes it, and reads texts as they are behind one blank."""
    file = own.file
    plain = file.spec.prefix and file.spec.escape and not (file.spec.charsmap or file.spec.collapse or file.suffix or file.symbols)
    return plain and not any(MARK in p.lstrip(MARK) or "\n" in p for p in file.pieces)


# --- alignment of units ----------------------------------------------------------------------------------


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def steps(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each entry, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def joined(parts: pa.Array, ends: np.ndarray, between: str) -> pa.Array:
    """Strings of consecutive parts; ``ends`` says where each stops."""
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int64()), parts), text(between))


def content(values: pa.Array) -> np.ndarray:
    """The bytes of all values, one after the other."""
    return np.frombuffer(values.buffers()[2] or b"", np.uint8)


def says(table: pa.Array, ids: np.ndarray, sizes: np.ndarray, units: list[str]) -> np.ndarray:
    """Whether the bytes of a unit's tokens are the unit's."""
    own, want = table.take(pa.array(ids)), pa.array(units, pa.large_string())
    ends = np.concatenate([[0], np.cumsum(sizes)])
    lengths = sums(pc.binary_length(own).to_numpy(), ends)
    good = lengths == pc.binary_length(want).to_numpy()
    a = content(own)[: int(lengths.sum())][np.repeat(good, lengths)]
    same = want.filter(pa.array(good))
    differ = a != content(same)[: len(a)]
    good[np.flatnonzero(good)] = sums(differ, np.concatenate([[0], np.cumsum(lengths[good])])) == 0
    return good


class Aligner:
    """Aligned units by number; at most ``LIMIT`` are remembered from one slice to the next."""

    LIMIT = 300_000
    STEP = 20_000

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteLevel(path_a), model(path_b)
        self.cuts = bool(self.a.splits) and splits_at_blanks(self.b)
        self.bytes_a, self.bytes_b = (pa.array(x, pa.large_binary()) for x in (self.a.bytes, self.b.piece_bytes))
        self.length_a, self.length_b = (pc.binary_length(x).to_numpy() for x in (self.bytes_a, self.bytes_b))
        self.names = pa.array([str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))], pa.large_string())
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.good = np.empty(0, bool)
        self.counts = np.empty((0, 4), np.int64)  # tokens of A and B, groups, links
        self.groups = pa.array([], pa.large_string())
        self.ends = np.zeros(1, np.int64)  # of each unit's pairs
        self.pairs = np.empty(0, np.int64)
        self.links = np.empty(0, np.int64)

    def tokens(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        if self.cuts:
            return self.a.encode(units), self.b.merge.encode([u.replace(" ", MARK) for u in units], num_threads=1)
        return self.a.encode(units), [self.b.encode(u[1:])[0].tolist() for u in units]

    def learn(self, units: list[str]) -> None:
        """Align new units; some at a time, as the library's own results are large."""
        for start in range(0, len(units), self.STEP):
            self.add(units[start : start + self.STEP])

    def add(self, units: list[str]) -> None:
        ids_a, ids_b = self.tokens(units)
        (a, size_a), (b, size_b) = flat(ids_a), flat(ids_b)
        del ids_a, ids_b
        good = says(self.bytes_a, a, size_a, units) & says(self.bytes_b, b, size_b, units)
        a, b = a[np.repeat(good, size_a)], b[np.repeat(good, size_b)]
        some = np.flatnonzero(good)
        size_a, size_b = size_a[some], size_b[some]
        owner = np.repeat(np.arange(len(some)), size_a)
        # Units have as many bytes by either tokenizer, so all of them can lie one after the other.
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        start_a, start_b = end_a - self.length_a[a], end_b - self.length_b[b]
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        first = np.searchsorted(end_b, start_a, side="right")
        linked = np.searchsorted(start_b, end_a, side="left") - first
        pair = (np.repeat(a, linked) << 32) | b[np.repeat(first, linked) + steps(linked)]
        whose = np.repeat(owner, linked)
        by = np.lexsort((pair, whose))
        pair, whose = pair[by], whose[by]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (whose[1:] != whose[:-1])
        at = np.flatnonzero(new)
        counts = np.zeros((len(units), 4), np.int64)
        byte_ends = end_a[np.cumsum(size_a) - 1] if len(some) else end_a
        groups_to = np.concatenate([[0], np.searchsorted(both, byte_ends, side="right")])
        counts[some] = np.stack([size_a, size_b, np.diff(groups_to), np.bincount(whose, minlength=len(some))], axis=1)
        sides = [joined(self.names.take(pa.array(ids)), np.searchsorted(ends, both, side="right"), ",") for ids, ends in ((a, end_a), (b, end_b))]
        written = joined(pc.binary_join_element_wise(*sides, text("|")), groups_to[1:], ";")
        place = np.full(len(units), -1)
        place[some] = np.arange(len(some))
        written = pc.fill_null(written.take(pa.array(place, mask=place < 0)), "")
        sizes = np.zeros(len(units), np.int64)
        sizes[some] = np.bincount(whose[at], minlength=len(some))
        self.known.update(zip(units, range(len(self.good), len(self.good) + len(units))))
        self.good = np.concatenate([self.good, good])
        self.counts = np.concatenate([self.counts, counts])
        self.groups = pa.concat_arrays([self.groups, written])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.pairs = np.concatenate([self.pairs, pair[at]])
        self.links = np.concatenate([self.links, np.diff(np.append(at, len(pair)))])

    def units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The units of texts by number, and the bounds of each text's."""
        texts = pc.binary_join_element_wise(text(" "), texts.cast(pa.large_string()), text(""))
        if self.cuts:
            held = pc.match_substring(texts, CUT)
            marked = pc.replace_substring_regex(texts, f"({SEEN}) ({SEEN})", rf"\1{CUT} \2")
            marked = pc.replace_substring_regex(marked, f"({SEEN})\n({SEEN})", rf"\1{CUT}{chr(10)}{CUT}\2")
            lists = pc.split_pattern(marked, CUT)
            if pc.any(held).as_py():
                lists = pa.array([[t] if h else own for t, h, own in zip(texts.to_pylist(), held.to_pylist(), lists.to_pylist())], lists.type)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            coded = lists.flatten().dictionary_encode()
        else:
            sizes = np.ones(len(texts), np.int64)
            coded = texts.dictionary_encode()
        vocabulary = coded.dictionary.to_pylist()
        if len(self.known) > self.LIMIT:
            self.forget()
        if new := [u for u in vocabulary if u not in self.known]:
            self.learn(new)
        number = np.fromiter(map(self.known.__getitem__, vocabulary), np.int64, len(vocabulary))
        return number[coded.indices.to_numpy(zero_copy_only=False)], np.concatenate([[0], np.cumsum(sizes)])

    def __call__(self, texts: pa.Array) -> list[pa.Array]:
        """Measures and linked pairs of each text."""
        units, bounds = self.units(texts)
        fine = sums(~self.good[units], bounds) == 0
        kept = np.repeat(fine, np.diff(bounds))
        sizes = np.where(fine, np.diff(bounds), 0)
        units, bounds = units[kept], np.concatenate([[0], np.cumsum(sizes)])
        measures = [pa.array(sums(self.counts[units, c], bounds)) for c in range(4)]
        lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), self.groups.take(pa.array(units)))
        written = pc.binary_join(lists, text(";")).cast(pa.large_binary())
        digests = [hashlib.sha256(t.as_buffer()).hexdigest() if ok else "" for t, ok in zip(written, fine.tolist())]
        # How often each text has each unit, then each pair.
        owner = np.repeat(np.arange(len(fine)), sizes)
        keys = np.sort(owner * len(self.good) + units)
        each, times = distinct(keys), np.diff(np.append(np.flatnonzero(np.diff(keys, prepend=-1)), len(keys)))
        owner, unit = each // max(1, len(self.good)), each % max(1, len(self.good))
        n = self.ends[unit + 1] - self.ends[unit]
        at = np.repeat(self.ends[unit], n) + steps(n)
        pair, links, owner = self.pairs[at], self.links[at] * np.repeat(times, n), np.repeat(owner, n)
        by = np.lexsort((pair, owner))
        pair, links, owner = pair[by], links[by], owner[by]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        links = np.add.reduceat(links, at) if len(at) else links
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner[at], minlength=len(fine)))]).astype(np.int32)
        pairs = pa.ListArray.from_arrays(pa.array(ends), pa.array(pair[at]))
        return [*measures, pa.array(digests, pa.string()), pairs, pa.ListArray.from_arrays(pa.array(ends), pa.array(links.astype(np.int32)))]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of this worker, kept from task to task."""
    key = (path_a, path_b)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(path_a, path_b)
    return _ALIGNERS[key]


# --- the operator ------------------------------------------------------------------------------------------


def align(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row for each row of ``digest, times, text``: token numbers, groups, links, and the linked pairs (A's id, B's id) packed in a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for part in slices(batches, size=SLICE):
            columns = [part.column("digest"), part.column("times"), *own(part.column("text"))]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ALIGNED.split(", ")])

    return texts.select("digest", "times", "text").mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """For each linked pair: ``documents`` that hold it, whether that is its A id's highest, and how many texts do."""
    each = aligned.select("times", F.explode("pairs").alias("pair"))
    counts = each.groupBy("pair").agg(F.sum("times").alias("documents"), F.count(F.lit(1)).alias("texts"))
    counts = stored(counts.withColumn("a", F.shiftright("pair", 32)), "pairs")
    best = counts.groupBy("a").agg(F.max("documents").alias("most"))
    return counts.join(best, "a").select("pair", "documents", "texts", (F.col("documents") == F.col("most")).alias("best"))


def measure(docs: DataFrame, path_a: str, path_b: str, local: int = 200_000) -> DataFrame:
    """One row per document with all measures.  At most ``local`` pair counts are broadcast."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    texts = read.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("times")).select(digest, "times", "text")
    aligned = stored(align(texts, path_a, path_b), "aligned")
    counts = stored(pair_counts(aligned), "counts")
    links = aligned.select("digest", F.inline(F.arrays_zip("pairs", "links"))).withColumnRenamed("pairs", "pair")
    met = join_groups(links, counts, ["pair"], "texts", "inner", most=local)
    found = met.groupBy("digest").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("links") * F.col("documents")).alias("count_sum"),
    )
    named = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    measures = stored(aligned.drop("pairs", "links").join(found, "digest", "left").na.fill(0, named), "measures")
    full = join_groups(read.where("text <> ''").select("doc_id", digest), measures, ["digest"], "times", "inner")
    blank = read.where("text = ''").select("doc_id", *[F.lit(0).cast("long").alias(c) for c in named], F.lit("").alias("groups_sha256"))
    return full.select(*blank.columns).unionByName(blank)
