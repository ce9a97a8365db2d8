"""Phrase collocations by Rabin-Karp fingerprints.

Every n-gram has a fingerprint, the polynomial of its words' hashes modulo 2**64, read off prefix sums of the whole slice of texts; its language is
mixed in.  Occurrences with the same fingerprint are compared by their words inside a slice, so that those which collide go apart, and leave as one row
with their number, a second polynomial as a check, and a pointer to one of them (hash of the text, place).  A shuffle adds them up.  Only n-grams found
often enough come back as text: the pointers lead to the texts, where the fingerprint is verified and the phrase is read.

Sizes follow one another: an n-gram is looked at only if both its parts of one word less are frequent.  Tasks know that from a bitmap of fingerprints,
whose false answers cost time only; it has at most 2**28 bits (32 MB), whatever the input.

Cases: null texts are empty, and texts without words give nothing; a null language is ``und``.  Null and repeated ids do not matter, repeated rows count each time.
Very long texts are a slice of their own.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import Bitmap, Words, bitmap, mix, slices, stored

ENTRIES = "fp long, check int, times long, key long, pos int"
PHRASES = "lang string, size int, phrase string, times long"
BREAKS = r"[.,;:!?\n\x0b\x0c\r]"
BREAK = "."  # stands between pieces; no word holds it
SLICE = 3_000_000  # bytes of text at once
WHOLE = -1  # the place that stands for all words of a language

U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd, so that their powers have inverses


class Grams:
    """Fingerprints of all n-grams of some texts.  ``bits`` keeps only the upper bits of the first one (for tests)."""

    def __init__(self, texts: pa.Array, langs: list[str], bits: int = 64) -> None:
        lower = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
        found = Words(pc.replace_substring_regex(lower, BREAKS, f" {BREAK} "))
        self.bounds, self.codes, self.vocabulary, self.bits = found.bounds, found.codes, found.vocabulary, bits
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.bounds))
        names = {lang: U(xxhash.xxh3_64_intdigest(lang.encode())) for lang in set(langs)}
        self.langs = np.array([names[lang] for lang in langs], U)
        stop = pc.index(found.vocabulary, BREAK).as_py()
        self.word = self.codes != stop
        self.sums, self.inverses = [], []
        own = found.hashes()
        for turn, base in enumerate(BASES):
            powers = np.cumprod(np.concatenate([[U(1)], np.full(len(own), U(base))])[: len(own) + 1], dtype=U)
            self.inverses.append(np.cumprod(np.concatenate([[U(1)], np.full(len(own), U(pow(base, -1, 2**64)))]), dtype=U))
            hashes = mix(own + U(turn))
            self.sums.append(np.concatenate([[U(0)], np.cumsum(hashes * powers[: len(own)], dtype=U)]))

    def places(self, size: int) -> np.ndarray:
        """Where ``size`` words lie in one piece of a text."""
        last = max(0, len(self.codes) - size + 1)
        inside = self.owner[:last] == self.owner[size - 1 :]
        for k in range(size):
            inside &= self.word[k : last + k]
        return np.flatnonzero(inside)

    def prints(self, at: np.ndarray, size: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints and checks of the n-grams at some places."""
        lang = mix(self.langs[self.owner[at]] + np.asarray(size).astype(U))
        first, second = (mix(((s[at + size] - s[at]) * i[at]) ^ lang) for s, i in zip(self.sums, self.inverses))
        return first & ~U((1 << (64 - self.bits)) - 1), (second >> U(32)).astype(np.uint32)


def counted(grams: Grams, at: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Fingerprint, check, number and first place of each different n-gram at some places."""
    prints, checks = grams.prints(at, size)
    words = [grams.codes[at + k] for k in range(size)] + [grams.langs[grams.owner[at]]]
    order = np.argsort(prints, kind="stable")

    def starts(columns: list[np.ndarray]) -> np.ndarray:
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([c[order[1:]] != c[order[:-1]] for c in columns]) if len(order) else False
        return new

    new = starts([prints])
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    if any((w[order] != w[first]).any() for w in words):  # different n-grams collide
        order = np.lexsort((*words, prints))
        new = starts([prints, *words])
    begin = np.flatnonzero(new)
    chosen = order[begin]
    return prints[chosen], checks[chosen], np.diff(np.append(begin, len(order))), at[chosen]


def entries(docs: DataFrame, size: int, parts: Bitmap | None, bits: int) -> DataFrame:
    """The n-grams of one size whose parts of one word less are in ``parts``, added up in each slice.

    For single words, all words of each language have a row as well.
    """
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part in slices(batches, size=SLICE):
            # By key, so that the first occurrence has the least pointer.
            part = part.take(pc.sort_indices(part.column("key")))
            keys = part.column("key").to_numpy()
            grams = Grams(part.column("text"), part.column("lang").to_pylist(), bits)
            at = grams.places(size)
            if known:
                frequent = known(grams.prints(np.arange(len(grams.codes) - size + 2), size - 1)[0]) if len(at) else at
                at = at[frequent[at] & frequent[at + 1]] if len(at) else at
            *columns, place = counted(grams, at, size)
            columns += [keys[grams.owner[place]], place - grams.bounds[grams.owner[place]]]
            if size == 1:
                langs, first, code = np.unique(grams.langs, return_index=True, return_inverse=True)
                words = np.bincount(code[grams.owner[at]], minlength=len(langs))
                some = words > 0
                total = [mix(langs), langs >> U(32), words, keys[first], np.full(len(langs), WHOLE)]
                columns = [np.concatenate([c, t[some].astype(c.dtype)]) for c, t in zip(columns, total)]
            types = (np.int64, np.int32, np.int64, np.int64, np.int32)
            arrays = [pa.array(c.view(t) if c.itemsize == np.dtype(t).itemsize else c.astype(t)) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in ENTRIES.split(", ")])

    return docs.select("key", "lang", "text").mapInArrow(run, ENTRIES)


def frequent(docs: DataFrame, size: int, parts: Bitmap | None, least: int, bits: int) -> DataFrame:
    """``size, fp, check, times`` of the n-grams found ``least`` times, with a pointer ``key, pos``."""
    found = entries(docs, size, parts, bits).groupBy("fp", "check").agg(
        F.sum("times").alias("times"), F.min_by("pos", "key").alias("pos"), F.min("key").alias("key")
    )
    found = found.where((F.col("times") >= least) | (F.col("pos") == WHOLE))
    return found.select(F.when(F.col("pos") == WHOLE, 0).otherwise(size).alias("size"), "fp", "check", "times", "key", "pos")


def materialise(docs: DataFrame, found: DataFrame, bits: int) -> DataFrame:
    """The phrases that the pointers lead to.  What lies there is taken only if it has the fingerprint and the check."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            langs = part.column("lang").to_pylist()
            grams = Grams(part.column("text"), langs, bits)
            lists = part.column("pointers")
            row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            size, fp, check, times, pos = (lists.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(5))
            at = grams.bounds[row] + np.maximum(pos, 0)
            # A text of the same hash may be shorter, or hold something else there.
            whole = pos == WHOLE
            fits = whole | (at + size <= grams.bounds[row + 1])
            same = np.zeros(len(at), bool)
            some = np.flatnonzero(fits & ~whole)
            first, second = grams.prints(at[some], size[some])
            same[some] = (first.view(np.int64) == fp[some]) & (second.view(np.int32) == check[some])
            total = np.flatnonzero(whole)
            same[total] = mix(grams.langs[row[total]]).view(np.int64) == fp[total]
            chosen = np.flatnonzero(same)
            words = grams.vocabulary.take(pa.array(grams.codes)).to_pylist() if len(chosen) else []
            phrases = [" ".join(words[a : a + n]) for a, n in zip(at[chosen].tolist(), size[chosen].tolist())]
            columns = [[langs[r] for r in row[chosen].tolist()], size[chosen], phrases, times[chosen]]
            types = (pa.string(), pa.int32(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["lang", "size", "phrase", "times"])

    pointers = found.groupBy("key").agg(F.collect_list(F.struct("size", "fp", "check", "times", "pos")).alias("pointers"))
    pointers = stored(pointers, "pointers")
    texts = docs.join(pointers.select("key"), "key", "left_semi").groupBy("key", "lang", "text").count()
    return texts.join(pointers, "key").select("lang", "text", "pointers").mapInArrow(run, PHRASES)


def frequent_phrases(docs: DataFrame, width: int = 3, least: int = 10, bits: int = 64) -> DataFrame:
    """``lang, size, phrase, times`` of all phrases of up to ``width`` words found ``least`` times; of size 0, all words of a language."""
    text, lang = (F.coalesce(docs[c].cast("string"), F.lit(other)) for c, other in (("text", ""), ("lang", "und")))
    read = docs.select(lang.alias("lang"), text.alias("text")).withColumn("key", F.xxhash64("lang", "text"))
    levels: list[DataFrame] = []
    parts = None
    for size in range(1, width + 1):
        levels.append(stored(frequent(read, size, parts, least, bits), f"size-{size}"))
        if size < width:
            parts = bitmap(levels[-1].where(F.col("size") == size), "fp")
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return stored(materialise(read, found, bits), "phrases")


def scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two words or more by their lowest-scoring cut: ``lang, phrase, a, k, l, r, score``."""
    own = phrases.where("size > 1").select("lang", "phrase", "size", F.col("times").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = own.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    left, right = F.slice("words", F.lit(1), F.col("k")), F.slice("words", F.col("k") + 1, F.col("size") - F.col("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(left, " ").alias("left"), F.array_join(right, " ").alias("right"))
    parts = phrases.where("size > 0").select("lang", "phrase", "times")
    cuts = cuts.join(parts.withColumnsRenamed({"phrase": "left", "times": "l"}), ["lang", "left"])
    cuts = cuts.join(parts.withColumnsRenamed({"phrase": "right", "times": "r"}), ["lang", "right"])
    # Products may pass 64 bits; decimals of 38 digits hold them up to a = 10**16.
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    score = F.expr("cast(1000000 as decimal(7,0)) * (wide.a * wide.a) div (wide.l * wide.r)").cast("long")
    cuts = cuts.withColumn("wide", F.struct(*[c.alias(n) for n, c in wide.items()])).withColumn("score", score)
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.*")


def covered(phrases: DataFrame, percent: int) -> DataFrame:
    """``lang, phrase`` of those that lie in a longer one with ``percent`` of their occurrences or more."""
    own = phrases.where("size > 2").select("lang", "size", F.split("phrase", " ").alias("words"), "times")
    parts = own.withColumn("n", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    parts = parts.withColumn("from", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)))
    inner = F.array_join(F.slice("words", F.col("from"), F.col("n")), " ").alias("phrase")
    most = parts.select("lang", inner, "times").groupBy("lang", "phrase").agg(F.max("times").alias("longer"))
    return phrases.where("size > 1").join(most, ["lang", "phrase"]).where(100 * F.col("longer") >= percent * F.col("times")).select("lang", "phrase")


def collocations(docs: DataFrame, width: int = 3, least: int = 10, percent: int = 50, top: int = 2000, bits: int = 64) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    phrases = frequent_phrases(docs, width, least, bits)
    left = scored(phrases).join(covered(phrases, percent), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within parts of a language, so that no task sorts all of one.
    left = left.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(256)))
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    words = phrases.where("size = 0").select("lang", F.col("times").alias("n"))
    return left.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
