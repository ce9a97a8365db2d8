"""N-gram Jaccard join by vertical partitioning.

The global order of n-grams is that of their 64-bit hashes.  It is cut into fragments, and every document's sorted
set with it.  Three uses of the fragments follow one another:

* candidates: sets of a size class are cut into one fragment more than two linked sets can differ in n-grams, so linked
  sets have a whole fragment in common; only a hash per fragment is shuffled;
* a bound: four bits per fragment of a finer cut tell apart most fragments that differ; two sets cannot link if more of these
  differ than linked sets may have n-grams that do;
* counts: for what is left, the overlap is counted for each fragment by itself and summed per pair.

Verdicts come from the counts alone; equal fragments only say which pairs are worth counting, an addition to the plain method.

Documents with the same set are one class and enter once.  Groups that meet in a fragment are split into blocks
of ``BLOCK`` classes.  Inside a group each class ranks its partners by the bound.  Rounds go through the ranks, 1, 2 to 4, 5 to 16 and so on, and
try only pairs that the links so far leave in different components; groups without such pairs of higher ranks leave after each.  So every link is either found or joins what is
joined already, and the pairs of a group of near copies, which its first ranks connect, never leave their task.

Cases: null, empty and blank texts have an empty set and are alone in their component.  A text of fewer words than the width has
one n-gram, its whole sequence.  A component is called by its smallest id; null ids count as larger than
all others.  Rows that repeat an id and a text are one class; rows that repeat an id with another text are documents of
their own.  Very long texts have more fragments, by their size class.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import SPACE_CHARS, Words, bitmap, join_groups, mix, release, slices, stored

BLOCK = 1000  # classes of a group that one task compares
COUNTED = 8  # fragments by which overlaps are counted

U = np.uint64


# --- sets of n-grams in a slice of texts ---------------------------------------------------------


def chain(hashes: np.ndarray, width: int, n: int) -> np.ndarray:
    """Hashes of the first ``n`` windows of ``width`` words."""
    out = np.full(n, width, U)
    for j in range(width):
        out = mix(out * U(0x9E3779B97F4A7C15) + hashes[j : j + n])
    return out


def sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct n-gram hashes of all texts, one after the other, and the bounds of each text."""
    found = Words(texts, lower=True)
    own, bounds = found.hashes(), found.bounds
    windows = chain(own, width, max(0, len(own) - width + 1))
    parts, sizes = [], []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= width:
            part = windows[a : b - width + 1]
            part.sort()
        else:
            part = chain(own[a:b], b - a, 1) if b > a else own[:0]
        parts.append(part)
        sizes.append(len(part))
    flat = np.concatenate([*parts, np.empty(0, U)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
    counts = np.bincount(owner[new], minlength=len(sizes)) if len(flat) else np.zeros(len(sizes), np.int64)
    return flat[new], np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def take(flat: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets of some rows only."""
    sizes = bounds[rows + 1] - bounds[rows]
    ends = np.cumsum(sizes)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(bounds[rows] - (ends - sizes), sizes)
    return flat[at], np.concatenate([[0], ends]).astype(np.int64)


def runs(owner: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Where a new (row, fragment) starts."""
    if not len(part):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])]))


# The smallest sizes of the size classes: two for each doubling.
LOWS = np.unique(np.ceil(2.0 ** (np.arange(120) / 2)).astype(np.int64))


@lru_cache(maxsize=None)
def fragments(scheme: int, percent: int) -> tuple[int, int]:
    """Fragments of a size class, and how many of them may be empty.

    Two sets that link and of which the larger is of the class differ in at most ``differ`` n-grams; so of
    ``differ + 1 + spare`` fragments ``1 + spare`` are equal, and one of these is not empty if at most ``spare`` are.
    ``spare`` is what the smallest sets need for most of their cuts.
    """
    low, top = int(LOWS[scheme]), int(LOWS[scheme + 1]) - 1
    differ = 2 * top * (100 - percent) // (100 + percent)
    if not differ:
        return 1, 0
    least = percent * low / 100
    if differ + 1 > math.ceil(least):
        raise ValueError("sets may differ in more n-grams than the smaller one has: the threshold is too low")
    spare = 1
    while True:
        count = differ + 1 + spare
        share = math.exp(-least / count)  # of empty fragments; their number varies less the more there are
        varies = count * share * (1 - (1 + least / count) * share)
        if count * share + 2 * math.sqrt(max(varies, 0.0)) <= spare or count > 64 * top:
            return count, spare
        spare += 1 + spare // 256


def signatures(flat: np.ndarray, bounds: np.ndarray, scheme: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """One hash for each fragment of each set that is not empty, and whose it is.

    A set with too many empty fragments is cut anew by another order until it has few enough; it keeps the
    cuts before, as its partners may have been content with one of them.
    """
    n = np.diff(bounds)
    sizes = np.array([fragments(s, percent) for s in scheme.tolist()], np.int64).reshape(-1, 2)
    count, spare = sizes[:, 0], sizes[:, 1]
    found, owners = [], []
    rows, cut = np.arange(len(n)), 0
    while len(rows):
        part, limits = take(flat, bounds, rows) if cut else (flat, bounds)
        owner = np.repeat(np.arange(len(rows)), np.diff(limits))
        order = part
        if cut:
            order = mix(part + U((cut * 2 + 1) * 0x9E3779B97F4A7C15 % 2**64))
            by = np.lexsort((order, owner))
            order, part = order[by], part[by]
        k = count[rows][owner].astype(U)
        piece = ((order >> U(32)) * k) >> U(32)
        start = runs(owner, piece)
        sums = np.add.reduceat(mix(part), start) if len(start) else np.empty(0, U)
        who = owner[start]
        tag = (scheme[rows][who].astype(U) << U(56)) + (U(cut) << U(40)) + piece[start]
        found.append(mix(sums ^ mix(tag)))
        owners.append(rows[who])
        empty = count[rows] - np.bincount(who, minlength=len(rows))
        rows = rows[(empty > spare[rows]) & (n[rows] > 0)]
        cut += 1
    owner = np.concatenate([*owners, np.empty(0, np.int64)])
    by = np.argsort(owner, kind="stable")
    return np.concatenate([*found, np.empty(0, U)])[by], owner[by]


def cell_count(scheme: int) -> int:
    """Cells of a size class, of four bits each: 64 to 2,048 bytes.

    About one for each n-gram up to 4,096; with fewer, n-grams that differ fall into one cell and sets that are
    far from linked pass the bound.
    """
    return 1 << min(12, max(7, int(LOWS[scheme] - 1).bit_length()))


def cells(flat: np.ndarray, bounds: np.ndarray, scheme: np.ndarray) -> list[bytes]:
    """Four bits for each fragment of a fine cut, equal where the fragments are."""
    owner = np.repeat(np.arange(len(scheme)), np.diff(bounds))
    size = np.array([cell_count(s) for s in scheme.tolist()], np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    bits = np.log2(size).astype(np.int64).astype(U)
    piece = flat >> (U(64) - bits[owner])
    start = runs(owner, piece)
    out = np.zeros(int(at[-1]), np.uint8)
    if len(start):
        sums = mix(np.add.reduceat(mix(flat), start))
        out[at[owner[start]] + piece[start].astype(np.int64)] = (sums & U(15)).astype(np.uint8)
    packed = out.reshape(-1, 2) @ np.array([1, 16], np.uint8)
    return [packed[a:b].tobytes() for a, b in zip((at[:-1] // 2).tolist(), (at[1:] // 2).tolist())]


def unlike_cells(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many cells differ, for each pair of rows."""
    z = x ^ y
    z |= z >> U(2)
    return np.bitwise_count((z | (z >> U(1))) & U(0x1111111111111111)).sum(axis=1, dtype=np.int64)


def set_keys(flat: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """A 128-bit hash of each set, none for an empty one."""
    n = np.diff(bounds)
    rows = np.flatnonzero(n)
    start = bounds[:-1][rows]
    keys = np.zeros((len(n), 2), U)
    if len(rows):
        one = mix(flat)
        keys[rows, 0] = np.add.reduceat(one, start) + n[rows].astype(U)
        keys[rows, 1] = np.add.reduceat(mix(one + U(0x632BE59BD9B4E019)), start)
    return [k.tobytes() if m else None for k, m in zip(keys, n.tolist())]


SETS = "doc_id long, text_key long, n long, key binary, first boolean, scheme int, cells binary, signatures array<long>, mark binary"


def read_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """One row per document and size class it takes part in; ``first`` marks one row of each document.

    A column ``mark`` of ``docs`` comes along in the first rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            flat, bounds = sets(part.column("text"), width)
            n = np.diff(bounds)
            keys = np.array(set_keys(flat, bounds), object)
            ids, texts, marks = part.column("doc_id"), part.column("text_key"), part.column("mark")
            main = np.searchsorted(LOWS, n, side="right") - 1
            classes = [(np.arange(len(n)), main)]
            while True:  # the classes of larger sets it may link with
                rows, scheme = classes[-1]
                more = (n[rows] > 0) & (100 * n[rows] >= percent * LOWS[np.maximum(scheme, 0) + 1])
                if not more.any():
                    break
                classes.append((rows[more], scheme[more] + 1))
            for turn, (rows, scheme) in enumerate(classes):
                some, limits = (flat, bounds) if not turn else take(flat, bounds, rows)
                grade = np.maximum(scheme, 0)
                hashes, owner = signatures(some, limits, grade, percent)
                ends = np.cumsum(np.bincount(owner, minlength=len(rows)))
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows)),
                        texts.take(pa.array(rows)),
                        pa.array(n[rows]),
                        pa.array(keys[rows], pa.binary()),
                        pa.array(np.full(len(rows), not turn)),
                        pa.array(scheme.astype(np.int32)),
                        pa.array(cells(some, limits, grade), pa.binary()),
                        pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64))),
                        pa.nulls(len(rows), pa.binary()) if turn else marks.take(pa.array(rows)),
                    ],
                    [c.split()[0] for c in SETS.split(", ")],
                )

    return docs.select("doc_id", "text_key", "text", "mark").mapInArrow(run, SETS)


# --- candidate pairs -------------------------------------------------------------------------------

PAIRS = "a long, b long, n_a long, n_b long, later long"
RANKS = ((1, 1), (2, 4), (5, 16), (17, 64), (65, 256), (257, BLOCK * 2))  # a block, or two that meet, have no higher ranks


def within(members: DataFrame, percent: int, ranks: tuple[int, int]) -> DataFrame:
    """Pairs of classes that share a fragment, may link by their sizes and cells, and have different labels, each with ``a < b``.

    ``members``: ``scheme, signature, low, high`` (the blocks that meet), ``block, id, n, cells, label``, sorted
    by the first four.  A pair is given if either class ranks the other within ``ranks`` by the cells that differ.  A row without a
    pair names in ``later`` a signature whose group has pairs of higher ranks.
    """

    def pairs_of(t: pa.Table) -> Iterator[pa.RecordBatch]:
        scheme = t["scheme"].to_numpy()
        for s in np.unique(scheme):
            rows = t.filter(pa.array(scheme == s))
            matrix = np.frombuffer(b"".join(rows["cells"].to_pylist()), U).reshape(rows.num_rows, -1)
            n, block, label, ids = (rows[c].to_numpy() for c in ("n", "block", "label", "id"))
            ident = np.stack([rows[c].to_numpy() for c in ("signature", "low", "high")])
            crossing = ident[1] != ident[2]
            found = []
            alive = np.arange(len(n))
            k = 0
            while True:
                k += 1
                alive = alive[alive + k < len(n)]
                alive = alive[(ident[:, alive] == ident[:, alive + k]).all(axis=0)]
                if not len(alive):
                    break
                i, j = alive, alive + k
                ok = ~(crossing[i] & (block[i] == block[j]))
                ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
                i, j = i[ok], j[ok]
                both = n[i] + n[j]
                differ = both - 2 * (-(-percent * both // (100 + percent)))
                unlike = np.empty(len(i), np.int64)
                step = max(1, 1_000_000 // matrix.shape[1])
                for at in range(0, len(i), step):
                    unlike[at : at + step] = unlike_cells(matrix[i[at : at + step]], matrix[j[at : at + step]])
                ok = unlike <= differ
                found.append((i[ok], j[ok], unlike[ok]))
            i, j, unlike = (np.concatenate([f[c] for f in found] or [np.empty(0, np.int64)]) for c in range(3))
            # The rank of each pair in the eyes of either side, the same in every round.
            own, other, far = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([unlike, unlike])
            by = np.lexsort((ids[other], far, own))
            start = np.searchsorted(own[by], own[by])
            rank = np.empty(len(by), np.int64)
            rank[by] = np.arange(len(by)) - start + 1
            rank = np.minimum(rank[: len(i)], rank[len(i) :])
            crosses = label[i] != label[j]
            chosen = crosses & (rank >= ranks[0]) & (rank <= ranks[1])
            x, y = i[chosen], j[chosen]
            x, y = np.where(ids[x] < ids[y], x, y), np.where(ids[x] < ids[y], y, x)
            names = [c.split()[0] for c in PAIRS.split(", ")]
            # A pair of several groups that this task holds is given once.
            pairs, first = np.unique(np.stack([ids[x], ids[y]], axis=1), axis=0, return_index=True)
            columns = [pa.array(c) for c in (pairs[:, 0], pairs[:, 1], n[x][first], n[y][first])]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(first), pa.int64())], names)
            later = np.unique(ident[0][i[crosses & (rank > ranks[1])]])
            yield pa.RecordBatch.from_arrays([*[pa.nulls(len(later), pa.int64())] * 4, pa.array(later)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            if count < 5000:
                continue
            t = pa.Table.from_batches(held)
            ident = [t[c].to_numpy() for c in ("scheme", "signature", "low", "high")]
            same = np.logical_and.reduce([c == c[-1] for c in ident])
            whole = int(len(same) - np.argmin(same[::-1])) if not same.all() else 0
            if whole:  # the last group may go on
                yield from pairs_of(t.slice(0, whole))
            held, count = t.slice(whole).combine_chunks().to_batches(), t.num_rows - whole
        if held:
            yield from pairs_of(pa.Table.from_batches(held))
        pa.default_memory_pool().release_unused()

    return members.mapInArrow(run, PAIRS).distinct()


# --- overlaps ----------------------------------------------------------------------------------------


def counted_fragments(docs: DataFrame, width: int) -> DataFrame:
    """The sets of ``docs`` (``id, text``), cut into ``COUNTED`` fragments: ``id, fragments``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            flat, bounds = sets(part.column("text"), width)
            owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            piece = (((flat >> U(32)) * U(COUNTED)) >> U(32)).astype(np.int64)
            sizes = np.bincount(owner * COUNTED + piece, minlength=part.num_rows * COUNTED)
            inner = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat.view(np.int64)))
            outer = pa.array((np.arange(part.num_rows + 1) * COUNTED).astype(np.int32))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(outer, inner)], ["id", "fragments"])

    return docs.select("id", "text").mapInArrow(run, "id long, fragments array<array<long>>")


def linked(pairs: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """The pairs that link: partial overlaps are counted in each fragment and summed per pair."""
    met = pairs.join(grams.toDF("a", "own"), "a").join(grams.toDF("b", "other"), "b")
    parts = [F.size(F.array_intersect(F.col("own")[k], F.col("other")[k])) for k in range(COUNTED)]
    total = met.select("a", "b", "n_a", "n_b", sum(parts[1:], parts[0]).alias("both"))
    return total.where(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")


# --- components --------------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """``id, label`` for every end of a link: the smallest id it reaches.

    Large and small stars in turn: each round hangs the larger (then the smaller) neighbours of an id on the smallest one.
    The rounds grow with the logarithm of the longest path.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = state(edges)
    while now[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        star = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        turned = stored(star.where("u <> v").distinct(), "stars")
        release(edges)
        edges = turned
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(least, "u")
        star = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        turned = stored(star.where("u <> v").distinct(), "stars")
        release(edges)
        edges = turned
        was, now = now, state(edges)
        if was == now:
            break
    least = edges.select(F.col("u").alias("id"), F.col("v").alias("label"))
    labels = stored(least.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()), "labels")
    release(edges)
    return labels


# --- the join ------------------------------------------------------------------------------------------


def shared_signatures(all_sets: DataFrame) -> DataFrame:
    """``key, scheme, signature`` of the fragments that a set shares with another.

    All signatures are shuffled once, as two numbers.  Those that meet are few: a bitmap of them filters the second look at the lists before
    anything of it is shuffled.
    """
    each = all_sets.where("n > 0").select(F.xxhash64("key").alias("short"), F.explode("signatures").alias("signature"))
    shared = each.groupBy("signature").agg(F.min("short").alias("x"), F.max("short").alias("y")).where("x <> y")
    shared = stored(shared.select("signature"), "shared")
    known = all_sets.sparkSession.sparkContext.broadcast(bitmap(shared, "signature"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = known.value
        for batch in batches:
            lists = batch.column("signatures")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            at = np.flatnonzero(seen(flat.view(U)))
            row = pc.list_parent_indices(lists).take(pa.array(at))
            columns = [batch.column("key").take(row), batch.column("scheme").take(row), pa.array(flat[at])]
            yield pa.RecordBatch.from_arrays(columns, ["key", "scheme", "signature"])

    likely = all_sets.where("n > 0").select("key", "scheme", "signatures").mapInArrow(run, "key binary, scheme int, signature long")
    met = stored(likely.distinct().join(shared, "signature", "left_semi"), "met")
    release(shared)
    return met


def members_of(all_sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes that share a fragment with another class: ``signature, scheme, low, high, block, id``.

    Also ``id, scheme, n, cells`` of the classes, and their numbers, ``key, id``.
    """
    met = shared_signatures(all_sets)
    own = all_sets.where("n > 0").join(met.select("key").distinct(), "key", "left_semi")
    detail = stored(own.select("key", "scheme", "n", "cells").dropDuplicates(["key", "scheme"]), "cells")
    numbered = stored(detail.select("key").distinct().withColumn("id", F.monotonically_increasing_id()), "numbers")
    blocks = met.groupBy("signature").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = met.join(blocks, "signature").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    members = stored(dealt.join(numbered, "key").select("signature", "scheme", "low", "high", "block", "id"), "members")
    classes = stored(detail.join(numbered, "key").select("id", "scheme", "n", "cells"), "classes")
    release(met, detail)
    return members, classes, numbered


def candidates(
    members: DataFrame, classes: DataFrame, labels: DataFrame | None, later: DataFrame | None, percent: int, ranks: tuple[int, int]
) -> DataFrame:
    """Pairs of the given ranks, of the groups in ``later`` (``signature``; of all if None)."""
    order = ["scheme", "signature", "low", "high"]
    if later is not None:
        members = members.join(later, "signature", "left_semi")
    if labels is None:
        members = members.withColumn("label", F.col("id"))
    else:
        # Groups that the links so far have joined go before the cells come in.
        known = labels.withColumnRenamed("label", "known")
        members = members.join(known, "id", "left").withColumn("label", F.coalesce("known", "id")).drop("known")
        open_ones = members.groupBy("signature").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
        members = members.join(open_ones.select("signature"), "signature", "left_semi")
    dealt = members.join(classes, ["id", "scheme"]).repartition(*order).sortWithinPartitions(*order, "id")
    return within(dealt.select(*order, "block", "id", "n", "cells", "label"), percent, ranks)


def connected(read: DataFrame, width: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The sets of ``doc_id, text, mark``, and ``key, label`` of every class that links with another."""
    percent = round(100 * threshold)
    if not 70 <= percent <= 100:
        raise ValueError("the threshold must be from 0.7 to 1")
    read = read.withColumn("text_key", F.xxhash64("text"))
    all_sets = stored(read_sets(read, width, percent), "sets")
    members, classes, numbered = members_of(all_sets)
    slim = stored(all_sets.where("first").select("doc_id", "text_key", "n", "key", "mark"), "documents")
    release(all_sets)
    grams: DataFrame | None = None
    labels: DataFrame | None = None
    asked: DataFrame | None = None
    for ranks in RANKS:
        later = None if asked is None else asked.where("a is null").select(F.col("later").alias("signature"))
        before, asked = asked, stored(candidates(members, classes, labels, later, percent, ranks), "pairs")
        if before is not None:
            release(before)
        pairs = asked.where("a is not null")
        if grams is None:
            # Every class that has a partner at all is in a pair of the first round.  Its set is read from one document.
            named = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(numbered, "id")
            one = slim.join(named, "key").groupBy("id").agg(
                F.min_by("doc_id", "text_key").alias("asked_id"), F.min("text_key").alias("asked_text")
            )
            same = (F.col("text_key") == F.col("asked_text")) & F.col("doc_id").eqNullSafe(F.col("asked_id"))
            texts = read.join(one, same).select("id", "text")
            grams = stored(counted_fragments(texts, width).dropDuplicates(["id"]), "grams")
        links = linked(pairs, grams, percent)
        if labels is None:
            labels = components(links)
        else:
            links = stored(links, "links")
            if not links.isEmpty():  # else the components are what they were
                old, labels = labels, components(links.unionByName(labels.select(F.col("id").alias("a"), F.col("label").alias("b"))))
                release(old)
            release(links)
        if asked.where("a is null").isEmpty():
            break
    release(asked, members, classes, grams)
    return slim, labels.join(numbered, "id").select("key", "label")


def similar(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``."""
    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    own, labels = connected(read.withColumn("mark", F.lit(None).cast("binary")), width, threshold)
    classes = own.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size"))
    classes = stored(classes.join(labels, "key", "left"), "classes")
    alone = classes.where("label is null").select("key", "size", F.col("least").alias("component_id"))
    linked_ones = classes.where("label is not null")
    parts = linked_ones.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members"))
    joined = join_groups(linked_ones.select("key", "size", "label"), stored(parts, "parts"), ["label"], "members", "inner")
    named = stored(alone.unionByName(joined.select("key", "size", "component_id")), "named")
    full = join_groups(own.where("n > 0").select("doc_id", "n", "key"), named, ["key"], "size", "inner")
    empty = own.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.select("doc_id", "n", "component_id").unionByName(empty).withColumnRenamed("n", "n_shingles")


def distinct_documents(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, with the smallest id; null ids come last.

    Among rows with that id a digest of id and text decides, and of rows that repeat both one stays.  Rows without words are alone:
    with an id, one of each id and text stays (a null text counts as empty); without an id all stay.
    """
    ident, text = docs["doc_id"].cast("long"), docs["text"].cast("string")
    own = F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")))
    mark = F.unhex(F.sha2(own, 256)).alias("mark")
    first, labels = connected(docs.select(ident.alias("doc_id"), text.alias("text"), mark), width, threshold)
    best = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")
    classes = first.where("n > 0").groupBy("key").agg(F.min(best).alias("best"))
    classes = stored(classes.join(labels, "key", "left"), "classes")
    chosen = classes.where("label is not null").groupBy("label").agg(F.min("best").alias("best")).select("best.mark")
    chosen = chosen.unionByName(classes.where("label is null").select("best.mark"))
    chosen = chosen.unionByName(first.where("n = 0 and doc_id is not null").select("mark").distinct()).withColumn("stays", F.lit(True))
    # All frequent marks are named, those that go too, so that no task gathers their rows.
    marks = stored(first.where("n > 0 or doc_id is not null").groupBy("mark").agg(F.count(F.lit(1)).alias("times")), "marks")
    total = marks.agg(F.sum("times")).first()[0] or 0
    marks = marks.join(chosen, "mark", "left").where(F.col("stays") | (F.col("times") * 1000 > F.lit(total)))
    marks = stored(marks.withColumn("stays", F.coalesce("stays", F.lit(False))), "stay")
    wordless = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS)) == ""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), mark, (wordless & ident.isNull()).alias("alone"))
    named = rows.where("not alone").select("row", "mark")
    met = join_groups(named, marks, ["mark"], "times", "inner").where("stays")
    alone = rows.where("alone").select("row.*")
    if marks.where("stays and times > 1").isEmpty():
        return met.select("row.*").unionByName(alone)
    repeated = met.where("times > 1").dropDuplicates(["mark"])
    return met.where("times = 1").unionByName(repeated).select("row.*").unionByName(alone)
