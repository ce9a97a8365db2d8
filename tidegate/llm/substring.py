"""Substring deduplication on a compacted De Bruijn graph of word k-mers.

Every window of ``width`` words has an anchor: of its k-mers the one with the least hash, the first of equal ones.  Windows in a row with the same
anchor are an edge of the graph; its label is the anchor with a hash of all words the edge spans, its coordinate the text and the first window.  What a
window holds decides on its anchor, so windows with equal words have equal anchors, and inside a long repeat whole edges are equal.

* An edge found twice or more is repeated, with all its windows.  Repeated edges in a row whose successor and predecessor are the only ones they have
  compact, by joins of their labels, into nonbranching paths, one row for each place of a path.
* An edge found once, whose anchor occurs on other edges too, may share some windows with these: the ends of repeats.  Coordinates lead back to
  the texts, where the windows of such edges, and of those they may share them with, are read and counted one by one.

Only labels and coordinates are shuffled, and texts once (texts with open edges a second time, from a stored table).  Labels found often are joined by
broadcast.

Cases: null, empty and blank texts have no words.  Texts of fewer words than ``width`` have no windows and stay whole.  Windows are told by 128 bits of
hashes.  Equal texts, repeated rows and rows with equal or null ids are documents of their own, so the windows of both are repeated.  Windows that overlap
in one text (a repeated word) count as two.  Very long texts stay within their row.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import Words, join_groups, mix, slices, stored

U = np.uint64
EDGES = "key long, check int, anchors array<long>, labels array<long>, starts array<int>, sizes array<int>"
LABEL = ["anchor", "label"]
TEXT = ["key", "check"]
WHOLE, OPEN, OTHER = 0, 1, 2
FIRST = (
    "row long, doc_id long, n_words long, n_removed long, kept_sha256 string, text string, spans array<struct<start:int,size:int>>,"
    " open boolean, windows array<struct<anchor:long,window:long,start:int,open:boolean>>"
)
LAST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U(0x9E3779B97F4A7C15) + mix(b + U(0xD1B54A32D192ED03)))


def gram_hashes(own: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, by doubling; the last step overlaps."""
    out, have = own, 1
    while have < width:
        step = min(have, width - have)
        if len(out) <= step:
            return out[:0]
        out, have = joined(out[:-step], out[step:]), have + step
    return out


def anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` grams the place of the least, the first of equal ones."""
    best, have = np.arange(len(grams)), 1
    while have < span:
        step = min(have, span - have)
        if len(best) <= step:
            return best[:0]
        a, b = best[:-step], best[step:]
        best, have = np.where(grams[b] < grams[a], b, a), have + step
    return best


class Graph:
    """Windows and edges of some texts, given the hashes of their words one after the other."""

    def __init__(self, own: np.ndarray, bounds: np.ndarray, width: int, k: int) -> None:
        self.windows = gram_hashes(own, width)
        grams = gram_hashes(own, k)
        place = anchors(grams, width - k + 1)
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        inside = np.flatnonzero(owner[: len(place)] == owner[width - 1 :]) if len(place) else np.empty(0, np.int64)
        at = place[inside]
        new = np.ones(len(inside), bool)
        # An anchor lies in one text, but a window that crosses two texts may lie between two with the same one.
        new[1:] = (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1)
        first = np.flatnonzero(new)
        self.sizes = np.diff(np.append(first, len(inside)))
        begin = inside[first]
        self.owner = owner[begin]
        self.starts = begin - bounds[:-1][self.owner]
        self.anchors = grams[at[first]]
        # An edge has at most width - k + 1 windows, so its first and last one cover all its words.
        self.labels = mix(joined(self.windows[begin], self.windows[begin + self.sizes - 1]) + self.sizes.astype(U))


def read_edges(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = Words(part.column("text"))
            graph = Graph(found.hashes(), found.bounds, width, k)
            bounds = pa.array(np.searchsorted(graph.owner, np.arange(part.num_rows + 1)), pa.int32())
            columns = [(graph.anchors.view(np.int64), pa.int64()), (graph.labels.view(np.int64), pa.int64()), (graph.starts, pa.int32()), (graph.sizes, pa.int32())]
            lists = [pa.ListArray.from_arrays(bounds, pa.array(c, kind)) for c, kind in columns]
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("check"), *lists], [c.split()[0] for c in EDGES.split(", ")])

    return run


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))
    return rows.withColumns({"key": F.xxhash64("text"), "check": F.hash("text")})


def edges(docs: DataFrame, width: int = 35, k: int = 12) -> DataFrame:
    """One row for each edge of each text: its label, coordinate and neighbours."""
    own = stored(docs.select("key", "check", "text").mapInArrow(read_edges(width, k), EDGES).where("size(labels) > 0"), "edges")
    at = F.col("at")
    return own.select("*", F.posexplode("labels").alias("at", "label")).select(
        *TEXT, F.get("anchors", at).alias("anchor"), "label", F.get("starts", at).alias("start"), F.get("sizes", at).alias("size"),
        F.get("labels", at + 1).alias("after"), F.when(at > 0, F.get("labels", at - 1)).alias("before"),
    )


def repeated_edges(found: DataFrame) -> DataFrame:
    """The edges whose anchor occurs twice or more, with ``n``, how often the edge does, and ``kinds``, how many edges the anchor has."""
    labels = stored(found.groupBy(*LABEL).agg(F.count(F.lit(1)).alias("n")), "labels")
    by_anchor = labels.groupBy("anchor").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    by_anchor = stored(by_anchor.where("total > 1"), "anchors")
    known = stored(join_groups(labels, by_anchor, ["anchor"], "kinds", "inner").drop("total"), "known")
    return stored(join_groups(found, known, LABEL, "n", "inner"), "repeated")


def paths(repeated: DataFrame) -> DataFrame:
    """Nonbranching paths of repeated edges: ``key, check, start, size, path``, one row for each text and place."""
    own = repeated.where("n > 1")

    def one(column: str) -> Column:
        """Whether there is one neighbour only; the end of a text is one as well."""
        found = F.coalesce(F.col(column), F.lit(0))
        return F.min(found) == F.max(found)

    nodes = stored(own.groupBy(*LABEL).agg(F.count(F.lit(1)).alias("copies"), one("after").alias("leads"), one("before").alias("follows")), "nodes")
    places = join_groups(own.select(*TEXT, "start", "size", *LABEL), nodes, LABEL, "copies", "inner")
    # Equal texts have the same edges at the same places.
    places = places.groupBy(*TEXT, "start").agg(*[F.max(c).alias(c) for c in ("size", "label", "leads", "follows")])
    text = Window.partitionBy(*TEXT).orderBy("start")
    adjoins = (F.lag("start").over(text) + F.lag("size").over(text) == F.col("start")) & F.lag("leads").over(text) & F.col("follows")
    numbered = places.withColumn("first", F.when(F.coalesce(adjoins, F.lit(False)), 0).otherwise(1))
    numbered = numbered.withColumn("number", F.sum("first").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*TEXT, "number").agg(
        F.min("start").alias("start"), F.sum("size").cast("int").alias("size"), F.min_by("label", "start").alias("path")
    ).drop("number")


def cut(found: Words, bounds: np.ndarray, covered: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """How many words of each text go, and the digests of what stays."""
    total = np.concatenate([[0], np.cumsum(covered)])
    gone = total[bounds[1:]] - total[bounds[:-1]]
    ends = np.concatenate([[0], np.cumsum(np.diff(bounds) - gone)])
    words = found.vocabulary.take(pa.array(found.codes[~covered])).cast(pa.large_string())
    texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), words), pa.scalar(" ", pa.large_string()))
    return gone, [hashlib.sha256(t.as_buffer()).hexdigest() for t in texts.cast(pa.large_binary())]


def cover(length: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``length`` words lie in a span."""
    edge = np.bincount(starts, minlength=length + 1) - np.bincount(ends, minlength=length + 1)
    return np.cumsum(edge[:length]) > 0


def flat(column: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    """The row of each entry of a list column, and the entries."""
    return pc.list_parent_indices(column).to_numpy(zero_copy_only=False).astype(np.int64), column.flatten()


def numbers(entries: pa.StructArray, name: str) -> np.ndarray:
    return entries.field(name).to_numpy(zero_copy_only=False)


def edge_windows(hashes: np.ndarray, base: np.ndarray, size: np.ndarray, width: int, k: int) -> list[np.ndarray]:
    """All windows of some edges: the edge, the place in it, its anchor and the window's hash."""
    lengths = size + width - 1
    ends = np.cumsum(lengths)
    own = hashes[np.arange(int(ends[-1])) + np.repeat(base - (ends - lengths), lengths)]
    first = ends - lengths
    grams = gram_hashes(own, k)
    anchor = grams[anchors(grams, width - k + 1)[first]]
    which = np.repeat(np.arange(len(size)), size)
    step = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
    window = gram_hashes(own, width)[first[which] + step]
    return [which, step, anchor[which].view(np.int64), window.view(np.int64)]


def settle(width: int, k: int):
    """Cut out whole paths; texts with open edges give the windows to look at and stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for part in slices(batches):
            found = Words(part.column("text"))
            owner, entries = flat(part.column("spans"))
            start, size, kind = (numbers(entries, c).astype(np.int64) for c in ("start", "size", "kind"))
            base = found.bounds[:-1][owner] + start
            whole = kind == WHOLE
            gone, digests = cut(found, found.bounds, cover(len(found.codes), base[whole], (base + size)[whole] + width - 1))
            open_row = np.zeros(part.num_rows, bool)
            open_row[owner[kind == OPEN]] = True
            rows = np.arange(row, row + part.num_rows)
            row += part.num_rows
            look = np.flatnonzero(~whole)
            windows = edge_windows(found.hashes(), base[look], size[look], width, k) if len(look) else [np.empty(0, np.int64)] * 4
            which, step, anchor, window = windows
            which = look[which]
            # Entries stand in the order of their texts, so what they give does as well.
            kept = np.flatnonzero(whole & open_row[owner])
            spans = pa.StructArray.from_arrays([pa.array(c[kept], pa.int32()) for c in (start, size)], ["start", "size"])
            each = [pa.array(anchor, pa.int64()), pa.array(window, pa.int64()), pa.array(start[which] + step, pa.int32()), pa.array(kind[which] == OPEN)]
            each = pa.StructArray.from_arrays(each, ["anchor", "window", "start", "open"])

            def lists(owners: np.ndarray, values: pa.Array, n: int = part.num_rows) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(np.searchsorted(owners, np.arange(n + 1)), pa.int32()), values)

            texts = pc.if_else(pa.array(open_row), part.column("text"), pa.scalar(None, part.column("text").type))
            columns = [
                pa.array(rows), part.column("doc_id"), pa.array(np.diff(found.bounds), pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string()),
                texts, lists(owner[kept], spans), pa.array(open_row), lists(owner[which], each),
            ]
            names = ["row", "doc_id", "n_words", "n_removed", "kept_sha256", "text", "spans", "open", "windows"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def finish(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = Words(part.column("text"))
            owner, entries = flat(part.column("spans"))
            base = found.bounds[:-1][owner] + numbers(entries, "start")
            gone, digests = cut(found, found.bounds, cover(len(found.codes), base, base + numbers(entries, "size") + width - 1))
            columns = [part.column("doc_id"), part.column("n_words"), pa.array(gone, pa.int64()), pa.array(digests)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in LAST.split(", ")])

    return run


def deduplicate(docs: DataFrame, width: int = 35, k: int = 12) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256`` after all repeated windows are cut out."""
    own = keyed(docs)
    repeated = repeated_edges(edges(own, width, k))
    span = F.struct("start", "size", "kind").alias("span")
    whole = paths(repeated).withColumn("kind", F.lit(WHOLE)).select(*TEXT, span)
    kind = F.when(F.col("n") > 1, OTHER).otherwise(OPEN)
    unsure = repeated.where("kinds > 1").withColumn("kind", kind).groupBy(*TEXT, "start").agg(F.max("size").alias("size"), F.min("kind").alias("kind"))
    spans = whole.unionByName(unsure.select(*TEXT, span)).groupBy(*TEXT).agg(F.collect_list("span").alias("spans"))
    none = F.array().cast("array<struct<start:int,size:int,kind:int>>")
    met = own.join(spans, TEXT, "left").select("doc_id", "text", F.coalesce("spans", none).alias("spans"))
    first = stored(met.mapInArrow(settle(width, k), FIRST), "settled")
    # The windows of open edges that are found elsewhere as well.
    windows = first.select("row", F.explode("windows").alias("w")).select("row", "w.*")
    counts = stored(windows.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "windows")
    more = join_groups(windows.where("open").drop("open"), counts, ["anchor", "window"], "n", "inner")
    more = more.groupBy("row").agg(F.collect_list(F.struct("start", F.lit(1).alias("size"))).alias("more"))
    rest = first.where("open").join(more, "row", "left")
    both = rest.select("doc_id", "n_words", "text", F.when(F.col("more").isNull(), F.col("spans")).otherwise(F.concat("spans", "more")).alias("spans"))
    return first.where("not open").select("doc_id", "n_words", "n_removed", "kept_sha256").unionByName(both.mapInArrow(finish(width), LAST))
