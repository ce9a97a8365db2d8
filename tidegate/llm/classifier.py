"""Quality classifier: naive Bayes support vectors.

A text is the set of its n-grams, hashed into ``BUCKETS``: words and word pairs, and one to three word shapes in a row (runs of capitals,
small letters, digits and other letters as one character each, marks as they are).  All labelled training texts count towards the log
ratios of the classes' n-gram counts; these scale the indicators of a linear hinge-loss model that dual coordinate descent fits on at most
``sample`` of the training texts, half of them of each class.  A fifth of the sample is not fitted but calibrates margins to probabilities.

A row of counts has at most ``BUCKETS`` entries, the sample at most ``sample * BUCKETS``; both are what the driver holds.

Cases: null, empty and blank texts have no n-grams; their score follows from the bias alone.  Null ids count as the empty text in the split and
have no label.  Of several labels of one id the mean decides, a half is good; null labels are none.  Repeated rows are texts of their own, but come into the sample once: however often an id is there, the driver gets no more.
Without labels of both classes the score is the smoothed share of good labels.  Very long texts are read whole.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import Words, distinct, mix, slices

BUCKETS = 1 << 17
U = np.uint64
SCORES = "doc_id long, held_out boolean, score double"


def fold(doc_id: Column, folds: int = 5) -> Column:
    """The remainder of the id's checksum."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def shapes(words: pa.Array) -> pa.Array:
    for pattern, mark in ((r"[A-Z]+", "A"), (r"[a-z]+", "a"), (r"[0-9]+", "0"), (r"[^\x00-\x7F]+", "u")):
        words = pc.replace_substring_regex(words, pattern, mark)
    return words


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of each text, one text after the other, and the bounds of each."""
    found = Words(texts)
    n = len(found.bounds) - 1
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(found.bounds))
    coded = shapes(found.vocabulary.cast(pa.large_string())).dictionary_encode() if len(found.vocabulary) else None
    keys = []

    def add(hashes: np.ndarray, kind: int, width: int) -> None:
        size = len(hashes) - width + 1
        if size <= 0:
            return
        gram = np.full(size, kind * 16 + width, U)
        for j in range(width):
            gram = mix(gram * U(0x9E3779B97F4A7C15) + hashes[j : j + size])
        inside = owner[:size] == owner[width - 1 :]
        keys.append((owner[:size] * BUCKETS + (gram % U(BUCKETS)).astype(np.int64))[inside])

    if coded is not None:
        own = found.hashes()
        shape_words = Words(coded.dictionary)
        shape = shape_words.hashes()[coded.indices.to_numpy(zero_copy_only=False)][found.codes]
        add(own, 1, 1)
        add(own, 1, 2)
        for width in (1, 2, 3):
            add(shape, 2, width)
    flat = distinct(np.concatenate(keys)) if keys else np.empty(0, np.int64)
    return (flat % BUCKETS).astype(np.int32), np.searchsorted(flat, np.arange(n + 1) * BUCKETS)


def class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each class a bucket is found; bucket -1 holds the texts themselves."""
    counts, docs = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
    for part in slices(batches):
        labels = part.column("label").to_numpy(zero_copy_only=False)
        flat, bounds = ngrams(part.column("text"))
        each = np.repeat(labels, np.diff(bounds))
        for k in (0, 1):
            counts[k] += np.bincount(flat[each == k], minlength=BUCKETS)
            docs[k] += int((labels == k).sum())
    some = np.flatnonzero(counts.sum(axis=0))
    columns = [np.append(some, -1), np.append(counts[0, some], docs[0]), np.append(counts[1, some], docs[1])]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["bucket", "bad", "good"])


def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        flat, bounds = ngrams(part.column("text"))
        lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(flat, pa.int32()))
        yield pa.RecordBatch.from_arrays([part.column("place"), part.column("label"), lists.cast(pa.list_(pa.int32()))], ["place", "label", "grams"])


def descend(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, costs: np.ndarray, epochs: int, seed: int) -> np.ndarray:
    """Weights (the bias last) of the hinge-loss model, by coordinate descent in its dual.  Every row has norm one, and a bias input of one."""
    weights, alpha = np.zeros(BUCKETS + 1), np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, y = rows[i], values[i], signs[i]
            gradient = y * (weights[at] @ x + weights[-1]) - 1
            new = min(max(alpha[i] - gradient / (x @ x + 1), 0.0), costs[i])
            if step := (new - alpha[i]) * y:
                weights[at] += step * x
                weights[-1] += step
                alpha[i] = new
    return weights


def calibrate(margins: np.ndarray, good: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton's method with a small prior against extremes."""
    target = np.where(good == 1, (good.sum() + 1) / (good.sum() + 2), 1 / ((1 - good).sum() + 2))
    theta, inputs = np.array([1.0, 0.0]), np.stack([margins, np.ones_like(margins)], axis=1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(inputs @ theta, -30, 30)))
        gradient = inputs.T @ (p - target) + 1e-3 * theta
        hessian = (inputs * (p * (1 - p))[:, None]).T @ inputs + 1e-3 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return max(float(theta[0]), 1e-3), float(theta[1])


class Model:
    """What a task needs to score texts."""

    def __init__(self, ratio: np.ndarray, weights: np.ndarray, slope: float, offset: float) -> None:
        self.weight = (ratio * weights[:-1]).astype(np.float64)
        self.square = ratio**2
        self.bias, self.slope, self.offset = float(weights[-1]), slope, offset

    def margins(self, flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sums = [np.concatenate([[0.0], np.cumsum(v[flat])]) for v in (self.weight, self.square)]
        top, square = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
        return top / np.sqrt(np.maximum(square, 1e-12)) + self.bias

    def __call__(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(*ngrams(texts)) + self.offset, -30, 30)))


def drawn(known: DataFrame, most: int, seed: int) -> DataFrame:
    """``place, label, text`` of at most ``most`` texts of each class, drawn by a hash: those with the smallest ``place``.

    Rows that repeat id and text have one place and count once.  Only places travel until the largest that is taken is known.
    """
    placed = known.withColumn("place", F.xxhash64("doc_id", F.coalesce("text", F.lit("")), F.lit(seed)))
    places = placed.select("label", "place").distinct()
    first = [places.where(F.col("label") == k).orderBy("place").limit(most) for k in (0, 1)]
    ends = dict(first[0].unionByName(first[1]).groupBy("label").agg(F.max("place")).collect())
    inside = F.lit(False)
    for label, end in ends.items():
        inside |= (F.col("label") == label) & (F.col("place") <= end)
    return placed.where(inside).groupBy("place", "label").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, sample: int = 3000, epochs: int = 15, broadcast_rows: int = 1_000_000, seed: int = 17) -> Model | float:
    """The model of ``docs`` (doc_id, text) with ``labels`` (doc_id, label); a number if there is but one class."""
    labels = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    if labels.count() <= broadcast_rows:
        labels = F.broadcast(labels)
    known = docs.join(labels, "doc_id").select("doc_id", "text", "label")
    sums = known.mapInArrow(class_counts, "bucket long, bad long, good long").groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    found = sums.toArrow()
    bucket, bad, good = (found.column(c).to_numpy() for c in ("bucket", "bad", "good"))
    n_bad, n_good = int(bad[bucket < 0].sum()), int(good[bucket < 0].sum())
    if not n_bad or not n_good:
        return (n_good + 1) / (n_good + n_bad + 2)
    p, q = np.ones(BUCKETS), np.ones(BUCKETS)
    inside = bucket >= 0
    p[bucket[inside]] += good[inside]
    q[bucket[inside]] += bad[inside]
    ratio = np.log((p / (n_good + 2)) / (q / (n_bad + 2)))
    taken = drawn(known, max(1, sample // 2), seed)
    rows = taken.mapInArrow(sampled, "place long, label int, grams array<int>").toArrow().combine_chunks().sort_by([("place", "ascending"), ("label", "ascending")])
    lists, good = rows.column("grams").combine_chunks(), rows.column("label").to_numpy()
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    grams = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
    scaled = [ratio[g] / max(np.sqrt((ratio[g] ** 2).sum()), 1e-6) for g in grams]
    fitted = np.arange(len(grams)) % 5 != 4
    if len(set(good[fitted])) < 2 or len(set(good[~fitted])) < 2:
        fitted = np.ones(len(grams), bool)
    own = np.flatnonzero(fitted)
    signs = np.where(good == 1, 1.0, -1.0)
    costs = np.where(good == 1, 1.0, max(1, (good[own] == 1).sum()) / max(1, (good[own] == 0).sum()))
    weights = descend([grams[i] for i in own], [scaled[i] for i in own], signs[own], costs[own], epochs, seed)
    held = ~fitted if not fitted.all() else fitted
    margins = np.array([scaled[i] @ weights[grams[i]] + weights[-1] for i in np.flatnonzero(held)])
    return Model(ratio, weights, *calibrate(margins, good[held]))


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, held_out, score``."""
    if isinstance(model, float):
        return docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), F.lit(model).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            scores = pa.array(model(part.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), scores], ["doc_id", "held_out", "score"])

    return docs.withColumn("held_out", fold(F.col("doc_id")) == 0).mapInArrow(run, SCORES)


def classify(docs: DataFrame, labels: DataFrame, sample: int = 3000) -> DataFrame:
    """Scores of all texts by a model that learns from the labelled rows outside the fold 0."""
    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    marks = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("label"))
    model = train(read.where(fold(F.col("doc_id")) != 0), marks, sample)
    return score(read, model)
