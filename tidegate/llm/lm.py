"""Language model scores of whole texts by a log-bilinear model.

Tokens are the words of a text, capitals lowered, and one end.  The model tells classes of them apart: the ``vocabulary`` most frequent training
tokens and the end are classes of their own, the further ones of the ``local`` most frequent go by the logarithm of their counts, one class for
each doubling, and all rarer and unknown tokens are one class.  The vectors of the two tokens before, each through a matrix of its own, add up to
a prediction, whose product with a class's vector and the class's bias is its score.  Trained by noise-contrastive estimation in numpy, then
normalised over all classes for every context: as the two tokens add up, that is one product of matrices, with a row and a column for each class.
A token takes its share of its class by its count, plus a half.

Counts come from all training texts, and so does the training.  ``steps`` times ``BATCH`` trigrams are learned in the driver: draws
of a small corpus, which bring each some ``OFTEN`` times or more, else all in turns, none again before all were taken.  A corpus with more starts with as many of its trigrams there, texts being drawn with equal chances; then tasks go over
all training texts, each trigram once, in ``ROUNDS`` rounds: each task learns its share from the vectors of the round before, and their mean, weighed by
trigrams, goes on.  There are as many classes as ``vocabulary`` and the doublings up to the largest count (some 30 for 10**9
occurrences).  The driver gets the trigrams of the start, the counts of the ``local`` most frequent tokens and the means of vectors; tasks get the vectors and
the square of the classes, and settle those tokens by themselves.  All other tokens meet their counts in a join by hash; none of them is frequent.

Cases: null, empty and blank texts are the end alone.  Null ids count as the empty text in the split.  Repeated rows are texts of their own.
Without training texts every count is 0.  Very long texts are read whole.  Words are told by 64-bit hashes.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.classifier import fold
from tidegate.llm.common import Words, slices, stored

END = np.int64(0)  # a word whose hash this is takes 1
BATCH = 4096  # draws of one training step
TABLE = 2**20  # entries of a table of all trigrams of classes; larger models are summed up token by token
LOWEST = 1e-25  # of sums of 32-bit numbers: vanished terms, each below 1e-38, do not matter to them
CHUNK = 2**16  # tokens whose vectors are multiplied at once
OFTEN = 20  # times that a trigram comes among the draws of the training, on average, so that hardly any never does
KEPT = 1_000_000  # tokens whose counts a task holds before it gives them away
ROUNDS = 4  # in which tasks go over the texts of a corpus that the driver cannot learn whole; each takes its part of the texts
SHARE = 2**21  # tokens of all rounds that a task learns by itself, at least, so that few vectors are sent
NOISES = 128  # classes that stand for the noise of a whole step in a task
PARTS = 16  # in which vectors are sent and brought together
LONG = 2**16  # characters of a text whose trigrams are drawn one by one for the start
LOCAL = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, words array<long>, times array<long>"


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens and the bounds of each text."""
    found = Words(texts, lower=True)
    own = found.hashes().astype(np.int64)
    own[own == END] = 1
    ends = found.bounds[1:]
    return np.insert(own, ends, END), found.bounds + np.arange(len(found.bounds))


def merged(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, place = np.unique(hashes, return_inverse=True)
    return own, np.bincount(place, counts, len(own)).astype(np.int64)


def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(counts, pa.int64())], ["token", "c"])

    hashes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for part in slices(batches):
        own, n = np.unique(tokens(part.column("text"))[0], return_counts=True)
        hashes, counts = merged(np.concatenate([hashes, own]), np.concatenate([counts, n]))
        if len(hashes) > KEPT:
            yield out()
            hashes, counts = hashes[:0], counts[:0]
    yield out()


class Classes:
    """The classes a model tells apart: of the tokens held, then the rest, and the start of a text.

    ``hashes`` and ``counts`` are those of the tokens held, the most frequent first; ``total`` and ``distinct`` those of all.
    """

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, vocabulary: int, total: int, distinct: int) -> None:
        own = np.arange(len(hashes)) < vocabulary
        own |= hashes == END
        level = np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64)
        _, shared = np.unique(level[~own], return_inverse=True)
        of = np.empty(len(hashes), np.int64)
        of[own] = np.arange(own.sum())
        of[~own] = own.sum() + shared
        order = np.argsort(hashes)
        self.hashes, self.counts, self.held = hashes[order], counts[order], of[order]
        self.rest = int(of.max()) + 1 if len(of) else 0
        self.start = self.rest + 1
        self.uses = np.append(np.bincount(of, counts, self.rest), total - counts.sum())
        far = total - counts.sum() + 0.5 * (distinct - len(hashes) + 1)
        self.mass = np.log10(np.append(np.bincount(of, counts + 0.5, self.rest), far))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of tokens among those held, and which of them are there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def of(self, hashes: np.ndarray) -> np.ndarray:
        at, here = self.find(hashes)
        return np.where(here, self.held[at], self.rest) if len(self.held) else np.full(len(hashes), self.rest)

    def trigrams(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The code of each token with the two before it."""
        own = self.of(hashes)
        first, second = np.full(len(own), self.start), np.full(len(own), self.start)
        place = np.arange(len(own)) - np.repeat(bounds[:-1], np.diff(bounds))
        one, two = np.flatnonzero(place >= 1), np.flatnonzero(place >= 2)
        first[one], second[two] = own[one - 1], own[two - 2]
        return (second * (self.rest + 2) + first) * (self.rest + 1) + own


def summed(places: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different places, and the sums of the rows at each."""
    order = np.argsort(places, kind="stable")
    own = places[order]
    start = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    return own[start], np.add.reduceat(rows[order], start, axis=0)


def gathered(places: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    """``width`` rows with the sums of the given ones at their places."""
    sums = np.zeros((width, *rows.shape[1:]))
    own, found = summed(places, rows)
    sums[own] = found
    return sums


def turns(draw: np.random.Generator, counts: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Numbers of the counted rows, ``size`` at a time, without end: none comes again before all have come."""
    order = np.arange(len(counts), dtype=np.int32)
    if not (counts == 1).all():
        order = np.repeat(order, np.asarray(counts).astype(np.int64))
    order = np.tile(order, -(-size // len(order))) if len(order) < size else order
    at = len(order)
    while True:
        left = order[at : at + size].copy()
        at += size
        if len(left) < size:
            draw.shuffle(order)
            at = size - len(left)
            left = np.concatenate([left, order[:at]])
        yield left


def chances(draw: np.random.Generator, counts: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Numbers of the counted rows, ``size`` at a time, without end, each draw with equal chances for all."""
    ends = np.cumsum(counts, dtype=np.float64)
    while True:
        yield np.minimum(np.searchsorted(ends, draw.random(size) * ends[-1], side="right"), len(ends) - 1)


class LogBilinear:
    """Vectors and matrices of the model, and their training."""

    def __init__(self, classes: int, unigram: np.ndarray, size: int, seed: int) -> None:
        draw = np.random.default_rng(seed)
        self.draw = draw
        self.noise = (unigram + 0.5) / (unigram + 0.5).sum()
        self.params = {
            "context": draw.normal(0, 0.1, (classes + 1, size)),
            "first": np.eye(size),
            "second": 0.5 * np.eye(size),
            "token": draw.normal(0, 0.1, (classes, size)),
            "bias": np.log(self.noise),
        }
        self.squares = {k: np.full_like(v, 1e-7) for k, v in self.params.items()}

    def train(self, second: np.ndarray, first: np.ndarray, token: np.ndarray, counts: np.ndarray, steps: int, batch: int = BATCH, noises: int = 12, rate: float = 0.05, start: float = 1e-7) -> None:
        """Noise-contrastive steps over the counted trigrams: drawn where each comes ``OFTEN`` times or more, else in turns, so that none is left out."""
        p = self.params
        noise_ends = np.cumsum(self.noise)
        squares = self.squares = {k: np.full_like(v, start) for k, v in p.items()}
        offset = np.log(noises * self.noise)
        mean = {k: np.zeros_like(v) for k, v in p.items()}
        drawn_from = chances if steps * batch >= OFTEN * counts.sum(dtype=np.float64) else turns
        for step, at in zip(range(steps), drawn_from(self.draw, counts, batch)):
            a, b = p["context"][first[at]], p["context"][second[at]]
            prediction = a @ p["first"] + b @ p["second"]
            drawn = np.minimum(np.searchsorted(noise_ends, self.draw.random((batch, noises)) * noise_ends[-1], side="right"), len(noise_ends) - 1)
            words = np.concatenate([token[at][:, None], drawn], axis=1)
            vectors = p["token"][words]
            values = (vectors @ prediction[:, :, None])[:, :, 0] + (p["bias"] - offset)[words]
            error = 1 / (1 + np.exp(-np.clip(values, -30, 30)))
            error[:, 0] -= 1
            error /= batch
            back = (error[:, None, :] @ vectors)[:, 0]
            each = (error[:, :, None] * prediction[:, None, :]).reshape(-1, prediction.shape[1])
            grads = {
                "token": gathered(words.ravel(), each, len(self.noise)), "bias": np.bincount(words.ravel(), error.ravel(), len(self.noise)),
                "first": a.T @ back, "second": b.T @ back,
            }
            seen = np.concatenate([first[at], second[at]])
            grads["context"] = gathered(seen, np.concatenate([back @ p["first"].T, back @ p["second"].T]), len(p["context"]))
            for k, g in grads.items():
                squares[k] += g**2
                p[k] = p[k] - rate * g / np.sqrt(squares[k])
            if step >= steps // 2:  # the mean of the second half is steadier than its end
                for k in p:
                    mean[k] += p[k] / (steps - steps // 2)
        if steps:
            self.params = mean

    def packed(self) -> np.ndarray:
        """All vectors, matrices and squares of the training in one row."""
        return np.concatenate([x[k].ravel() for x in (self.params, self.squares) for k in sorted(x)]).astype(np.float32)

    def unpack(self, row: np.ndarray) -> None:
        start = 0
        for x in (self.params, self.squares):
            for k in sorted(x):
                x[k] = row[start : start + x[k].size].reshape(x[k].shape)
                start += x[k].size

    def go_over(self, second: np.ndarray, first: np.ndarray, token: np.ndarray, draw: np.random.Generator, batch: int = BATCH, noises: int = 12, rate: float = 0.05) -> None:
        """Steps over trigrams, each once, that go on where ``train`` ended.

        It is the training's aim as well, but the noise of a step is the same ``NOISES`` draws for all its trigrams, weighed as ``noises`` for each:
        so the step is products of matrices.
        """
        p, squares = self.params, self.squares
        ends, offset = np.cumsum(self.noise), np.log(noises * self.noise).astype(np.float32)
        small = np.uint16 if len(p["context"]) < 2**16 else np.int64  # short numbers are sorted far quicker
        order = draw.permutation(len(token))
        for at in np.array_split(order, -(-len(order) // batch)):
            one, two, word = first[at], second[at], token[at]
            drawn = np.minimum(np.searchsorted(ends, draw.random(NOISES) * ends[-1], side="right"), len(ends) - 1)
            a, b = p["context"][one], p["context"][two]
            prediction = a @ p["first"] + b @ p["second"]
            bias, own, others = p["bias"] - offset, p["token"][word], p["token"][drawn]
            values = np.einsum("ij,ij->i", own, prediction) + bias[word]
            error = (1 / (1 + np.exp(-np.clip(values, -30, 30))) - 1) / batch
            values = prediction @ others.T
            values += bias[drawn]
            np.negative(np.clip(values, -30, 30, out=values), out=values)
            np.exp(values, out=values)
            values += 1
            far = np.divide(np.float32(noises / NOISES / batch), values, out=values)
            back = error[:, None] * own + far @ others
            rows = np.concatenate([np.column_stack([error[:, None] * prediction, error]), np.column_stack([far.T @ prediction, far.sum(axis=0)])])
            words, found = summed(np.concatenate([word, drawn]).astype(small), rows)
            seen, around = summed(np.concatenate([one, two]).astype(small), np.concatenate([back @ p["first"].T, back @ p["second"].T]))
            for k, places, g in (
                ("token", words, found[:, :-1]), ("bias", words, found[:, -1]), ("context", seen, around),
                ("first", slice(None), a.T @ back), ("second", slice(None), b.T @ back),
            ):
                squares[k][places] += g**2
                p[k][places] -= rate * g / np.sqrt(squares[k][places])

    def table(self) -> np.ndarray:
        """Normalised log10 probabilities: a row for each context (second * contexts + first)."""
        p = self.params
        near, far = p["context"] @ p["first"], p["context"] @ p["second"]
        values = (far[:, None, :] + near[None, :, :]).reshape(-1, near.shape[1]) @ p["token"].T + p["bias"]
        values -= values.max(axis=1, keepdims=True)
        return (values - np.log(np.exp(values).sum(axis=1, keepdims=True))) / np.log(10)


class Sums:
    """The values of ``LogBilinear.table`` for given codes, from the model's vectors and the norm of each context.

    The norm sums exp(far + near) over all classes, so it is a product of the two exponentials: one of matrices for all contexts.
    """

    def __init__(self, model: LogBilinear, block: int = 512) -> None:
        p = model.params
        self.near, self.far = p["context"] @ p["first"], p["context"] @ p["second"]
        self.token, self.bias = p["token"], p["bias"]
        size = len(self.near)
        self.norms = np.empty((size, size), np.float32)
        near, most = np.empty((size, len(self.token)), np.float32), np.empty(size)
        for k in range(0, size, block):
            values = self.near[k : k + block] @ self.token.T + self.bias
            most[k : k + block] = values.max(axis=1)
            near[k : k + block] = np.exp(values - most[k : k + block, None])
        for k in range(0, size, block):
            values = self.far[k : k + block] @ self.token.T
            high = values.max(axis=1, keepdims=True)
            sums = np.exp(values - high).astype(np.float32) @ near.T
            low = sums < LOWEST
            sums[low] = 1
            self.norms[k : k + block] = np.log(sums) + high + most
            # Where the two peaks lie so far apart that small terms may have vanished, they are summed by themselves.
            for row in np.flatnonzero(low.any(axis=1)):
                at = np.flatnonzero(low[row])
                values = (self.near[at] + self.far[k + row]) @ self.token.T + self.bias
                peak = values.max(axis=1)
                self.norms[k + row, at] = peak + np.log(np.exp(values - peak[:, None]).sum(axis=1))

    def __getitem__(self, codes: np.ndarray) -> np.ndarray:
        found = np.empty(len(codes))
        for k in range(0, len(codes), CHUNK):
            context, token = np.divmod(codes[k : k + CHUNK], len(self.token))
            second, first = np.divmod(context, len(self.near))
            values = np.einsum("ij,ij->i", self.far[second] + self.near[first], self.token[token]) + self.bias[token]
            found[k : k + CHUNK] = values - self.norms[second, first]
        return found / np.log(10)


class Scorer:
    """What tasks know: the classes with the counts of the tokens held, and the model's values by code."""

    def __init__(self, classes: Classes, model: LogBilinear, total: int, distinct: int) -> None:
        self.classes = classes
        self.table = model.table().ravel() if (classes.rest + 2) ** 2 * (classes.rest + 1) <= TABLE else Sums(model)
        self.base_mass = np.log10(total + 0.5 * (distinct + 1))
        self.logs = np.log10(classes.counts + 0.5)

    def rows(self, hashes: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        sizes = np.diff(bounds)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        codes = self.classes.trigrams(hashes, bounds)
        shares = self.classes.mass[codes % (self.classes.rest + 1)]
        at, here = self.classes.find(hashes)
        logs = np.where(here, self.logs[at], 0.0) if len(self.logs) else np.zeros(len(hashes))

        def total(values: np.ndarray) -> np.ndarray:
            return np.bincount(owner, values, len(sizes))

        far = np.flatnonzero(~here)
        order = far[np.lexsort((hashes[far], owner[far]))]
        own, whose = hashes[order], owner[order]
        new = np.ones(len(own), bool)
        new[1:] = (own[1:] != own[:-1]) | (whose[1:] != whose[:-1])
        start = np.flatnonzero(new)
        return {
            "n_tokens": sizes,
            "n_known": total(here).astype(np.int64),
            "base": total(logs) - sizes * self.base_mass,
            "score": total(self.table[codes] + logs - shares),
            "words": own[start],
            "times": np.diff(np.append(start, len(own))),
            "bounds": np.searchsorted(whose[start], np.arange(len(sizes) + 1)),
        }


def split(classes: Classes, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token two before, the one before and the token of each code; the codes are used up."""
    token = (codes % (classes.rest + 1)).astype(np.int32)
    codes //= classes.rest + 1
    first = (codes % (classes.rest + 2)).astype(np.int32)
    codes //= classes.rest + 2
    return codes.astype(np.int32), first, token


def weighed(table: pa.Table) -> pa.Table:
    """One row for all: the mean of the values, weighed by ``n``."""
    n = table.column("n").to_numpy().astype(np.float64)
    total = np.zeros(len(table.column("values")[0].as_py()) // 4)
    for weight, row in zip(n / n.sum(), table.column("values")):
        total += weight * np.frombuffer(row.as_py(), np.float32)
    columns = [table.column("part").slice(0, 1), table.column("task").slice(0, 1), pa.array([int(n.sum())], pa.int64()), pa.array([total.astype(np.float32).tobytes()])]
    return pa.Table.from_arrays(columns, ["part", "task", "n", "values"])


def learn_all(training: DataFrame, classes: Classes, model: LogBilinear, total: int, seed: int) -> int:
    """Let tasks go over all training trigrams, each once, and the model take the mean of what they learned.  The number of trigrams.

    A round has some of the texts, by their hash.  Each of its tasks learns at least ``SHARE`` tokens over all rounds, as far as there are so many; so
    vectors are sent for as many trigrams as make them small beside the texts.  They are summed up in two steps, by parts.
    """
    schema = "part int, task int, n long, values binary"
    tasks = max(1, total // SHARE)
    few = max(1, round(tasks**0.5))
    learned_all = 0
    for turn in range(ROUNDS):
        state = model.packed()

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get().partitionId()
            model.unpack(state.copy())
            draw, n = np.random.default_rng([seed, turn, task]), 0
            for part in slices(batches):
                codes = classes.trigrams(*tokens(part.column("text")))
                model.go_over(*split(classes, codes), draw)
                n += len(codes)
            if n:
                for k, values in enumerate(np.array_split(model.packed(), PARTS)):
                    own = [pa.array([k], pa.int32()), pa.array([task % few], pa.int32()), pa.array([n], pa.int64()), pa.array([values.tobytes()])]
                    yield pa.RecordBatch.from_arrays(own, ["part", "task", "n", "values"])

        texts = training.where(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == turn)
        learned = texts.coalesce(tasks).mapInArrow(learn, schema)
        found = learned.groupBy("part", "task").applyInArrow(weighed, schema).groupBy("part").applyInArrow(weighed, schema).toArrow()
        if found.num_rows:
            rows = dict(zip(found.column("part").to_pylist(), found.column("values").to_pylist()))
            model.unpack(np.concatenate([np.frombuffer(rows[k], np.float32) for k in range(PARTS)]))
            learned_all += found.column("n")[0].as_py()
    model.params = {k: v.astype(np.float64) for k, v in model.params.items()}
    return learned_all


def score(docs: DataFrame, vocabulary: int = 4000, local: int = 100_000, size: int = 24, steps: int = 2000, seed: int = 17) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    remainder = fold(docs["doc_id"])
    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), (remainder == 1).alias("held_out"), docs["text"].cast("string").alias("text"))
    training = read.where("not held_out").select("text")
    counts = stored(training.mapInArrow(count_tokens, "token long, c long").groupBy("token").agg(F.sum("c").alias("c")), "tokens")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("c"), "token").limit(local).toArrow()
    hashes, own = top.column("token").to_numpy(), top.column("c").to_numpy()
    if END not in hashes and distinct:
        ends = counts.where(F.col("token") == int(END)).first()["c"]
        hashes, own = np.append(hashes, END), np.append(own, ends)
    classes = Classes(hashes, own, vocabulary, total, distinct)

    rate = min(1.0, steps * BATCH / max(total, 1))

    def trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for part in slices(batches):
            hashes, bounds = tokens(part.column("text"))
            drawn = np.where(part.column("whole").to_numpy(zero_copy_only=False), 1.0, rate)
            codes = classes.trigrams(hashes, bounds)
            yield pa.RecordBatch.from_arrays([pa.array(codes[draw.random(len(codes)) < np.repeat(drawn, np.diff(bounds))], pa.int64())], ["code"])

    # Texts are drawn as wholes, which spares the reading of the others, but trigrams of long texts one by one.
    whole = F.lit(True) if rate == 1 else F.coalesce(F.length("text"), F.lit(0)) <= LONG
    start = training.withColumn("whole", whole)
    if rate < 1:
        start = start.where(~F.col("whole") | (F.rand(seed) < rate))
    second, first, token = split(classes, np.sort(start.mapInArrow(trigrams, "code long").toArrow().column("code").to_numpy()))
    model = LogBilinear(classes.rest + 1, classes.uses, size, seed)
    if len(token):
        model.train(second, first, token, np.ones(len(token), np.int8), steps)
    del second, first, token
    if 0 < rate < 1:
        learn_all(training, classes, model, total, seed)
    # Workers load a broadcast once; as part of the function they would hold its bytes as well.
    scorer = read.sparkSession.sparkContext.broadcast(Scorer(classes, model, total, distinct))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for part in slices(batches):
            found = scorer.value.rows(*tokens(part.column("text")))
            bounds = pa.array(found["bounds"], pa.int32())
            columns = [
                pa.array(np.arange(row, row + part.num_rows), pa.int64()), part.column("doc_id"), part.column("held_out"),
                *(pa.array(found[c], pa.int64()) for c in ("n_tokens", "n_known")), *(pa.array(found[c], pa.float64()) for c in ("base", "score")),
                *(pa.ListArray.from_arrays(bounds, pa.array(found[c], pa.int64())) for c in ("words", "times")),
            ]
            row += part.num_rows
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in LOCAL.split(", ")])

    rows = stored(read.mapInArrow(run, LOCAL), "scores")
    scorer.destroy()
    far = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("t")).select("row", F.col("t.words").alias("token"), F.col("t.times").alias("times"))
    met = far.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("logs"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("known"),
    )
    joined = rows.drop("words", "times").join(met, "row", "left").fillna(0, ["logs", "known"])
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("known")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("logs")).alias("base_score"), (F.col("score") + F.col("logs")).alias("score"),
    )
