"""Mixing sources to target weights by blocks, in built-in expressions only.

Each source is one stream of words: its documents follow one another, by bucket and id.  The stream is cut into blocks of a
fixed length, the last one shorter.  A source's target is its weight's share of all words; it stops at ``most`` times its size, and what is
over is shared again by weight.  Its slots, one for each block to take, are drawn to output shards: the counts of a
shard are multinomial given the totals, which hold exactly.  A source's slots are numbered through all shards, and a
pseudorandom permutation of its block numbers for each pass over the source says which block a slot holds.  Blocks are joined by
that number.  All draws are hashes of a seed, so reruns agree.

Cases: null and blank texts have no words and are never taken; a null source is a source of its own, the last one.
Rows that repeat are documents of their own; null ids come first in their bucket.  Long documents have many blocks.  An empty table gives an
empty mix.  Columns besides ``doc_id``, ``text`` and ``source`` stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.llm.common import join_groups, stored, word_count, words

BUCKET_DOCS = 4096  # about so many documents are put in order by one task
SHARD_SLOTS = 8192  # mean number of blocks in an output shard
CHUNK_SLOTS = 1 << 13  # slots that one row draws for
TASK_SLOTS = 1 << 14  # slots that one task lists
ROUNDS = 24


def permuted(index: Column, size: Column, *seed: Column) -> Column:
    """A pseudorandom permutation of 0 .. size-1 for each seed: swap-or-not rounds, in which each number either stays or
    changes places with its mirror image about a random point."""

    def step(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(F.lit("pivot"), r, *seed), size) - x, size)
        swap = F.pmod(F.xxhash64(F.lit("swap"), r, F.greatest(x, mirror), *seed), F.lit(2)) == 1
        return F.when(swap, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), step)


def targets(sources: DataFrame, weights: tuple[int, ...], most: float) -> DataFrame:
    """Sources in code-point order, null last, with ``number, weight, target``.

    Sources whose limit is smallest for their weight reach it first; the first that does not gives the rate
    at which all others are served.
    """
    order = W.orderBy(F.col("source_key.missing"), F.col("source_key.name"))
    number = F.row_number().over(order)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(number - 1, F.lit(len(weights))) + 1).cast("int"))
    limit = F.col("source_size") * most
    sources = sources.select("*", number.alias("number"), weight.alias("weight"), limit.alias("limit"))
    by_rate = W.orderBy(F.col("limit") / F.col("weight"), "number")
    below = F.coalesce(F.sum("limit").over(by_rate.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_rate.rowsBetween(0, W.unboundedFollowing))
    total = F.sum("source_size").over(by_rate.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    sources = sources.withColumn("rate", (total - below) / left)
    open_rate = F.when(F.col("rate") * F.col("weight") <= F.col("limit"), F.col("rate"))
    whole = by_rate.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rate = F.coalesce(F.first(open_rate, ignorenulls=True).over(whole), F.lit(float("inf")))
    return sources.withColumn("target", F.least(F.col("limit"), rate * F.col("weight"))).drop("rate", "limit")


def placed(docs: DataFrame, weights: tuple[int, ...], most: float) -> tuple[DataFrame, DataFrame]:
    """Documents with their place in their source's stream, and the sources."""
    key = F.struct(docs["source"].isNull().alias("missing"), F.coalesce(docs["source"], F.lit("")).alias("name"))
    rows = docs.select(
        docs["doc_id"].alias("doc_id"),
        F.xxhash64(docs["text"]).alias("text_hash"),
        key.alias("source_key"),
        word_count(docs["text"]).alias("size"),
    )
    rows = stored(rows, "sizes")
    sources = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    sources = stored(targets(sources, weights, most), "sources")
    total = sources.agg(F.sum("docs")).first()[0] or 0
    bucket = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(total // BUCKET_DOCS + 1))
    rows = join_groups(rows, sources.select("source_key", "number", "docs"), ["source_key"], "docs", "inner")
    rows = rows.select("doc_id", "text_hash", "size", "number", bucket.alias("bucket"))
    order = W.partitionBy("number", "bucket").orderBy("doc_id", "text_hash", "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = stored(rows.select("*", F.row_number().over(order).alias("turn"), before.alias("before")), "places")
    buckets = rows.groupBy("number", "bucket").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    each = W.partitionBy("number").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = buckets.select("number", "bucket", F.coalesce(F.sum("words").over(each), F.lit(0)).alias("base"))
    rows = rows.join(buckets, ["number", "bucket"]).withColumn("start", F.col("base") + F.col("before"))
    return stored(rows.drop("base", "before"), "starts"), sources


def block_uses(sources: DataFrame, block: int, seed: int) -> DataFrame:
    """The slots of the mix: ``number, pass, index, shard``, one row for each block taken."""
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    passes = F.floor(F.col("target") / F.col("source_size")).cast("long")
    part = F.col("target") - F.col("passes") * F.col("source_size")
    part = F.least(F.round(part / block).cast("long"), F.col("blocks"))
    quota = (
        sources.where("source_size > 0")
        .withColumn("blocks", blocks)
        .withColumn("passes", passes)
        .withColumn("slots", F.col("passes") * F.col("blocks") + part)
        .where("slots > 0")
        .select("number", "blocks", "slots")
    )
    total = quota.agg(F.sum("slots")).first()[0] or 0
    shards = -(-total // SHARD_SLOTS) or 1
    # So many tasks list the slots; a number of their own, as the rows they come from are too few to be spread by size.
    tasks = total // TASK_SLOTS + 1
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK_SLOTS)))
    chunks = quota.withColumn("chunk", chunk).repartition(tasks, "number", "chunk")
    first = F.col("chunk") * CHUNK_SLOTS
    drawn = chunks.withColumn("draw", F.explode(F.sequence(first, F.least(first + CHUNK_SLOTS, F.col("slots")) - 1)))
    shard = F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "number", "draw"), F.lit(shards))
    counts = drawn.groupBy("number", "blocks", shard.alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("number").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    slot = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1))
    slots = counts.repartition(tasks, "number", "shard").withColumn("slot", slot)
    slots = slots.select("number", "shard", "blocks", F.floor(F.col("slot") / F.col("blocks")).alias("pass"), "slot")
    index = permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("number"), F.col("pass"))
    return slots.select("number", "pass", index.alias("index"), "shard")


def pieces(docs: DataFrame, weights: tuple[int, ...], most: float, block: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Places, sources, and what each taken block holds of each document: a row per document, pass and block."""
    places, sources = placed(docs, weights, most)
    uses = block_uses(sources, block, seed)
    index = F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)))
    spans = places.where("size > 0").withColumn("index", index)
    low = F.greatest(F.lit(0).cast("long"), F.col("index") * block - F.col("start"))
    high = F.least(F.col("size"), (F.col("index") + 1) * block - F.col("start"))
    spans = spans.select("number", "index", "bucket", "turn", low.alias("low"), (high - low).alias("length"))
    # The uses grow with the words; their size before the slots are listed would pass for small.
    return places, sources, spans.join(uses.hint("merge"), ["number", "index"])


def taken(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, block: int = 128, seed: int = 7
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``, and in how many output ``shards`` its blocks are."""
    places, sources, parts = pieces(docs, weights, most, block, seed)
    sums = parts.groupBy("number", "bucket", "turn").agg(F.sum("length").alias("taken"), F.size(F.collect_set("shard")).alias("shards"))
    rows = places.join(sums, ["number", "bucket", "turn"], "left")
    rows = join_groups(
        rows.select("doc_id", "size", "number", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("taken", "shards")]),
        sources.select("number", "docs", "source_size", "target"),
        ["number"],
        "docs",
        "inner",
    )
    return rows.select("doc_id", "size", "source_size", "target", "taken", "shards")


def shard_counts(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, block: int = 128, seed: int = 7
) -> DataFrame:
    """The multinomial counts: how many blocks of each source an output shard takes, ``shard, number, blocks``."""
    _, sources = placed(docs, weights, most)
    return block_uses(sources, block, seed).groupBy("shard", "number").agg(F.count(F.lit(1)).alias("blocks"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, block: int = 128, seed: int = 7
) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: a row for each pass that takes of a document.

    Where a pass takes all of a document its text is unchanged, else the words it takes, joined by blanks.
    """
    places, _, parts = pieces(docs, weights, most, block, seed)
    found = parts.groupBy("number", "bucket", "turn", "pass").agg(
        F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("low", "length"))).alias("spans")
    )
    found = found.join(places, ["number", "bucket", "turn"])
    some = F.when(F.col("length") < F.col("size"), F.col("spans"))
    found = found.groupBy("doc_id", "text_hash", "size").agg(F.collect_list(F.struct("pass", some.alias("spans"))).alias("takes"))
    found = stored(found.withColumnRenamed("doc_id", "take_id").withColumnRenamed("size", "take_size"), "takes")
    own = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["doc_id"].alias("doc_id"),
        F.xxhash64(docs["text"]).alias("hash"),
        word_count(docs["text"]).alias("words"),
    )
    repeated = places.groupBy("doc_id", "text_hash", "size").count().where("count > 1 and size > 0")
    if not repeated.isEmpty():  # the passes of repeated rows are listed together
        own = own.dropDuplicates(["doc_id", "hash", "words"])
    same = F.col("doc_id").eqNullSafe(F.col("take_id")) & (F.col("hash") == F.col("text_hash")) & (F.col("words") == F.col("take_size"))
    rows = own.join(found, same).select("row", F.explode("takes").alias("take"))
    rows = rows.withColumn("own", F.when(F.col("take.spans").isNotNull(), words(F.col("row.text"))))
    cut = F.transform("take.spans", lambda s: F.slice("own", (s["low"] + 1).cast("int"), s["length"].cast("int")))
    text = F.when(F.col("take.spans").isNull(), F.col("row.text")).otherwise(F.array_join(F.flatten(cut), " "))
    rows = rows.withColumn("new_text", text)
    now = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    return rows.select(*[now.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
