"""Exact deduplication by digest, with frequent digests split off.

A Misra-Gries summary (Spark's mergeable frequent-items sketch) of all digests names the few that may be
frequent.  For these, an exact aggregation finds sizes and winners; at most ``tracked`` winners are
broadcast and settle their copies where they are read.  All other digests take an ordinary shuffle.  To
decide, only ids and digests are shuffled, never texts.

Cases: a null text counts as empty, so all null and empty texts are one group; white space differs in
nothing but its presence.  Of equal texts the row with the smallest id stays, null ids come last.  Of rows
that repeat both id and text one stays.  An empty table gives an empty result.  Other columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import SPACE, stored


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def frequent(rows: DataFrame, tracked: int) -> DataFrame:
    """Hashes of digests that may be frequent, at most ``tracked / 4``.

    The sketch keeps every digest with over a few times 1/``tracked`` of all rows; what it names besides
    costs nothing but its place.
    """
    top = rows.agg(F.expr(f"approx_top_k(xxhash64(digest), {tracked // 4}, {tracked})").alias("top"))
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("item"))


def group_rows(docs: DataFrame, tracked: int = 4096) -> tuple[DataFrame, DataFrame]:
    """The groups of equal texts: one row per (id, text), and the winners of frequent digests.

    Rows: ``doc_id, digest, n`` (rows with this id and text), ``keep_id, group_size`` (rows of the whole group).
    """
    read = docs.select(docs["doc_id"].alias("doc_id"), digest(docs["text"]).alias("digest"))
    rows = stored(read.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")), "digests")
    winner = [F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size")]
    named = rows.join(F.broadcast(frequent(rows, tracked)), F.xxhash64("digest") == F.col("item"), "left_semi")
    hot = stored(named.groupBy("digest").agg(*winner), "winners")
    marked = rows.join(F.broadcast(hot.select("digest", F.struct("keep_id", "group_size").alias("hot"))), "digest", "left")
    settled = marked.where("hot is not null").select("doc_id", "digest", "n", "hot.keep_id", "hot.group_size")
    rest = marked.where("hot is null").select("doc_id", "digest", "n")
    met = rest.join(rest.groupBy("digest").agg(*winner), "digest")
    return settled.unionByName(met.select(*settled.columns)), hot


def groups(docs: DataFrame, tracked: int = 4096) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, digest, keep_id, group_size, kept``."""
    rows, _ = group_rows(docs, tracked)
    first = (F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).select(
        "doc_id", "digest", "keep_id", "group_size", first.alias("kept")
    )


def deduplicate(docs: DataFrame, tracked: int = 4096) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Copies of frequent texts go where they are read; of the rest one row each passes a join with the winners.
    """
    rows, hot = group_rows(docs, tracked)
    stay = stored(rows.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "digest", "n"), "stay")
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].alias("doc_id"), digest(docs["text"]).alias("digest"))
    hot = hot.select(F.col("digest").alias("hot_digest"), F.struct("keep_id").alias("hot"))
    own = own.join(F.broadcast(hot), F.col("digest") == F.col("hot_digest"), "left")
    own = own.where(F.col("hot").isNull() | F.col("doc_id").eqNullSafe(F.col("hot.keep_id"))).select("row", "doc_id", "digest")

    def among(kept: DataFrame) -> DataFrame:
        kept = kept.select(F.col("doc_id").alias("stay_id"), F.col("digest").alias("stay_digest"))
        same = F.col("doc_id").eqNullSafe(F.col("stay_id")) & (F.col("digest") == F.col("stay_digest"))
        return own.join(kept, same, "left_semi")

    once = among(stay.where("n = 1"))
    if stay.where("n > 1").isEmpty():
        return once.select("row.*")
    return once.unionByName(among(stay.where("n > 1")).dropDuplicates(["doc_id", "digest"])).select("row.*")
