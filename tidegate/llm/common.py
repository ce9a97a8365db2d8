"""Helpers that several operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.storage import scratch_folder

# White space that separates words: blank, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back.

    It cuts the lineage: what was written outlives the executors that wrote it.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete what ``stored`` wrote, once nothing reads it any more: what came of it has to be stored itself."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def words(text: Column) -> Column:
    """The words of a text in order; none for null, empty or blank texts."""
    stripped = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, f"{SPACE}+"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, how: str = "left", most: int = 1000) -> DataFrame:
    """Join every row with the one row of its group without gathering a large group in one task.

    ``groups`` has one row for each key and, in ``size``, the number of ``rows`` with that key.
    Keys with over 1/``most`` of all rows are at most ``most``: these are broadcast, the others meet
    by an ordinary shuffle.  ``groups`` is read twice, so it should be stored.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    large = F.col(size) * most > F.lit(total)
    others = [c for c in groups.columns if c not in keys]
    hot = groups.where(large).select(*keys, F.struct(*others).alias("_hot"))
    rest = groups.where(~large).select(*keys, F.struct(*others).alias("_rest"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    met = marked.where("_hot is not null").select(*rows.columns, *[F.col(f"_hot.{c}").alias(c) for c in others])
    cold = marked.where("_hot is null").drop("_hot").join(rest, keys, how)
    return met.unionByName(cold.select(*rows.columns, *[F.col(f"_rest.{c}").alias(c) for c in others]))


class Bitmap:
    """A set of 64-bit hashes by their upper bits: says no only for those not in it."""

    def __init__(self, flags: np.ndarray, bits: int) -> None:
        self.flags, self.bits = flags, bits

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        index = hashes >> np.uint64(64 - self.bits)
        return (self.flags[(index >> np.uint64(3)).astype(np.int64)] >> (index & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(found: DataFrame, column: str) -> Bitmap:
    """The 64-bit hashes of a column, with sixteen bits or more for each, from 2**20 to 2**28 in all: at most 32 MB, whatever the input."""
    bits = min(28, max(20, math.ceil(math.log2(16 * max(1, found.count())))))
    index = F.shiftrightunsigned(column, 64 - bits) + 1
    parts = found.groupBy(F.bitmap_bucket_number(index).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(index)).alias("flags"))
    flags = np.zeros((1 << bits) // 8, np.uint8)
    for row in parts.collect():  # at most 2**28 bits
        own = np.frombuffer(row["flags"], np.uint8)
        flags[(row["part"] - 1) * len(own) : row["part"] * len(own)] = own
    return Bitmap(flags, bits)


# --- inside tasks -------------------------------------------------------------------------------

SLICE_BYTES = 6_000_000


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with some megabytes of text each (one longer text is a part of its own)."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            # A copy: some string kernels misread arrays whose buffers do not start at their first row.
            yield batch.take(pa.array(np.arange(start, stop)))
            start = stop
        # Workers live on between tasks; what one holds in reserve is missing to the others of its executor.
        pa.default_memory_pool().release_unused()


class Words:
    """The words of a slice of texts: ``codes`` into ``vocabulary``, and ``bounds`` of each text's words."""

    def __init__(self, texts: pa.Array, lower: bool = False) -> None:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if lower:
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        empty = pc.equal(flat, "")
        if pc.any(empty).as_py():  # the one empty word of a text without words
            drop = empty.to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(counts)), counts)
            counts = np.bincount(owner[~drop], minlength=len(counts))
            flat = flat.filter(pc.invert(empty))
        coded = flat.dictionary_encode()
        self.vocabulary: pa.Array = coded.dictionary
        self.codes: np.ndarray = coded.indices.to_numpy(zero_copy_only=False)
        self.bounds: np.ndarray = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        own = self.vocabulary.cast(pa.large_binary()).to_pylist()
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter((digest(w) for w in own), np.uint64, len(own))[self.codes] if own else np.empty(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finisher)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(numbers: np.ndarray) -> np.ndarray:
    """The different numbers in order; for many of them sorting is far quicker than ``np.unique``."""
    numbers = np.sort(numbers)
    new = np.ones(len(numbers), bool)
    np.not_equal(numbers[1:], numbers[:-1], out=new[1:])
    return numbers[new]
