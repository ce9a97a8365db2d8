"""Line-first cleaning of texts by quality rules, in built-in expressions only.

Each line that has a word is judged by itself:

* punctuation: it fails without the end of a sentence, or with more than 3 noise marks for 10 words;
* navigation: it fails if a fifth of its words, two at least, are separators, or if it is a short line of menu words;
* boilerplate: it fails if it is short and holds a stock phrase of page footers and notices.

Lines that fail are removed, blank lines stay.  A document goes that loses more than ``max_lost`` of its words this way,
that has under ``min_words`` words, or of which more than ``max_repeated`` lies in word windows that the text repeats.

Cases: null, empty and blank texts have no words and go.  Very long texts stay within their row: time grows
with their length, and once more by its logarithm where they repeat windows.  Null and repeated ids, repeated
rows and further columns do not matter, each row is judged alone.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import WORD, words

SYMBOLS = "#*$%&|<>"
SENTENCE_END = r"[.!?:;…。！？][\"')\]»”’]*([\x20\x09-\x0D]|$)"
NOISE = r"[#*$%&|<>~^=_{}\\]|!!|\?\?"
SEPARATOR = r"(^|[\x20\x09])([|>»›•·→/]|::|--)([\x20\x09]|$)"
MENU = (
    r"^[^a-z]*(home|menu|login|log in|sign in|sign up|register|search|contact|contact us|about|about us|next|previous|"
    r"back|top|help|sitemap|site map|skip to content|share|tweet|print|email|rss|faq|news|blog|cart|checkout|download)[^a-z]*$"
)
BOILERPLATE = (
    r"all rights reserved|privacy policy|cookie policy|uses cookies|accept cookies|terms of (use|service)|terms and conditions|"
    r"enable javascript|javascript is disabled|click here|read more|subscribe to|sign up for|share this|follow us|powered by|"
    r"lorem ipsum|copyright ©|© [0-9]{4}"
)
SHORT_LINE = 25


def line_fails(line: Column) -> Column:
    """Whether a line that has a word fails one of the rules."""
    n = F.regexp_count(line, F.lit(WORD))
    ends = line.rlike(SENTENCE_END)
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    low = F.lower(line)
    punctuation = ~ends | (F.regexp_count(line, F.lit(NOISE)) * 10 > n * 3)
    navigation = ((separators >= 2) & (separators * 5 >= n)) | ((n <= 4) & low.rlike(MENU))
    boilerplate = (n <= SHORT_LINE) & low.rlike(BOILERPLATE)
    return punctuation | navigation | boilerplate


def repeated_words(own: Column, width: int) -> Column:
    """The number of words in windows of ``width`` words that occur twice or more in the array ``own``.

    Windows are compared by a 64-bit hash, within one text.
    """

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        bound = F.transform(F.array(placed), repeats)
        return F.transform(bound, span)[0]

    def repeats(s: Column) -> Column:
        same = F.filter(
            s,
            lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def span(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def hashes(o: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(o) - width + 1), lambda i: F.xxhash64(F.slice(o, i, F.lit(width)))
        )

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0)

    # Arrays of one element bind a value, so that it is computed once and not for every element of another array.
    each = F.transform(F.transform(F.array(own), hashes), counted)[0]
    return F.when(F.size(own) <= width, 0).otherwise(each).cast("long")


def judge(
    docs: DataFrame,
    min_words: int = 20,
    window: int = 8,
    max_repeated: float = 0.3,
    max_lost: float = 0.5,
) -> DataFrame:
    """All rows and columns of ``docs`` as ``row``, with counts, the verdict and the text that is left.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_words, base_failed, kept, cleaned``.
    """
    has_word = lambda line: line.rlike(WORD)
    text = F.coalesce(docs["text"], F.lit(""))
    read = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), text.alias("text"), words(docs["text"]).alias("own"))
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(
            line.alias("line"), has_word(line).alias("says"), (has_word(line) & line_fails(line)).alias("fails")
        ),
    )
    read = read.withColumn("lines", lines)
    said = F.transform(F.filter("lines", lambda x: x["says"]), lambda x: x["line"])
    lost = F.aggregate(
        F.filter("lines", lambda x: x["fails"]),
        F.lit(0).cast("long"),
        lambda a, x: a + F.regexp_count(x["line"], F.lit(WORD)),
    )
    counts = (
        F.size("own").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.transform(F.array(said), lambda s: F.size(s) - F.size(F.array_distinct(s)))[0].cast("long").alias("n_dup_lines"),
        repeated_words(F.col("own"), window).alias("n_repeat_words"),
        lost.alias("lost_words"),
        F.array_join(F.transform(F.filter("lines", lambda x: ~x["fails"]), lambda x: x["line"]), "\n").alias("cleaned"),
    )
    # A filter on the verdict would be pushed below a projection, and all counts be made twice; not so through a generator.
    counted = read.select("row", F.explode(F.array(F.struct(*counts))).alias("counts")).select("row", "counts.*")
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > round(100 * max_repeated) * F.col("n_words"))
    keeps = 100 * F.col("lost_words") <= round(100 * max_lost) * F.col("n_words")
    return counted.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & keeps)


def clean(docs: DataFrame, **rules: float) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; lines that failed are gone from their texts.

    A column ``n_chars`` follows the text.
    """
    judged = judge(docs, **rules).where("kept")
    text = F.when(F.col("lost_words") > 0, F.col("cleaned")).otherwise(F.col("row.text"))
    now = {"text": text}
    if "n_chars" in docs.columns:
        now["n_chars"] = F.when(F.col("lost_words") > 0, F.length("cleaned").cast("long")).otherwise(F.col("row.n_chars"))
    return judged.select(*[now.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
