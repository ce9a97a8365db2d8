"""URL filter: host and path rules, then gradient-boosted trees on lexical features.

Rules (host, path) fit their host and its subdomains where the path starts with theirs; the longest wins.  The urls that rules decide
are the labelled ones: the trees learn from them and judge all others.  Features: lengths, depth, shares of digits and of marks, character
entropy, labels of the host, parameters, and what share of its suffix was blocked.

The trees are fitted on at most about ``sample`` labelled urls, half of each class if there are as many, taken by the hash of the url; a url that
repeats counts once, and weights restore the proportions.  The shares of suffixes come from all labelled
urls, each counted once, and meet the urls by a join.  Rules and scores cover all urls.

Cases: a null url, and one without ``://``, has an empty host and path, fits no rule and is judged by its other features.  Null and
repeated ids and rows do not matter, each row is judged alone.  If the rules give one verdict only, or none, all others are allowed.  An empty
table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import join_groups, stored

RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
FEATURES = ["length", "host_length", "path_length", "depth", "labels", "digit_ratio", "mark_ratio", "entropy", "parameters", "fragment", "suffix_blocked"]
SEED = 17


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase), path


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null if none does."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, own, start in reversed(ordered):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        rule = F.when(fits, F.lit(own + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits per ASCII letter, digit or mark, from the counts of each."""
    size = F.greatest(F.length(text), F.lit(1))
    total = F.lit(0.0)
    for char in string.ascii_lowercase + string.digits + "-_./?=&%#":
        share = (F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))) / size
        total = total - F.when(share > 0, share * F.log2(share)).otherwise(0.0)
    return total


def features(urls: DataFrame) -> DataFrame:
    """Lexical features of ``url, host, path``; all that does not need other rows."""
    url = F.coalesce("url", F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return urls.withColumns(
        {
            "length": F.length(url).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "depth": F.regexp_count("path", F.lit("/")).cast("double"),
            "labels": F.regexp_count("host", F.lit(r"[^.]+")).cast("double"),
            "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / size,
            "mark_ratio": F.regexp_count(url, F.lit("[^0-9A-Za-z]")) / size,
            "entropy": entropy(F.lower(url)),
            "parameters": F.when(query == "", 0.0).otherwise(F.regexp_count(query, F.lit("&")) + 1.0),
            "fragment": F.contains(url, F.lit("#")).cast("double"),
        }
    )


def suffix_shares(labelled: DataFrame, others: DataFrame, prior: float) -> DataFrame:
    """What share of each suffix was blocked, over all its different labelled urls: ``suffix, suffix_blocked, judged``.

    ``judged`` is the number of rows of ``others`` with the suffix.
    """
    once = labelled.select("suffix", "url", "label").distinct()
    each = once.select("suffix", F.lit(1).alias("ruled"), "label", F.lit(0).alias("other"))
    each = each.unionByName(others.select("suffix", F.lit(0).alias("ruled"), F.lit(0.0).alias("label"), F.lit(1).alias("other")))
    ruled = F.sum("ruled")
    share = F.when(ruled > 0, (F.sum("label") + 20 * prior) / (ruled + 20)).otherwise(F.lit(prior))
    return each.groupBy("suffix").agg(share.alias("suffix_blocked"), F.sum("other").alias("judged"))


def quotas(sizes: dict[float, int], sample: int) -> dict[float, int]:
    """How many urls of each class are fitted: half of the sample, or what a smaller class leaves."""
    half = max(1, sample // 2)
    least = min(min(sizes.values()), half)
    return {label: min(n, max(half, sample - least)) for label, n in sizes.items()}


def last_hash(quota: int, n: int, least: int) -> int:
    """The largest hash that is drawn, for about ``quota`` of ``n`` urls and at least the one with the ``least`` hash."""
    return 2**63 - 1 if quota >= n else max(least, quota * 2**64 // n - 2**63 - 1)


def judge(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, sample: int = 20_000, rounds: int = 12) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, blocked`` (the trees' probability, null where a rule decides)."""
    own = pages.select(pages["page_id"].alias("page_id"), pages["url"].cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    urls = own.withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = urls.withColumns({"rule": rule, "says": verdict, "suffix": F.substring_index("host", ".", -2)})
    labelled = urls.where("says is not null").withColumn("label", (F.col("says") == "block").cast("double"))
    # Equal urls share a label; those that repeat count once.
    once = labelled.groupBy("label", "url").agg(F.count(F.lit(1)).alias("rows")).withColumn("hash", F.xxhash64("url"))
    found = once.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias("least")).collect()
    sizes = {r["label"]: r["n"] for r in found}
    result = ["page_id", "host", "path", "rule"]
    if len(sizes) < 2:
        return urls.select(*result, F.coalesce("says", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("blocked"))
    quota = quotas(sizes, sample)
    drawn = [(F.col("label") == r["label"]) & (F.xxhash64("url") <= F.lit(last_hash(quota[r["label"]], r["n"], r["least"]))) for r in found]
    taken = labelled.where(drawn[0] | drawn[1]).dropDuplicates(["url"])
    # A class that was drawn more thinly counts more.
    weight = F.when(F.col("label") == 1.0, F.lit(sizes[1.0] / quota[1.0])).otherwise(F.lit(sizes[0.0] / quota[0.0]))
    taken = stored(features(taken).withColumn("weight", weight), "urls")
    prior = sizes[1.0] / sum(sizes.values())
    others = urls.where("says is null")
    suffixes = stored(suffix_shares(labelled, others, prior), "suffixes")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees = GBTClassifier(maxIter=rounds, maxDepth=3, stepSize=0.3, maxBins=32, seed=SEED, cacheNodeIds=False, weightCol="weight")
    fitted = assembler.transform(taken.join(suffixes, "suffix"))
    model = trees.fit(fitted.select("features", "label", "weight").repartition(4))
    met = join_groups(others, suffixes.where("judged > 0"), ["suffix"], "judged", "inner")
    rest = model.transform(assembler.transform(features(met)))
    blocked = vector_to_array("probability")[1]
    judged = rest.select(*result, F.when(blocked >= 0.5, "block").otherwise("allow").alias("verdict"), blocked.alias("blocked"))
    ruled = urls.where("says is not null").select(*result, F.col("says").alias("verdict"), F.lit(None).cast("double").alias("blocked"))
    return ruled.unionByName(judged)
