from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from tidegate.llm import classifier, exact, jaccard, lm, mixing, packing, quality, substring, urls, warc

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def rows():
    return brute.rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, brute.SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], brute.SCHEMA)


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


# 1 -----------------------------------------------------------------------------------------------


def test_quality_counts(docs, rows):
    found = Counter((r["row"]["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"]) for r in quality.judge(docs).collect())
    want = Counter((r[0], len(w := brute.words(r[1])), sum(map(len, w)), sum(c in "#*$%&|<>" for c in r[1] or "")) for r in rows)
    assert found == want


def test_quality_lines(spark):
    good = "This is a line of plain words that says something and ends.\n" * 1 + "Here is another line that is quite as plain as the one before."
    texts = [good, f"Home | News | Contact | Login\n{good}", "Click here to read more\n" * 9 + "a b c.", "word " * 30, None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in quality.clean(frame).collect()}
    assert kept == {0: good, 1: good}


def test_quality_empty(none):
    assert quality.clean(none).columns == none.columns
    assert quality.clean(none).count() == 0


# 2 -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_jaccard(docs, rows, width, percent):
    sets = {r[0]: brute.shingles(r[1], width) for r in rows if r[0] is not None}
    want = brute.components(sets, percent)
    found = jaccard.similar(docs, width, percent / 100).where("doc_id is not null").collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found} == {(i, len(sets[i]), c) for i, c in want.items()}
    assert len(found) == len(rows) - 1


def test_jaccard_keeps_one(docs, rows):
    want = brute.components({r[0]: brute.shingles(r[1], 5) for r in rows if r[0] is not None}, 80)
    stay = jaccard.distinct_documents(docs)
    assert stay.columns == docs.columns
    assert {r["doc_id"] for r in stay.collect()} - {None} == set(want.values())


def test_jaccard_keeps_one_whatever_the_ids(spark):
    base = [[f"{g}w{k}" for k in range(60)] for g in range(6)]
    near = lambda g, k: " ".join(base[g][:-1] + [f"other{k}"])
    texts = [(g, " ".join(base[g])) for g in range(6)]
    rows = [
        (None, texts[0][1]), (None, near(0, 1)), (None, near(0, 2)),  # null ids only
        (7, texts[1][1]), (None, near(1, 1)), (None, near(1, 1)),  # an id and null ids
        (5, texts[2][1]), (9, near(2, 1)), (3, texts[3][1]), (5, near(3, 1)),  # 5 names one component and belongs to another
        (5, near(2, 3)),  # and it is twice in its own
        (11, texts[4][1]), (11, texts[4][1]),  # a repeated row
        (None, texts[5][1]), (None, texts[5][1]), (None, texts[5][1]),
        (20, ""), (20, ""), (20, None), (20, " "), (21, None), (None, ""), (None, ""), (None, None),  # without words
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = [tuple(r) for r in jaccard.distinct_documents(frame).collect()]
    groups = Counter((t.split("w")[0], i) for i, t in found if t and t.strip())
    assert groups == Counter({("0", None): 1, ("1", 7): 1, ("2", 5): 1, ("3", 3): 1, ("4", 11): 1, ("5", None): 1})
    blank = Counter((i, t or "") for i, t in found if not (t and t.strip()))
    assert blank == Counter({(20, ""): 1, (20, " "): 1, (21, ""): 1, (None, ""): 3})
    again = [tuple(r) for r in jaccard.distinct_documents(frame.repartition(2)).collect()]
    assert {r for r in again if r[1]} == {r for r in found if r[1]}


def test_jaccard_empty(none):
    assert jaccard.similar(none).count() == 0


# 3 -----------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, payload string, sha1 string, n long"


def page_rows():
    long = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 20_000
    texts = ["<html>a</html>", None, "", "same", "same", "same", long, long, "0\r\n\r\n", "x" * 65536]
    pages = [(k, f"http://a.example/{k}\n x", t, "p", None, k) for k, t in enumerate(texts)]
    return [*pages, (None, None, "same", None, None, None), (None, None, "alone", None, None, None)]


def test_warc_round_trip(spark):
    pages = page_rows()
    most = defaultdict(lambda: -1)
    for p in pages:
        most[p[2] or ""] = max(most[p[2] or ""], -1 if p[0] is None else p[0])
    want = []
    for p in pages:
        payload = (p[2] or "").encode()
        own = most[p[2] or ""] in (-1, p[0])
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want.append((p[0], len(payload), digest, "response" if own else "revisit", None if own else most[p[2] or ""]))
    found = warc.round_trip(spark.createDataFrame(pages, PAGES)).collect()
    assert by_id(map(tuple, found)) == by_id(want)


def test_warc_segments(spark, folder):
    pages = spark.createDataFrame(page_rows(), PAGES)
    warc.write(pages, f"{folder}/w", segment=1000, records=50)
    found = warc.read(spark, f"{folder}/w").where("record_type = 'response'").collect()
    assert {bytes(r["payload"]) for r in found} == {(p[2] or "").encode() for p in page_rows()}
    kinds = warc.read_records(spark, f"{folder}/w").groupBy("type").count().collect()
    assert dict(map(tuple, kinds))["continuation"] > 400


def test_warc_repeated_rows(spark):
    found = warc.round_trip(spark.createDataFrame([(1, "u", "x"), (1, "u", "x"), (0, "u", "x")], "page_id long, url string, html string"))
    assert by_id(map(tuple, found.select("page_id", "record_type", "refers_to").collect())) == [(0, "revisit", 1), (1, "response", None), (1, "response", None)]


def test_warc_framing():
    for payload in (b"", b"a", b"0\r\n\r\n" * 9000):
        assert warc.unchunked(warc.chunked(payload)) == payload
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: z\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"2\r\nabc\r\n0\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 1\r\n\r\nab\r\n\r\n"))


def test_warc_missing_segment(spark, folder):
    text = warc.record({"WARC-Type": "response", "WARC-Record-ID": "a", "WARC-Segment-Number": 1}, warc.HTTP + b"0") + b"\r\n\r\n"
    text += warc.record({"WARC-Type": "continuation", "WARC-Record-ID": "b", "WARC-Segment-Origin-ID": "a", "WARC-Segment-Number": 3}, b"x") + b"\r\n\r\n"
    with open(f"{folder}/one.warc", "wb") as out:
        out.write(text)
    with pytest.raises(Exception, match="segments of a are missing"):
        warc.read(spark, folder).collect()


def test_warc_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


# 4 -----------------------------------------------------------------------------------------------


def test_mixing(docs, rows):
    found = mixing.taken(docs).collect()
    again = mixing.taken(docs.repartition(5)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((r[0], len(brute.words(r[1]))) for r in rows)
    source = {r[0]: r[3] for r in rows}
    totals, target = Counter(), {}
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"]
        totals[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert all(abs(totals[s] - t) <= 128 + 0.02 * t for s, t in target.items())


def test_mixing_targets(docs, rows):
    """Sizes, and targets by filling all sources at one rate until their limits."""
    size = Counter()
    for r in rows:
        size[r[3]] += len(brute.words(r[1]))
    sources = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(sources)}
    target, left, full = {}, float(sum(size.values())), set()
    while True:
        rate = left / sum(weight[s] for s in sources if s not in full)
        over = {s for s in sources if s not in full and rate * weight[s] > 3 * size[s]}
        if not over:
            break
        full |= over
        left -= sum(3 * size[s] for s in over)
    target = {s: 3 * size[s] if s in full else rate * weight[s] for s in sources}
    source = {r[0]: r[3] for r in rows}
    for r in mixing.taken(docs).collect():
        assert r["source_size"] == size[source[r["doc_id"]]]
        assert math.isclose(r["target"], target[source[r["doc_id"]]], rel_tol=1e-9, abs_tol=1e-6)


def test_mixing_shards(docs, monkeypatch):
    """Every block taken lies in a shard, the draw decides in which; no task lists more than its share of the slots."""
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 8)
    monkeypatch.setattr(mixing, "TASK_SLOTS", 16)
    monkeypatch.setattr(mixing, "CHUNK_SLOTS", 4)
    counts = mixing.shard_counts(docs, block=16)
    slots = sum(r["blocks"] for r in counts.collect())
    shards = -(-slots // 8)
    found = counts.groupBy("shard").agg(F.sum("blocks").alias("n")).collect()
    assert {r["shard"] for r in found} <= set(range(shards)) and len(found) > shards / 2
    assert max(r["n"] for r in found) < 40  # about 8 each
    _, sources = mixing.placed(docs, (1, 2, 3), 3.0)
    uses = mixing.block_uses(sources, 16, 7)
    parts = uses.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 4 and max(r["count"] for r in parts) < slots / 4
    assert all((r["shards"] > 0) == (r["taken"] > 0) for r in mixing.taken(docs, block=16).collect())


def test_mixing_null_ids(spark):
    """A third of the rows has no id; they are put in order by many tasks."""
    rows = [(None if k % 3 == 0 else k, f"w{k} " * (k % 40), f"s{k % 2}") for k in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.taken(frame).collect()
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((d, len(t.split())) for d, t, _ in rows)
    assert Counter(map(tuple, found)) == Counter(map(tuple, mixing.taken(frame.repartition(3)).collect()))


def test_mix_texts(docs, rows):
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = Counter()
    for r in mixing.taken(docs).collect():
        taken[r["doc_id"]] += r["taken"]
    found = Counter()
    for r in mixed.collect():
        found[r["doc_id"]] += len(brute.words(r["text"]))
    assert found == +taken


def test_mixing_empty(none):
    assert mixing.taken(none).count() == 0
    assert mixing.mix(none).count() == 0


# 5 -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("local", [100_000, 20])
def test_lm_scores(docs, rows, local):
    found = by_id(map(tuple, lm.score(docs, vocabulary=16, local=local, steps=50).collect()))
    tokens = [brute.words((r[1] or "").translate(brute.LOWER)) + ["\n"] for r in rows]
    held = [zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 5 == 1 for r in rows]
    counts = Counter(t for own, h in zip(tokens, held) if not h for t in own)
    total, distinct = sum(counts.values()), len(counts)
    want = [
        (r[0], h, len(t), sum(w in counts for w in t), total, sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t))
        for r, t, h in zip(rows, tokens, held)
    ]
    want = by_id(want)
    assert [f[:5] for f in found] == [w[:5] for w in want]
    assert np.allclose([f[5] for f in found], [w[5] for w in want])
    assert all(f[6] < 0 for f in found)


def test_lm_is_normalised_and_learns():
    draw = np.random.default_rng(3)
    second, first = draw.integers(0, 5, 4000), draw.integers(0, 5, 4000)
    token = (first + (draw.random(4000) < 0.1)) % 4
    model = lm.LogBilinear(4, np.bincount(token, minlength=4), 8, 1)
    before = model.table().reshape(5, 5, 4)
    model.train(second, first, token, np.ones(4000), 300)
    after = model.table().reshape(5, 5, 4)
    assert np.allclose((10**after).sum(axis=2), 1)
    assert after[second, first, token].mean() > before[second, first, token].mean() + 0.2


def test_lm_classes_share_all_mass():
    """Over all known tokens and the unknown one, shares of a class add up to 1; named tokens are alone in theirs."""
    draw = np.random.default_rng(5)
    hashes = np.append(draw.permutation(500)[:299] + 1, lm.END)
    counts = np.sort(np.exp2(draw.uniform(0, 12, 300)))[::-1].astype(np.int64)
    held, total = 120, int(counts.sum())
    keep = np.append(np.arange(held - 1), 299)  # the end is held whatever its count
    classes = lm.Classes(hashes[keep], counts[keep], 10, total, 300)
    of = np.append(classes.of(hashes), classes.rest)
    share = np.append(counts + 0.5, 0.5) / 10 ** classes.mass[of]
    assert np.allclose(np.bincount(of, share), 1)
    assert classes.rest > 12 and (np.bincount(of)[:11] == 1).all()
    assert {int(np.log2(c)) for c in counts[keep][of[keep] == 12]} == {int(np.log2(counts[keep][of[keep] == 12][0]))}


def test_lm_scores_by_hand(docs, rows, monkeypatch):
    """Scores against a plain sum over tokens, with the table of the model that the query trained."""
    tables = []
    table = lm.LogBilinear.table
    monkeypatch.setattr(lm.LogBilinear, "table", lambda model: tables.append(table(model)) or tables[-1])
    found = by_id((r["doc_id"], r["score"]) for r in lm.score(docs, vocabulary=16, steps=50).collect())
    tokens = [brute.words((r[1] or "").translate(brute.LOWER)) + ["\n"] for r in rows]
    held = [zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 5 == 1 for r in rows]
    counts = Counter(t for own, h in zip(tokens, held) if not h for t in own)
    code = {t: (0 if t == "\n" else int(lm.Words(pa.array([t])).hashes().astype(np.int64)[0])) for own in tokens for t in own}
    ranked = sorted(counts, key=lambda t: (-counts[t], code[t]))
    named = {t: k for k, t in enumerate(t for i, t in enumerate(ranked) if i < 16 or t == "\n")}
    levels = {v: k for k, v in enumerate(sorted({counts[t].bit_length() for t in counts if t not in named}))}
    rest = len(named) + len(levels)

    def of(t):
        return named[t] if t in named else len(named) + levels[counts[t].bit_length()] if t in counts else rest

    mass = Counter({rest: 0.5})
    for t in counts:
        mass[of(t)] += counts[t] + 0.5
    own = tables[0].reshape(rest + 2, rest + 2, rest + 1)
    want = []
    for r, line in zip(rows, tokens):
        seen = [rest + 1, rest + 1, *map(of, line)]
        want.append((r[0], sum(own[a, b, c] + math.log10((counts[t] + 0.5) / mass[c]) for a, b, c, t in zip(seen, seen[1:], seen[2:], line))))
    want = by_id(want)
    assert [f[0] for f in found] == [w[0] for w in want]
    assert np.allclose([f[1] for f in found], [w[1] for w in want])


def test_lm_sums_equal_the_table():
    """Values added up for single codes are those of the table of all trigrams."""
    draw = np.random.default_rng(7)
    model = lm.LogBilinear(40, draw.integers(0, 1000, 40), 8, 1)
    model.train(draw.integers(0, 41, 4000), draw.integers(0, 41, 4000), draw.integers(0, 40, 4000), np.ones(4000), 50)
    assert np.allclose(lm.Sums(model, 16)[np.arange(41 * 41 * 40)], model.table().ravel())
    model.params["bias"] = model.params["bias"] * 0
    for name, sign in (("first", 1), ("second", -1)):  # peaks of the two tokens so far apart that exponentials vanish
        model.params[name] = sign * 2000 * np.eye(8)
    assert np.allclose(lm.Sums(model)[np.arange(41 * 41 * 40)], model.table().ravel(), atol=1e-2)


def test_lm_tells_frequent_tokens_apart(spark):
    """Words of one frequency, 300 of them, are told apart by what follows them."""
    pairs = [f"a{k} b{k}" for k in range(300)]
    docs = spark.createDataFrame([(k, " ".join(pairs[k % 50 :] + pairs[: k % 50])) for k in range(60)], "doc_id long, text string")
    ids = [i for i in range(900, 999) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    shuffled = " ".join(f"a{k} b{(k + 7) % 300}" for k in range(300))
    docs = docs.unionByName(spark.createDataFrame([(ids[0], " ".join(pairs)), (ids[1], shuffled)], docs.schema))
    scores = {r["doc_id"]: r["score"] for r in lm.score(docs, steps=300).collect()}
    assert scores[ids[0]] > scores[ids[1]] + 100


def test_lm_learns_from_all_trigrams(spark):
    """A corpus of many times the steps' trigrams: pairs that the start hardly meets are learned, and every trigram is counted once."""
    pairs = [f"a{k} b{k}" for k in range(300)]
    docs = spark.createDataFrame([(k, " ".join(pairs[7 * k % 300 :] + pairs[: 7 * k % 300]) + f" c{k}") for k in range(1000)], "doc_id long, text string")
    held = [i for i in range(9000, 9099) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    shuffled = " ".join(f"a{k} b{(k + 7) % 300}" for k in range(300))
    docs = docs.unionByName(spark.createDataFrame([(held[0], " ".join(pairs)), (held[1], shuffled)], docs.schema))
    scores = {r["doc_id"]: r["score"] for r in lm.score(docs.repartition(3), steps=20).collect()}
    assert scores[held[0]] > scores[held[1]] + 200


@pytest.mark.parametrize("share", [2**21, 2000])
def test_lm_every_trigram_is_learned_once(docs, monkeypatch, share):
    monkeypatch.setattr(lm, "SHARE", share)
    texts = docs.select("text").repartition(5)
    hashes, counts = np.unique(lm.tokens(pa.array([r["text"] for r in texts.collect()], pa.string()))[0], return_counts=True)
    classes = lm.Classes(hashes, counts, 16, int(counts.sum()), len(hashes))
    model = lm.LogBilinear(classes.rest + 1, classes.uses, 8, 1)
    before = model.params["token"].copy()
    assert lm.learn_all(texts, classes, model, int(counts.sum()), 3) == counts.sum()
    assert (model.params["token"] != before).any() and all(np.isfinite(v).all() for v in model.params.values())


def test_lm_turns_leave_none_out():
    draw = np.random.default_rng(2)
    for n, size in ((10, 3), (3, 10), (1, 4096), (5000, 4096)):
        found = np.concatenate([at for _, at in zip(range(60), lm.turns(draw, np.ones(n, np.int8), size))])
        counted = np.bincount(found[: len(found) // n * n], minlength=n)
        assert len(found) == 60 * size and counted.max() - counted.min() <= max(2, 2 * size // n)
    assert sorted(next(lm.turns(draw, np.array([1, 0, 3]), 4))) == [0, 2, 2, 2]


def test_lm_empty(none, spark):
    assert lm.score(none).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    (only,) = lm.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert (only["n_tokens"], only["n_known"], only["train_tokens"], only["base_score"]) == (3, 0, 0, 0.0)


# 6 -----------------------------------------------------------------------------------------------


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[at:]
    end = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return rest[:at].translate(brute.LOWER), path[:end]


def test_urls(spark):
    some = [None, "", "x", "http://", "HTTP://A.ORG", "http://org/", "http://aorg/", "http://É.Example.org/es/1", "http://example.org/en/1a?b#c", "http://b.com/fr/",
            "http://com/de/x", "http://x.com?a=/de/", "a://b://c.org/x", "http://b.com/de", "http://u:p@h.org:80/x\ny"]
    some += [f"http://h{k}.example.com/{'de' if k % 2 else 'fr'}/{k}" for k in range(60)] + [f"http://n{k}.net/{'de' if k % 2 else 'fr'}/{k}" for k in range(60)]
    frame = spark.createDataFrame([(k, u, "h", "v", 1.0) for k, u in enumerate(some)] + [(None, None, None, None, None)], "page_id long, url string, host string, verdict string, length double")
    found = urls.judge(frame).collect()
    assert len(found) == len(some) + 1
    for r in found:
        if r["page_id"] is None:
            continue
        host, path = parts(some[r["page_id"]])
        fits = [(h + p, says) for says, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, says = max(fits, key=lambda f: len(f[0]), default=(None, None))
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), some[r["page_id"]]
        assert r["verdict"] == says if rule else r["verdict"] in ("allow", "block")


def test_urls_learn(spark):
    rules = (("allow", "good.net", "/"), ("block", "bad.net", "/"))
    rows = [(k, f"http://{'bad' if k % 2 else 'good'}.net/{'9' * 12 if k % 2 else 'abc'}{k}") for k in range(400)]
    rows += [(1000 + k, f"http://other{k}.net/{'9' * 12 if k % 2 else 'abc'}{k}") for k in range(40)]
    found = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert sum(found[1000 + k] == ("block" if k % 2 else "allow") for k in range(40)) >= 36


def test_urls_suffixes_of_all_labels(spark):
    """Only the share of the suffix tells the classes apart, and most suffixes are not in the sample."""
    rules = (("allow", "net", "/a/"), ("block", "net", "/b/"))
    rows = [(k, f"http://s{k % 200:03}.net/{'b' if k % 200 % 2 else 'a'}/{k:06}") for k in range(12_000)]
    rows += [(100_000 + k, f"http://s{k:03}.net/c/000000") for k in range(200)]
    found = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules, sample=60).collect()}
    assert len(found) == len(rows)
    assert sum(found[100_000 + k] == ("block" if k % 2 else "allow") for k in range(200)) >= 190


@pytest.mark.parametrize("few", [1, 3])
def test_urls_rare_and_repeated(spark, few):
    """Thousands of rows over few urls, and one blocked url among thousands: both classes are always fitted."""
    rules = (("allow", "good.net", "/"), ("block", "bad.net", "/"))
    rows = [(k, f"http://good.net/abc{k % 20 if few == 3 else k}") for k in range(4_000)]
    rows += [(10_000 + k, f"http://bad.net/{'9' * 12}{k % few}") for k in range(few)]
    rows += [(20_000 + k, f"http://other{k}.net/{'9' * 12 if k % 2 else 'abc'}{k}") for k in range(40)]
    found = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules, sample=2).collect()}
    assert len(found) == len(rows) and {found[20_000 + k] for k in range(40)} <= {"allow", "block"}
    fitted = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules, sample=400).collect()
    verdicts = {r["page_id"]: r["verdict"] for r in fitted}
    assert len(verdicts) == len(rows) and {verdicts[20_000 + k] for k in range(40)} <= {"allow", "block"}


def test_url_quotas():
    assert urls.quotas({0.0: 10**6, 1.0: 10**6}, 20_000) == {0.0: 10_000, 1.0: 10_000}
    assert urls.quotas({0.0: 10**6, 1.0: 7}, 20_000) == {0.0: 19_993, 1.0: 7}
    assert urls.quotas({0.0: 1, 1.0: 1}, 0) == {0.0: 1, 1.0: 1}
    # Of 2**35 urls some 10,000 are drawn, not none; and always the first.
    share = (urls.last_hash(10_000, 2**35, -(2**63)) + 2**63 + 1) / 2**64
    assert abs(share * 2**35 - 10_000) < 1
    assert urls.last_hash(1, 2**62, 5) == 5 and urls.last_hash(7, 7, 0) == 2**63 - 1


def test_url_suffix_shares(spark):
    labelled = spark.createDataFrame([("a", "u1", 1.0), ("a", "u1", 1.0), ("a", "u2", 0.0), ("b", "u3", 1.0)], "suffix string, url string, label double")
    others = spark.createDataFrame([("a",), ("c",), ("c",)], "suffix string")
    found = {r["suffix"]: (r["suffix_blocked"], r["judged"]) for r in urls.suffix_shares(labelled, others, 0.5).collect()}
    assert found == {"a": (11 / 22, 1), "b": (11 / 21, 0), "c": (0.5, 2)}


def test_urls_empty(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


# 7 -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("width", "k"), [(35, 12), (8, 3)])
def test_substrings(docs, rows, width, k):
    want = Counter((r[0], *c) for r, c in zip(rows, brute.cut([brute.words(r[1]) for r in rows], width)))
    assert Counter(map(tuple, substring.deduplicate(docs, width, k).collect())) == want


def test_paths_lie_in_repeats(docs, rows):
    texts = {r[0]: brute.words(r[1]) for r in rows}
    gone = dict(zip([r[0] for r in rows], brute.covered([brute.words(r[1]) for r in rows], 35)))
    own = substring.keyed(docs)
    found = substring.paths(substring.repeated_edges(substring.edges(own))).join(own, ["key", "check"]).where("doc_id is not null").collect()
    assert found
    by_path = defaultdict(set)
    for p in found:
        a, b = p["start"], p["start"] + p["size"] + 34
        assert all(gone[p["doc_id"]][a:b])
        by_path[p["path"], p["size"]].add(tuple(texts[p["doc_id"]][a : a + 35]))
    assert all(len(v) == 1 for v in by_path.values())


def test_substrings_empty(none):
    assert substring.deduplicate(none).count() == 0


# 8 -----------------------------------------------------------------------------------------------


def test_classifier(spark):
    rows = brute.rows(n=300)
    junk = [(5000 + k, " ".join(f"JUNK{k}{j}!!" for j in range(40)), None, None, 0, None, None, None, None) for k in range(200)]
    docs = spark.createDataFrame(rows + junk, brute.SCHEMA).repartition(4)
    marks = [(r[0], 0 if r[0] and r[0] >= 5000 else 1) for r in rows + junk] + [(None, 0), (7, None), (99999, 0)]
    found = classifier.classify(docs, spark.createDataFrame(marks, "doc_id long, quality int")).collect()
    assert len(found) == len(rows) + len(junk)
    for r in found:
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in found if r["held_out"] and r["doc_id"]]
    assert sum((r["score"] >= 0.3) == (r["doc_id"] < 5000) for r in held) >= 0.95 * len(held)


def test_classifier_ignores_held_out_labels(spark, docs, rows):
    ids = [r[0] for r in rows if r[0] is not None]
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    a = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    b = spark.createDataFrame([(i, i % 2 if fold(i) else 1 - i % 2) for i in ids], "doc_id long, quality int")
    assert by_id(map(tuple, classifier.classify(docs, a).collect())) == by_id(map(tuple, classifier.classify(docs, b).collect()))


def test_classifier_without_labels(spark, docs, none):
    marks = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in classifier.classify(docs, marks).collect()} == {0.5}
    assert classifier.classify(none, marks).count() == 0


def test_classifier_draw_is_bounded(spark):
    """One id repeated very often, one id with two texts, null texts: at most so many of each class, each text once."""
    rows = [(7, "again", 1)] * 3000 + [(8, None, 0)] * 50 + [(k, f"text {k}", k % 2) for k in range(100, 160)] + [(100, "other", 0)]
    known = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(5)
    few = classifier.drawn(known, 10, 3).collect()
    assert Counter(r["label"] for r in few) == {0: 10, 1: 10} and len({r["place"] for r in few}) == 20
    every = classifier.drawn(known, 1000, 3).collect()
    assert Counter((r["text"], r["label"]) for r in every) == Counter({(t, c) for _, t, c in rows})
    assert {tuple(r) for r in few} < {tuple(r) for r in every}
    assert classifier.drawn(known.where("label > 1"), 10, 3).count() == 0


# 9 -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("tracked", [4096, 16])
def test_exact(docs, rows, tracked):
    groups = defaultdict(list)
    for r in rows:
        groups[brute.normalised(r[1])].append(r[0])
    want = Counter()
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        want.update((i, ids[0], len(ids), k == 0, hashlib.sha256(text.encode()).digest()) for k, i in enumerate(ids))
    found = exact.groups(docs, tracked).select("doc_id", "keep_id", "group_size", "kept", "digest").collect()
    assert Counter((*r[:4], bytes(r["digest"])) for r in found) == want
    stay = exact.deduplicate(docs, tracked)
    assert stay.columns == docs.columns
    assert Counter(brute.normalised(r["text"]) for r in stay.collect()) == Counter(groups.keys())


def test_exact_empty(none):
    assert exact.groups(none).count() == 0


# 10 ----------------------------------------------------------------------------------------------


def test_packing(docs, rows):
    model = Tokenizer.from_file(VOCABULARY)
    pieces = packing.pack(docs.dropDuplicates(["doc_id"]), VOCABULARY).collect()
    own = {r[0]: [*model.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows}
    per_doc, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        per_doc[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append(p)
    assert per_doc.keys() == own.keys()
    for i, found in per_doc.items():
        at = 0
        for p in sorted(found, key=lambda p: p["start"]):
            ids = np.array(own[i][at : at + p["length"]], "<u4")
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(own[i]), zlib.crc32(ids.tobytes()))
            at += p["length"]
        assert at == len(own[i])
    for found in sequences.values():
        at = 0
        for p in sorted(found, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048 and at & (at - 1) == 0  # no padding at all


@pytest.mark.parametrize("seed", range(4))
def test_packing_places_by_sum_of_squares(seed):
    """Every placement against all choices, each tried on the list of fill levels; the sequences that close are full."""
    draw, size = np.random.default_rng(seed), 32
    packer, levels, closed = packing.Packer(size), [], []

    def squares(filled):
        return sum(n * n for n in Counter(f for f in filled if f < size).values())

    for doc in range(400):
        length = int(draw.integers(1, 3 * size)) if seed else int(draw.choice([3, 5, 32, 20]))
        need = length % size
        choices = {0: squares([*levels, need])}
        for h in sorted(set(levels)):
            if h + need <= size:
                left = list(levels)
                left.remove(h)
                choices[h] = squares([*left, h + need])
        level = packer.level_for(need) if need else 0
        full = list(packer.add(doc, np.arange(length, dtype=np.uint32)))
        closed += full
        assert all(sum(len(ids) for _, _, ids in pieces) == size for pieces in full)
        assert len(full) == length // size + (need > 0 and level + need == size)
        if need:
            least = min(choices.values())
            raised = [h for h in choices if h and choices[h] == least]
            assert level == (max(raised) if raised else 0)  # the fullest of equal ones; a new sequence only if that is better
            if level:
                levels.remove(level)
            if level + need < size:
                levels.append(level + need)
        assert np.array_equal(np.bincount(levels, minlength=size + 1), packer.levels)
    closed += packer.rest()
    ids = sorted((doc, start + k) for pieces in closed for doc, start, own in pieces for k in range(len(own)))
    assert len(ids) == len(set(ids)) and {d for d, _ in ids} == set(range(400))
    assert all((n := sum(len(own) for _, _, own in pieces)) & (n - 1) == 0 for pieces in closed)


def test_packing_empty(none):
    assert packing.pack(none, VOCABULARY).count() == 0


# The pipeline ------------------------------------------------------------------------------------


def test_pipeline(spark, folder):
    import corpus_pipeline

    rows = [r[:5] for r in brute.rows(seed=2, n=60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    names = ["quality rules", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names
    frames = [frame]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], folder).persist())
    _, clean, once, apart, mixed, packed = frames
    assert all(f.columns == frame.columns for f in frames[:-1])
    assert {r["doc_id"] for r in clean.collect()} == {r["row"]["doc_id"] for r in quality.judge(frame).where("kept").collect()}
    assert sorted(brute.normalised(r["text"]) for r in once.collect()) == sorted({brute.normalised(r["text"]) for r in clean.collect()})
    want = brute.components({r["doc_id"]: brute.shingles(r["text"], 5) for r in once.where("doc_id is not null").collect()}, 80)
    assert {r["doc_id"] for r in apart.collect()} - {None} == set(want.values())
    takes = mixing.taken(apart).where("taken > 0").select("doc_id").collect()
    assert {r["doc_id"] for r in mixed.collect()} == {r["doc_id"] for r in takes}
    model = Tokenizer.from_file(VOCABULARY)
    ids = sum(len(model.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in mixed.collect())
    assert packed.agg(F.sum("length")).first()[0] == ids
    assert corpus_pipeline.run(spark, folder).agg(F.sum("length")).first()[0] == ids
