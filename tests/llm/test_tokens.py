"""Phrases, SentencePiece encoding and tokenizer alignment against plain Python and the libraries."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm import brute
from tidegate.llm import alignment, phrases, pieces

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "a  b", "\n", "\n\nx", "x\n\ny\nz", "don't  'll \t tab", "é ü x", "▁ under", "<s> </s> <unk> <|endoftext|> <0x41>", "\x01 cut \x01here",
    "日本語 テスト", "𝄞 music", "a \n b", " lead", "trail ", "x y", "\x00 nul", "one.\nTwo\r\nthree 12 3a", "a b c",
]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    signs = list("ab '.s\n\n  \té日▁1")
    odd = ODD + ["".join(draw.choice(signs) for _ in range(draw.randrange(1, 30))) for _ in range(150)]
    out = [r for r in brute.rows(n=40) if r[1] is None or len(r[1]) < 5000]
    return out + [(1000 + k, t, "en", None, len(t), "r", k, None, "k") for k, t in enumerate(odd)] + [(7, "again again", None, None, 0, "", 0, 0, "")] * 3


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, brute.SCHEMA).repartition(5).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], brute.SCHEMA)


# 11 ----------------------------------------------------------------------------------------------


def best_phrases(rows, width=3, least=10, percent=50, top=2000):
    found, words = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(brute.LOWER)):
            own = re.findall("[^ \t]+", piece)
            words[lang] += len(own)
            found.update((lang, tuple(own[i : i + n])) for n in range(1, width + 1) for i in range(len(own) - n + 1))
    candidates = {k: a for k, a in found.items() if len(k[1]) > 1 and a >= least}
    dropped = set()
    for (lang, own), a in candidates.items():
        for n in range(2, len(own)):
            inner = [(lang, own[i : i + n]) for i in range(len(own) - n + 1)]
            dropped.update(i for i in inner if 100 * a >= percent * found[i])
    ranked = defaultdict(list)
    for (lang, own), a in candidates.items():
        if (lang, own) not in dropped:
            parts = [(found[lang, own[:k]], found[lang, own[k:]]) for k in range(1, len(own))]
            score, _, left, right = min((1000000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(parts))
            ranked[lang].append((-score, -a, " ".join(own).encode(), left, right))
    return sorted(
        (lang, rank, p.decode(), -a, x, y, words[lang], -s)
        for lang, own in ranked.items()
        for rank, (s, a, p, x, y) in enumerate(sorted(own)[:top], 1)
    )


@pytest.fixture(scope="module")
def prose():
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "A", "ab", "und"]
    texts = [" ".join(draw.choice(vocabulary) + (draw.choice(".,;\n!\x0b") if draw.random() < 0.1 else "") for _ in range(draw.randrange(80))) for _ in range(150)]
    out = [(t, draw.choice(["en", "fr", None, "und"])) for t in texts]
    return out + [(r[1], r[2]) for r in brute.rows(n=60)] + [("A\tb " * 3000, "fr"), (None, None), ("", "xx"), (" .,\t", "yy")] + [("same old  words, same OLD words", "de")] * 9


# Ten bits make most fingerprints collide: the words tell them apart inside a slice, the check between slices.
@pytest.mark.parametrize(("width", "bits", "top"), [(3, 64, 2000), (3, 10, 2000), (4, 10, 2000), (3, 64, 7)])
def test_phrases(spark, prose, width, bits, top):
    frame = spark.createDataFrame(prose, "text string, lang string").repartition(7)
    found = phrases.collocations(frame, width=width, top=top, bits=bits)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == best_phrases(prose, width, top=top)


def test_phrases_with_large_counts(spark):
    phrase = spark.createDataFrame(
        [("en", 1, "a", 10**15), ("en", 1, "b", 10**15 - 1), ("en", 2, "a b", 10**15 - 2)], "lang string, size int, phrase string, times long"
    )
    want = 10**6 * (10**15 - 2) ** 2 // (10**15 * (10**15 - 1))
    assert [(r["score"], r["k"]) for r in phrases.scored(phrase).collect()] == [(want, 1)]


def test_phrases_empty(none):
    assert phrases.collocations(none).collect() == []


# 12 ----------------------------------------------------------------------------------------------


def changed_model(rule: str, prefix: bool, collapse: bool, suffix: bool = False) -> bytes:
    """The model with one of the library's own character maps."""

    def size(n: int) -> bytes:
        out = []
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    with open(PIECES, "rb") as f:
        data = f.read()
    made = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    spec = next(v for n, v, _ in pieces.fields(made) if n == 3)
    spec = b"".join(raw for n, _, raw in pieces.fields(spec) if n == 2) + bytes([24, prefix, 32, collapse, 40, 1])
    rest = b"".join(raw for n, _, raw in pieces.fields(data) if n not in (2, 3))
    trainer = next(v for n, v, _ in pieces.fields(data) if n == 2)
    trainer = b"".join(raw for n, _, raw in pieces.fields(trainer) if n != 24) + bytes([24 << 3 & 127 | 128, 24 >> 4, suffix])
    return rest + b"\x12" + size(len(trainer)) + trainer + b"\x1a" + size(len(spec)) + spec


@pytest.mark.parametrize("rule", ["nmt_nfkc", "identity", "nmt_nfkc_cf"])
@pytest.mark.parametrize(("prefix", "collapse", "suffix"), [(True, True, False), (True, False, False), (False, True, False), (True, True, True)])
def test_pieces_keep_offsets(rule, prefix, collapse, suffix):
    data = changed_model(rule, prefix, collapse, suffix)
    own, library = pieces.Model(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    draw = random.Random(3)
    signs = "aAéÉ ﬁ①ｆ　  éñ각 ¨ ﷺ ½ \n\t\x00\x01 ▁ 𝄞 ｶﾞ が <s> ẓ́"
    texts = ["", " ", "   ", "a", " a ", "a  b  ", "　x　", "¨¨", "ﷺ ﷺ", "ｶﾞ", "\x01", "\x01 a", "▁"]
    texts += ["".join(draw.choice(signs) for _ in range(draw.randrange(1, 40))) for _ in range(400)]
    for text in texts:
        want = [(p.id, p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(*(x.tolist() for x in own.encode(text)))) == want, repr(text)


def test_pieces_unknown():
    """Without pieces for bytes, what is unknown becomes one piece as long as itself."""
    with open(PIECES, "rb") as f:
        data = f.read()
    kept, trainer = [], next(v for n, v, _ in pieces.fields(data) if n == 2)
    for n, v, raw in pieces.fields(data):
        if n not in (1, 2):
            kept.append(raw)
        elif n == 1:
            name = {k: x for k, x, _ in pieces.fields(v)}[1]
            if not re.fullmatch(rb"<0x..>", name):
                kept.append(raw)
    body = b"".join(raw for n, _, raw in pieces.fields(trainer) if n != 35)
    length = bytes([len(body) & 127 | 128, len(body) >> 7])
    changed = b"".join(kept) + b"\x12" + length + body
    own, library = pieces.Model(changed), sentencepiece.SentencePieceProcessor(model_proto=changed)
    for text in ["a 𝄞𝄞 b", "日本語\n\n", "plain", "𝄞"]:
        want = [(p.id, p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(*(x.tolist() for x in own.encode(text)))) == want


def test_encode_and_decode(docs, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoded = pieces.encode(docs, PIECES, decoded=True)
    want = Counter()
    for r in rows:
        text = r[1] or ""
        ids = library.encode(text, add_bos=True, add_eos=True)
        want[r[0], np.array(ids, "<u4").tobytes(), library.decode(ids)] += 1
    found = encoded.collect()
    assert Counter((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in found) == want
    texts = defaultdict(set)
    for r in rows:
        texts[r[0]].add((r[1] or "").encode())
    for r in found:  # the spans follow one another and cover the text
        inner = list(zip(r["starts"], r["ends"]))[1:-1]
        assert not inner or (inner[0][0] == 0 and all(a[1] == b[0] for a, b in zip(inner, inner[1:])))
        assert (inner[-1][1] if inner else 0) == r["starts"][-1] == r["ends"][-1]
        assert r["ends"][-1] in {len(t) for t in texts[r["doc_id"]]}
    again = pieces.decode(encoded, PIECES)
    assert Counter((r["doc_id"], r["text"]) for r in again.collect()) == Counter((r["doc_id"], r["decoded"]) for r in found)


def test_encode_without_ends(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = {r["doc_id"]: (len(r["ids"]) // 4, r["starts"], r["ends"]) for r in pieces.encode(frame, PIECES, begin=False, end=False).collect()}
    assert found == {1: (2, [0, 1], [1, 3]), 2: (0, [], [])}


def test_encode_empty(none):
    assert pieces.encode(none, PIECES).collect() == []


# 13 ----------------------------------------------------------------------------------------------


def aligned_texts(rows):
    """Tokens, groups, links and counts, one token after the other."""
    a_model, b_model = Tokenizer.from_file(BYTE_LEVEL), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_model.encode_special_tokens = True
    values, names = alignment.byte_values(), {i: t for t, i in a_model.get_vocab().items()}
    per, count = [], Counter()
    for doc_id, text in rows:
        per.append([doc_id, None])
        if not text:
            continue
        a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
        said_a = [bytes(values[c] for c in names[i]) for i in a]
        said_b = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(said_a) == b"".join(said_b) == (" " + text).encode():
            continue
        ends_a, ends_b = [0], [0]
        for said, ends in ((said_a, ends_a), (said_b, ends_b)):
            for s in said:
                ends.append(ends[-1] + len(s))
        groups, start = [], 0
        for cut in sorted(set(ends_a[1:]) & set(ends_b[1:])):
            sides = [",".join(str(t) for t, e in zip(ids, ends) if start <= e < cut) for ids, ends in ((a, ends_a), (b, ends_b))]
            groups.append("|".join(sides))
            start = cut
        links, first = [], 0
        for i in range(len(a)):
            while ends_b[first + 1] <= ends_a[i]:
                first += 1
            j = first
            while j < len(b) and ends_b[j] < ends_a[i + 1]:
                links.append((a[i], b[j]))
                j += 1
        count.update(set(links))
        per[-1][1] = (len(a), len(b), groups, links)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = Counter()
    for doc_id, found in per:
        if found is None:
            out[doc_id, 0, 0, 0, 0, 0, 0, ""] += 1
        else:
            n_a, n_b, groups, links = found
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            n_best = sum(count[x] == best[x[0]] for x in links)
            out[doc_id, n_a, n_b, len(groups), len(links), n_best, sum(count[x] for x in links), digest] += 1
    return out


@pytest.mark.parametrize("local", [200_000, 3])
def test_alignment(docs, rows, local):
    found = alignment.measure(docs, BYTE_LEVEL, PIECES, local=local)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in found.collect()) == aligned_texts([(r[0], r[1]) for r in rows])


def test_alignment_of_whole_texts(rows):
    """Tokenizers that promise no cuts get whole texts; the result is the same."""
    import pyarrow as pa

    by_units, whole = alignment.Aligner(BYTE_LEVEL, PIECES), alignment.Aligner(BYTE_LEVEL, PIECES)
    assert by_units.cuts
    whole.cuts = False
    texts = pa.array([r[1] for r in rows if r[1]])
    assert [c.to_pylist() for c in by_units(texts)] == [c.to_pylist() for c in whole(texts)]


def test_alignment_forgets(rows):
    import pyarrow as pa

    own = alignment.Aligner(BYTE_LEVEL, PIECES)
    texts = [r[1] for r in rows if r[1]]
    want = [c.to_pylist() for c in own(pa.array(texts))]
    own.LIMIT = 1
    parts = [own(pa.array(texts[k : k + 20])) for k in range(0, len(texts), 20)]
    assert [sum((p[c].to_pylist() for p in parts), []) for c in range(len(want))] == want


def test_alignment_empty(none):
    assert alignment.measure(none, BYTE_LEVEL, PIECES).collect() == []
