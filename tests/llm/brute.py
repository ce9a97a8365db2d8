"""Plain Python versions that the operators' results are held against, and rows with every odd case."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, words long, n long, `key` string"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(draw: random.Random, n: int, vocabulary: int = 400) -> str:
    out = []
    for k in range(n):
        out.append(f"w{draw.randrange(vocabulary)}" + ("." if k % 9 == 8 else ""))
        out.append("\n" if k % 27 == 26 else " ")
    return "".join(out).rstrip() + "."


def rows(seed: int = 1, n: int = 120) -> list[tuple]:
    """Documents: plain, equal, near, sharing passages, very long, and nulls, blanks and repeated rows."""
    draw = random.Random(seed)
    passage = prose(draw, 60)
    texts: list[str | None] = [prose(draw, draw.randrange(5, 300)) for _ in range(n)]
    for k in range(0, n, 4):
        texts[k] = texts[0]
    for k in range(1, n, 8):
        own = texts[1].split(" ")
        own[draw.randrange(len(own))] = f"new{k}"
        texts[k] = " ".join(own)
    for k in range(2, n, 8):
        texts[k] = f"{texts[k]} {passage} {prose(draw, 30)}"
    texts += [None, "", " \t\n ", "one", "One  two", "one two", "and " * 200, "Ünï çödé \u00a0 x", prose(draw, 9000), passage.replace(" ", "\t\v ")]
    out = [(k * 3, t, None if k % 11 == 0 else "en", None if k % 13 == 0 else f"s{k % 3 if k % 2 else 0}", len(t or ""), "r", k, None, "k") for k, t in enumerate(texts)]
    return out + [out[5], out[6], (None, texts[3], None, None, None, None, None, None, None)]


def covered(all_words: list[list[str]], width: int) -> list[list[bool]]:
    found = Counter(tuple(w[p : p + width]) for w in all_words for p in range(len(w) - width + 1))
    out = []
    for w in all_words:
        own = [False] * len(w)
        for p in range(len(w) - width + 1):
            if found[tuple(w[p : p + width])] > 1:
                own[p : p + width] = [True] * width
        out.append(own)
    return out


def cut(all_words: list[list[str]], width: int) -> list[tuple[int, int, str]]:
    """Words, words removed, and the digest of what stays."""
    out = []
    for w, gone in zip(all_words, covered(all_words, width)):
        left = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(left.encode()).hexdigest()))
    return out


def shingles(text: str | None, width: int) -> frozenset:
    own = words((text or "").translate(LOWER))
    return frozenset(tuple(own[p : p + width]) for p in range(len(own) - width + 1)) if len(own) >= width else frozenset([tuple(own)] if own else [])


def components(sets: dict[int, frozenset], percent: int) -> dict[int, int]:
    name = {i: i for i in sets}

    def root(i: int) -> int:
        while name[i] != i:
            i = name[i]
        return i

    own = [i for i, s in sets.items() if s]
    for a in own:
        for b in own:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                name[y] = x
    return {i: root(i) for i in sets}


def normalised(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
