"""Small tables with the awkward rows every operator must take, and brute-force counterparts."""

from __future__ import annotations

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text: str | None, lower: bool = True) -> list[str]:
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def shingles(text: str | None, size: int = 5) -> frozenset:
    w = words(text)
    if len(w) >= size:
        return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    return frozenset([tuple(w)] if w else [])


def least_of_component(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def close_pairs(sets: dict, up: int = 4, down: int = 5) -> list:
    """All pairs of keys whose sets have a Jaccard similarity of at least up / down."""
    having, found = defaultdict(list), []
    for key, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for other in having[x]:
                shared[other] += 1
            having[x].append(key)
        found += [(key, k) for k, n in shared.items() if n * down >= (len(s) + len(sets[k]) - n) * up]
    return found


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, sig string, component string, kept int"


def documents(spark, texts: list):
    """Documents numbered from 0, with columns whose names the operators use themselves."""
    rows = [(i, t, "en", f"s{i % 3}", len(t) if t is not None else None, "x", "y", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed: int, n: int) -> str:
    """``n`` made-up words in lines of twelve."""
    out, x = [], seed * 7919 + 13
    for i in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        word = "".join("bdfgklmnprst"[(x >> s) % 12] + "aeiou"[(x >> (s + 7)) % 5] for s in (20, 31, 42)[: 1 + (x >> 50) % 3])
        out.append(word + ("\n" if i % 12 == 11 else " "))
    return "".join(out).strip()


def edited(text: str, every: int) -> str:
    w = text.split(" ")
    return " ".join("changed" if i % every == every // 2 else x for i, x in enumerate(w))


ODD = [None, "", "   \n\t ", "one", "one", "two words", "ÀÉ ünï 😀  x", "a" * 5000, "w " * 3000]


def corpus() -> list:
    base = [prose(i, 60 + 13 * i) for i in range(12)]
    near = [edited(t, 47) for t in base[:8]] + [edited(t, 13) for t in base[:8]]
    return [*ODD, *base, *near, *base[:4], *["the very same text that many rows hold in common here"] * 30, prose(99, 20000)]
