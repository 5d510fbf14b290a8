"""Texts and tables for the tests, with plain Python versions of what the operators compute."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, `row` string"


def words(generator: random.Random, n: int) -> str:
    return " ".join("".join(generator.choice("abcdefghiklmnoé") for _ in range(generator.randint(2, 9))) for _ in range(n))


def awkward() -> list[str | None]:
    """Nulls, empties, blanks, short texts, odd white space, letters beyond ASCII."""
    return [None, "", " ", "\n\t ", "one", "One two", "one  two\x0bthree", "a\u00a0b c", "日本 語", "<|endoftext|> x<|endoftext|>", "\x00\x1c", "x" * 500]


def near_copies(seed: int = 1, groups: int = 6, each: int = 7) -> list[str]:
    generator, out = random.Random(seed), []
    for _ in range(groups):
        base = words(generator, generator.randint(60, 160)).split()
        for _ in range(each):
            copy = list(base)
            for _ in range(generator.randint(0, 6)):
                copy[generator.randrange(len(copy))] = words(generator, 1)
            out.append(" ".join(copy))
    return out


def documents(spark, texts, first: int = 0):
    """A table of documents with a column whose name an operator might use itself."""
    rows = [(first + i, t, "en", "s", len(t or ""), "own") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def fold(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(tokens: list[bytes]) -> list[tuple]:
    if not tokens:
        return []
    return [tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4)] or [tuple(tokens)]


class Groups:
    def __init__(self, members):
        self.up = {m: m for m in members}

    def root(self, m):
        while self.up[m] != m:
            m = self.up[m]
        return m

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def near_duplicate_groups(texts: dict, percent: int = 85) -> dict:
    """Least id that each text reaches over links of so many percent; every pair that shares a shingle is compared."""
    sets = {i: set(shingles(fold(t))) for i, t in texts.items()}
    groups, holders, shared = Groups(texts), defaultdict(list), Counter()
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for ids in holders.values():
        shared.update((a, b) for k, b in enumerate(ids) for a in ids[:k])
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            groups.join(a, b)
    return {i: (len(sets[i]), groups.root(i)) for i in texts}


def covered(texts: list[str | None], length: int = 400) -> list[tuple[bytes, list[tuple[int, int]]]]:
    """What is left of each text without strings of ``length`` bytes that start at two places, and the spans."""
    given = [(t or "").encode() for t in texts]
    seen = Counter(b[s : s + length] for b in given for s in range(len(b) - length + 1))
    out = []
    for b in given:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans, i = [], 0
        while (i := gone.find(1, i)) >= 0:
            stop = gone.find(0, i)
            stop = len(b) if stop < 0 else stop
            spans.append((i, stop))
            i = stop
        out.append((bytes(x for x, g in zip(b, gone, strict=True) if not g), spans))
    return out


def contaminations(texts: dict, items: dict) -> dict:
    """(doc, item) -> greatest similarity over all item-sized windows, where it is 0.8 or more."""
    out = {}
    for d, t in texts.items():
        tokens = fold(t)
        for i, item in items.items():
            own = fold(item)
            if not own or not tokens:
                continue
            wanted, best = Counter(shingles(own)), 0.0
            for s in range(max(1, len(tokens) - len(own) + 1)):
                window = Counter(shingles(tokens[s : s + len(own)]))
                shared = sum((window & wanted).values())
                every = sum(window.values()) + sum(wanted.values()) - shared
                if 5 * shared >= 4 * every:
                    best = max(best, shared / every)
            if best:
                out[d, i] = best
    return out
