"""Brute-force versions over small tables, without Spark."""
from __future__ import annotations

import re
from collections import Counter, defaultdict

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return SPACE_WORDS.findall(text or "")


def shingles(text: str | None, k: int = 5) -> set:
    w = words(lower(text))
    return set(zip(*[w[i:] for i in range(k)])) if len(w) >= k else ({tuple(w)} if w else set())


def jaccard_roots(docs: list[tuple[int, str | None]]) -> dict[int, int]:
    sets = {i: shingles(t) for i, t in docs}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if both and 100 * both >= 80 * either:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def removed_lines(docs: list[tuple[int, str | None]], least: int = 5, percent: int = 80) -> set[tuple[int, int]]:
    lines = [(i, n, set(words(x))) for i, t in sorted(docs, key=lambda d: d[0]) for n, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if len(x[2]) >= least]
    out = set()
    for k, (i, n, w) in enumerate(lines):
        if any(100 * len(w & v) >= percent * len(w | v) for _, _, v in lines[:k]):
            out.add((i, n))
    return out


def contamination(docs, items, size: int = 13) -> dict:
    windows = defaultdict(set)
    for item, text in items:
        w = LETTER_WORDS.findall(lower(text))
        for at in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[at : at + size])].add(item)
    lengths = sorted({len(k) for k in windows})
    out = {}
    for doc, text in docs:
        w = LETTER_WORDS.findall(lower(text))
        hit, found = set(), set()
        for n in lengths:
            for at in range(len(w) - n + 1):
                owners = windows.get(tuple(w[at : at + n]))
                if owners:
                    hit |= set(range(at, at + n))
                    found |= owners
        out[doc] = (len(w), len(hit), found)
    return out


def near_contamination(docs, items, slop: int, least: int, size: int = 13) -> dict:
    out = {doc: set() for doc, _ in docs}
    for doc, text in docs:
        d = LETTER_WORDS.findall(lower(text))
        for item, passage in items:
            w = LETTER_WORDS.findall(lower(passage))
            for at in range(max(1, len(w) - size + 1) if w else 0):
                part = w[at : at + size]
                for start in range(-size - slop, len(d) + slop):
                    hits = sum(x in d[max(0, start + o - slop) : max(0, start + o + slop + 1)] for o, x in enumerate(part))
                    if hits >= min(least, len(part)):
                        out[doc].add(item)
    return out


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    w = words(text)
    c = Counter(zip(w, w[1:], w[2:]))
    inside = {j + k for j in range(len(w) - 2) if c[tuple(w[j : j + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACE_WORDS.search(x)]
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text), len(lines) - len(set(lines)), len(inside)


def targets(sizes: dict, weights=(5, 2, 1), most: int = 3) -> dict:
    names = sorted(x for x in sizes if x is not None) + ([None] if None in sizes else [])
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    free, total = set(names), sum(sizes.values())
    while free:
        rest, w = total - sum(most * sizes[n] for n in names if n not in free), sum(weight[n] for n in free)
        over = {n for n in free if rest * weight[n] / w >= most * sizes[n]}
        if not over:
            break
        free -= over
    return {n: rest * weight[n] / w if n in free else most * sizes[n] for n in names}
