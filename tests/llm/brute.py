"""The operators' results by the plainest means, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def crc(value) -> int:
    return zlib.crc32(("" if value is None else str(value)).encode())


def base_scores(rows):
    """op1: ``{index: (held_out, n_tokens, n_known, train_tokens, base_score)}``"""
    tokens = [[*WORD.findall((t or "").translate(LOWER)), ""] for _, t in rows]
    counts = Counter(w for (i, _), words in zip(rows, tokens) if crc(i) % 7 != 2 for w in words)
    n, v = sum(counts.values()), len(counts)
    return [
        (i, crc(i) % 7 == 2, len(words), sum(counts[w] > 0 for w in words), n,
         sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        for (i, _), words in zip(rows, tokens)
    ]


def base_spans(text):
    """op4: the fixed kinds."""
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(reversed(digits))]
        if 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def pii(rows):
    out = []
    for i, text in rows:
        spans = base_spans(text)
        kinds = Counter(kind for kind, _, _ in spans)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        out.append((i, *[kinds[k] for k in ("email", "ip", "card", "phone")], sha256(listed), listed))
    return out


def contamination(rows, items, size=13):
    windows = defaultdict(set)
    for item, text in items:
        words = LETTERS.findall((text or "").translate(LOWER))
        for k in range(max(1, len(words) - size + 1) if words else 0):
            windows[tuple(words[k : k + size])].add(item)
    sizes, out = {len(w) for w in windows}, []
    for i, text in rows:
        words = LETTERS.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(words[k : k + n])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((i, len(words), len(hit), len(ids), sha256(",".join(ids)), bool(hit) and 20 * len(hit) >= len(words)))
    return out


def quality(text):
    """op6: words, characters in them, symbols, repeated lines, words in repeated windows, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    repeated = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
    return (*counts, len(words) < 20 or 100 * len(repeated) > 30 * len(words))


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))) if words else frozenset()


def components(nodes, links):
    """``{node: smallest node reachable}``"""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def near_duplicates(rows):
    """op7 for rows with different ids."""
    sets = {i: shingles(t) for i, t in rows}

    def similar(a, b):
        common = len(sets[a] & sets[b])
        return common and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common)

    found = components(sets, [(a, b) for a, b in combinations(sets, 2) if similar(a, b)])
    return [(i, len(sets[i]), found[i], found[i] == i) for i, _ in rows]
