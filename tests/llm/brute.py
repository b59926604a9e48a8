"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import re
from itertools import combinations

import xxhash


def fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def link_fingerprints(prints):
    return [(i, j) for i, j in combinations(prints, 2) if (prints[i] ^ prints[j]).bit_count() <= 4]


def components_of(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {n: root(n) for n in nodes}


def shingles_of(text):
    words = re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]
