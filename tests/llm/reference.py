"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def shingles(text, n=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) or frozenset([tuple(w)])


def roots(ids, links):
    """Smallest id reachable from every id."""
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard_links(sets):
    index, out = defaultdict(list), []
    for i, own in sets.items():
        shared = Counter(j for s in own for j in index[s])
        out += [(i, j) for j, n in shared.items() if 100 * n >= 80 * (len(own) + len(sets[j]) - n)]
        for s in own:
            index[s].append(i)
    return out
