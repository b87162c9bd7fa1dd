"""Plain versions of what the operators compute."""

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def word_sets(rows):
    out = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def linked_pairs(sets):
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        shared = collections.Counter(j for x in s for j in holders[x] if j > i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                yield i, j


def roots(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def similar_documents(rows):
    sets = word_sets(rows)
    root = roots(sets, linked_pairs(sets))
    return {i: (len(s), root[i]) for i, s in sets.items()}
