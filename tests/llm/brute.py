"""Plain versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(lower(text))


def grams(text, n=5):
    w = words(lower(text))
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def near(rows, threshold=0.8):
    """(doc_id, class_id, n_links, copies) by comparing all n-gram sets that share an n-gram."""
    by_set = defaultdict(list)
    for i, t in rows:
        by_set[grams(t)].append(i)
    sets = list(by_set)
    where = defaultdict(set)
    for k, s in enumerate(sets):
        for g in s:
            where[g].add(k)
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = Counter()
    for k, s in enumerate(sets):
        common = Counter(j for g in s for j in where[g] if j < k)
        for j, c in common.items():
            if c >= threshold * (len(s) + len(sets[j]) - c) - 1e-9:
                links[k] += 1
                links[j] += 1
                root[find(k)] = find(j)
    least = {}
    for k, s in enumerate(sets):
        ids = [i for i in by_set[s] if i is not None]
        if ids:
            least[find(k)] = min(ids + [least.get(find(k), min(ids))])
    return sorted(
        ((i, least.get(find(k)), links[k], len(by_set[s])) for k, s in enumerate(sets) for i in by_set[s]), key=str
    )


def windows_removed(rows, n=50):
    """doc_id -> (words, removed places) of the substring dedup."""
    first = {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - n + 1):
            k = tuple(w[p : p + n])
            first[k] = min(first.get(k, i), i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = set()
        for p in range(len(w) - n + 1):
            if first[tuple(w[p : p + n])] < i:
                gone.update(range(p, p + n))
        out[i] = (w, gone)
    return out
