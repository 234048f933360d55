"""Plain versions of what the operators compute."""

import re


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def shingles(text, k):
    words = space_words(lower(text))
    if len(words) >= k:
        return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return frozenset([tuple(words)] if words else [])


def near_duplicates(rows, k, percent):
    """{id: (set size, component, kept)} by all pairs; rows of one id are one document."""
    sets = {}
    for doc, text in rows:
        sets.setdefault(doc, []).append(shingles(text, k))
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {doc: (root(doc), root(doc) == doc) for doc in ids}


def edits(item, text):
    """Fewest edits of the whole item against any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        old, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(old[j - 1] + (a != b), old[j] + 1, row[-1] + 1))
    return min(row)
