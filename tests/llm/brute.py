"""Plain versions of the operators for small tables."""

from itertools import combinations


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near(docs, k, percent):
    """{doc_id: component} and the set of links, over (doc_id, text) with distinct ids."""
    sets = {d: shingles(t, k) for d, t in docs}
    comp = {d: d for d in sets}
    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    links = set()
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            links.add((b, a))
            ra, rb = root(a), root(b)
            comp[max(ra, rb)] = min(ra, rb)
    return {d: root(d) for d in sets}, links


def repeated(texts, length):
    """For each text: (bytes, removed flags) by counting every string of ``length`` bytes."""
    from collections import Counter
    data = [(t or "").encode() for t in texts]
    n = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        flag = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if n[d[i:i + length]] > 1:
                flag[i:i + length] = b"\1" * length
        out.append((d, flag))
    return out
