"""Plain versions of the operators, to hold them against."""

from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    k = min(k, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def near_components(rows, k, percent=80):
    """component by doc_id; rows are (doc_id, text)."""
    parent = {i: i for i, _ in rows if i is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def union(a, b):
        a, b = sorted((find(a), find(b)))
        parent[b] = a

    sets = [(i, s) for i, t in rows if i is not None and (s := shingles(t, k))]
    held = defaultdict(list)
    for n, (i, s) in enumerate(sets):
        common = Counter(m for g in s for m in held[g])
        for m, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[m][1]) - c):
                union(i, sets[m][0])
        for g in s:
            held[g].append(n)
    return {i: find(i) for i in parent}
