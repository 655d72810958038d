"""Plain versions of the operators, one document after the other."""

import re
from collections import Counter

_LOW = {i: i + 32 for i in range(65, 91)}


def low(text):
    return (text or "").translate(_LOW)


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near_components(docs, percent=85):
    """{row number: (set size, smallest id reachable)} of a list of (id, text)."""
    sets = [shingles(t) for _, t in docs]
    holders, parent = {}, list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, own in enumerate(sets):
        for s in own:
            holders.setdefault(s, []).append(i)
    for i, own in enumerate(sets):
        for j, common in Counter(j for s in own for j in holders[s] if j > i).items():
            if 100 * common >= percent * (len(own) + len(sets[j]) - common):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(docs):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return {i: (len(sets[i]), least.get(root(i))) for i in range(len(docs))}


def hits(docs, items, size=10):
    """{row number: (words, hit words, sorted items)}."""

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))

    windows = {}
    for key, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1)) if w else []:
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(key))
    sizes, out = {len(w) for w in windows}, {}
    for row, (_, text) in enumerate(docs):
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (x := tuple(w[i : i + n])) in windows:
                    found |= windows[x]
                    hit.update(range(i, i + n))
        out[row] = (len(w), len(hit), sorted(found))
    return out
