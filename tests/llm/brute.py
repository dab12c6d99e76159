"""Plain versions of the corpus operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.find(x), self.find(y)))
        self.parent[y] = x


def near_duplicates(texts, size=5, similarity=0.8):
    """Number of the first text of each text's group."""
    sets, posting = [], defaultdict(list)
    for i, text in enumerate(texts):
        w = words(text)
        sets.append(Counter(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else Counter())
        for s in sets[-1]:
            posting[s].append(i)
    union = Union()
    pairs = {(a, b) for p in posting.values() for a in p for b in p if a < b}
    for a, b in pairs:
        if sum((sets[a] & sets[b]).values()) >= similarity * sum((sets[a] | sets[b]).values()):
            union.join(a, b)
    same = {}
    for i, text in enumerate(texts):
        if text is not None and not sets[i]:
            union.join(i, same.setdefault(text, i))
    return [union.find(i) for i in range(len(texts))]


def contamination(texts, items, size=13, share=20):
    """(n_words, n_hit, n_items, items_sha256, contaminated) of each text; items: (id, text)."""
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[k : k + size])].add(item)
    out = []
    for text in texts:
        w = words(text)
        hit, found = [0] * len(w), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[k : k + n])):
                    found |= ids
                    hit[k : k + n] = [1] * n
        digest = hashlib.sha256(",".join(sorted(str(i) for i in found if i is not None)).encode()).hexdigest()
        out.append((len(w), sum(hit), len(found), digest, sum(hit) > 0 and share * sum(hit) >= len(w)))
    return out


def base_spans(text):
    text = text or ""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def links(vectors, cosine=0.95):
    """(links of each vector, number of the first vector of its component); None links with nothing."""
    import numpy as np

    counts, union = [0] * len(vectors), Union()
    for a, x in enumerate(vectors):
        for b, y in enumerate(vectors[:a]):
            if x is not None and y is not None and len(x) == len(y):
                x, y = np.asarray(x, float), np.asarray(y, float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    counts[a] += 1
                    counts[b] += 1
                    union.join(a, b)
    return counts, [union.find(i) for i in range(len(vectors))]
