"""Plain Python versions of the corpus operators, for small tables."""

import hashlib
import re

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def jaccard(rows):
    """``[(doc_id, n_shingles, component_id)]`` of ``[(doc_id, text)]``."""
    sets = [shingles(t) for _, t in rows]
    groups = Groups()
    for i, a in enumerate(sets):
        groups.find(i)
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= 80 * (len(a) + len(sets[j]) - shared):
                groups.join(i, j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            root = groups.find(i)
            least[root] = min(least.get(root, doc), doc)
    return [
        (doc, len(sets[i]), least.get(groups.find(i)) if sets[i] else doc)
        for i, (doc, _) in enumerate(rows)
    ]


def repeats(rows, length=200):
    """``[(doc_id, n_bytes, n_removed, n_spans, kept bytes)]``."""
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for i, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            seen.setdefault(t[s : s + length], []).append((i, s))
    covered = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                covered[i][s : s + length] = b"\x01" * length
    out = []
    for (doc, _), t, c in zip(rows, texts, covered):
        spans = len(re.findall(b"\x01+", bytes(c)))
        kept = bytes(b for b, gone in zip(t, c) if not gone)
        out.append((doc, len(t), sum(c), spans, kept))
    return out


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
