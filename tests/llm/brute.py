"""Plain versions of what the queries return, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(UPPER)


def decontaminated(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = WORDS.findall(lower(text))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add("" if item is None else str(item))
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in docs:
        w, hit, found = WORDS.findall(lower(text)), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (own := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[own]
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def shingles(text):
    w = BLANK.findall(lower(text))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def near_duplicates(docs):
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def top(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    by = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            by[x].append(k)
    shared = Counter((a, b) for own in by.values() for i, a in enumerate(own) for b in own[i + 1 :]) if max(map(len, by.values()), default=0) < 400 else None
    pairs = shared.items() if shared is not None else (((a, b), len(sets[a] & sets[b])) for a in range(len(docs)) for b in range(a + 1, len(docs)) if sets[a] and sets[b])
    for (a, b), n in pairs:
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            parent[top(a)] = top(b)
    least = {}
    for k, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[top(k)] = min(doc_id, least.get(top(k), doc_id))
    return [(doc_id, len(sets[k]), least.get(top(k))) for k, (doc_id, _) in enumerate(docs)]


def held_out(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 4 == 2
