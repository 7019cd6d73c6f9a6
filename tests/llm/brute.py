"""Plain statements of the operators' rules, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return [] if text is None else [w.decode() for w in WORD.findall(text.encode())]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def repeated_words(docs, window=35):
    """{position in docs: (n_words, n_removed, digest of the kept words)}."""
    split = [words(t) for _, t in docs]
    count = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, split, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def repeated_bytes(docs, window=200):
    raw = [(t or "").encode() for _, t in docs]
    count = Counter(b[i:i + window] for b in raw for i in range(len(b) - window + 1))
    out = []
    for (doc_id, _), b in zip(docs, raw, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if count[b[i:i + window]] > 1:
                gone[i:i + window] = b"\x01" * window
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((doc_id, len(b), sum(gone), spans, sha(bytes(x for i, x in enumerate(b) if not gone[i]))))
    return out


def shingle_set(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text)) if text else []
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def near_groups(docs):
    """[(doc_id, n_shingles, component_id, kept)]: all pairs that share a shingle are compared."""
    sets = [(i, shingle_set(t)) for i, t in docs]
    at = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            at[x].append(k)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    shared = Counter()
    for ks in at.values():
        for a in range(len(ks)):
            for b in ks[a + 1:]:
                shared[ks[a], b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n):
            parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        r = root(k)
        least[r] = min(least.get(r, i), i)
    return [(i, len(s), least[root(k)], i == least[root(k)]) for k, (i, s) in enumerate(sets)]


def tokens(text):
    return [t for t in re.split(r"[\W_]+", (text or "").lower()) if t]


#: Places of a window of 8 tokens that one of the masks ignores.
IGNORED = ({2, 5, 6}, {1, 4, 5}, {2, 3, 4}, {1, 2, 3}, {3, 5, 6}, {1, 4, 6})


def leaks(docs, items):
    """{(doc_id, item_id, score)} over all diagonals with a window of 8 tokens that differs at ignored places alone. An
    overlap needs a score of 10 or of three fifths of the item's tokens; items of 3 to 7 tokens must be there whole,
    shorter ones don't count."""
    out = {}
    for doc_id, text in docs:
        h = tokens(text)
        for item_id, item in items:
            g = tokens(item)
            need = len(g) if len(g) < 8 else min(10, -(-3 * len(g) // 5))
            for d in range(-len(g), len(h)):
                places = range(max(0, -d), min(len(g), len(h) - d))
                differs = {j: g[j] != h[j + d] for j in places}
                run = best = 0
                for j in places:
                    run = max(0, run + (-1 if differs[j] else 1))
                    best = max(best, run)
                windows = ({p for p in range(8) if differs[j + p]} for j in places if j + 7 in differs)
                seen = len(g) < 8 or any(w <= x for w in windows for x in IGNORED)
                if len(g) >= 3 and best >= need and seen:
                    out[doc_id, item_id] = max(best, out.get((doc_id, item_id), 0))
    return out
