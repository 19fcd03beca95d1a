"""Plain-Python statements of what the operators must return."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, n):
    w = WORD.findall(ascii_lower(text))
    if len(w) < n:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def components(texts, n, pct):
    """doc_id -> smallest linked doc_id, by comparing all pairs."""
    sets = {i: shingles(t, n) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= pct * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def quality_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def replay(items, placed, capacity, per_source):
    """Place the items as given and assert that each went into a tightest of
    the compatible open bins, and into a new one only if there was none."""
    clusters = Counter(c for _, _, c in items)
    bins = {}
    for (size, source, cluster), (number, offset) in zip(items, placed, strict=True):
        fits = [b["left"] for b in bins.values() if b["left"] >= size and b["sources"][source] < per_source
                and not (cluster is not None and clusters[cluster] > 1 and cluster in b["clusters"])]
        b = bins.setdefault(number, {"left": capacity, "sources": defaultdict(int), "clusters": set()})
        assert offset == capacity - b["left"]
        assert b["left"] == min(fits) if offset else not fits
        assert b["sources"][source] < per_source and (cluster is None or cluster not in b["clusters"])
        b["left"] -= size
        b["sources"][source] += 1
        b["clusters"].add(cluster)
