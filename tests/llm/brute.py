"""Plain Python versions of the query contracts, for small fixtures."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NON_ASCII_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def low_words(text):
    return NON_ASCII_WORDS.findall((text or "").translate(LOWER))


def contamination(texts, items):
    """texts: list; items: (item_id, text). -> (n_words, n_hit, n_items, sha, contaminated)"""
    windows = defaultdict(set)
    for item, text in items:
        w = low_words(text)
        if item is None or not w:
            continue
        for i in range(max(1, len(w) - 9)):
            windows[tuple(w[i : i + 10])].add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for text in texts:
        w, hit, found = low_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                ids = windows.get(tuple(w[i : i + n]))
                if ids:
                    found |= ids
                    hit |= set(range(i, i + n))
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def secrets(text):
    text, spans = text or "", []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 6:
            spans.append((m.start(), 0, m.end(), "assign"))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            spans.append((m.start(), 1, m.end(), "access"))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 24:
            spans.append((m.start(), 2, m.end(), "hex"))
    spans.sort()
    listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
    return (*(sum(s[1] == k for s in spans) for k in range(3)), sha(listed))


def repeats(rows, window=20):
    """rows: (doc_id, text) -> (n_words, n_removed, sha of kept), null ids last."""
    split = [(float("inf") if i is None else i, SPACE_WORDS.findall(t or "")) for i, t in rows]
    first = {}
    for doc, w in split:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, (doc, i)), (doc, i))
    out = []
    for doc, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (doc, i):
                gone |= set(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), sha(" ".join(kept))))
    return out


def quality(text):
    text = text or ""
    w = SPACE_WORDS.findall(text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            hit |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if SPACE_WORDS.search(x)]
    n = len(w)
    return (
        n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
        n < 10 or 100 * len(hit) > 20 * n,
    )


def licenses(text):
    w, places, labels = low_words(text), [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        parts = phrase.split()
        for i in range(len(w)):
            if w[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return (
        len(w), len(places), min(places) if places else None, max(places) if places else None, ",".join(sorted(labels)),
    )


def shingle_set(text):
    w = SPACE_WORDS.findall((text or "").translate(LOWER))
    if len(w) < 3:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(w, w[1:], w[2:]))


def jaccard(rows):
    """rows: (doc_id, text) -> (n_shingles, component_id); null ids link nothing."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    live = [i for i, (d, _) in enumerate(rows) if d is not None and sets[i]]
    for x, i in enumerate(live):
        for j in live[:x]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i in live:
        least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return [
        (len(s), None if rows[i][0] is None else least[root(i)] if i in set(live) else rows[i][0]) for i, s in enumerate(sets)
    ]
