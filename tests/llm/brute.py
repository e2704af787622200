"""Plain Python versions of the operators' contracts."""

import collections
import re

LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text, n):
    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1)))


def components(docs, n, percent):
    """{doc_id: smallest reachable doc_id} by comparing all pairs."""
    sets = {i: shingles(t, n) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def contamination(docs, items, window=10):
    """{doc_id: (n_words, hit word positions, item ids)}."""
    phrases = collections.defaultdict(set)
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        for k in range(max(1, len(words) - window + 1) if words else 0):
            phrases[tuple(words[k : k + window])].add(str(item))
    out = {}
    for i, text in docs:
        words, hit, found = ALNUM.findall((text or "").translate(LOWER)), set(), set()
        for k in range(len(words)):
            for n in {len(p) for p in phrases}:
                p = tuple(words[k : k + n])
                if len(p) == n and p in phrases:
                    hit.update(range(k, k + n))
                    found |= phrases[p]
        out[i] = (len(words), hit, found)
    return out


def passages(docs, least):
    """{doc_id: [(start, end, words, units, first doc)]} for documents in rank order."""
    first, out = {}, {}
    for i, text in sorted((i, t or "") for i, t in docs):
        edges = [0, *(m.end() for m in re.finditer(r"\n|(?<=[.!?]) ", text))]
        edges += [len(text)] * (edges[-1] != len(text))
        runs, last, k = [], None, 0
        for a, b in zip(edges, edges[1:]):
            words = tuple(ALNUM.findall(text[a:b].translate(LOWER)))
            if not words:
                continue
            k += 1
            seen = first.setdefault(words, (i, k))
            if seen != (i, k):
                if last == k - 1:
                    runs[-1] = (runs[-1][0], b, runs[-1][2] + len(words), runs[-1][3] + 1, min(runs[-1][4], seen[0]))
                else:
                    runs.append((a, b, len(words), 1, seen[0]))
                last = k
        out[i] = [r for r in runs if r[2] >= least]
    return out


def without(text, spans):
    """The text without spans, which are in order and apart."""
    parts, at = [], 0
    for start, end in spans:
        parts.append(text[at:start])
        at = end
    return "".join([*parts, text[at:]])


def spans_to_remove(text, hit, whole):
    """Character spans of whole-unit passages and of runs of hit words, those that meet in words made one."""
    words = [m.span() for m in ALNUM.finditer(text.translate(LOWER))]
    parts = [(k, k + 1, *words[k]) for k in hit]
    for a, b, *_ in whole:
        inside = [k for k, (x, _) in enumerate(words) if a <= x < b]
        parts.append((inside[0], inside[-1] + 1, a, b))
    out = []
    for first, stop, a, b in sorted(parts):
        if out and first <= out[-1][0]:
            out[-1] = (max(stop, out[-1][0]), min(a, out[-1][1]), max(b, out[-1][2]))
        else:
            out.append((stop, a, b))
    return [x[1:] for x in out]


def repeated_words(docs, n):
    """{doc_id: word numbers in windows of n words that stand earlier, too} for documents in rank order."""
    first, out = {}, {}
    for i, text in sorted((i, t or "") for i, t in docs):
        words, hit = ALNUM.findall(text.translate(LOWER)), set()
        for k in range(len(words) - n + 1):
            j, at = first.setdefault(tuple(words[k : k + n]), (i, k))
            if j != i or k - at >= n:
                hit.update(range(k, k + n))
        out[i] = hit
    return out


def base_statistics(text):
    words = SPACED.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACED.search(x)]
    count, hit = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7)), set()
    for k in range(len(words) - 7):
        if count[tuple(words[k : k + 8])] > 1:
            hit.update(range(k, k + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), len(words) < 20 or 100 * len(hit) > 30 * len(words)
