"""Plain Python versions of the text operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def packed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def exact(rows):
    """{(doc_id, text): (keep_id, size)} and the kept doc ids; ids are distinct."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[packed(t)].append((-len(t or ""), i))
    out = {}
    for content, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            out[i] = (keep, len(members), i == keep, hashlib.sha256(content.encode()).hexdigest())
    return out


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def near(rows, threshold=0.8):
    """{doc_id: (class_id, copy_id, n_copies, n_links)}; ids are distinct."""
    copies = defaultdict(list)
    for i, t in rows:
        copies[tuple(words(t))].append(i)
    first = {min(v): k for k, v in copies.items()}
    sets = {i: shingles(" ".join(w)) for i, w in first.items() if w}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = Counter()
    for v in holders.values():
        v.sort()
        for k, b in enumerate(v):
            for a in v[:k]:
                common[a, b] += 1
    parent, links = {i: i for i in first}, Counter()

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if n >= threshold * (len(sets[a]) + len(sets[b]) - n):
            links[a] += 1
            links[b] += 1
            x, y = top(a), top(b)
            parent[max(x, y)] = min(x, y)
    return {i: (top(r), r, len(copies[w]), links[r]) for r, w in first.items() for i in copies[w]}


def mix(rows, weights=(5, 2, 1), share=1.5, repeats=2):
    """{doc_id: (size, source_size, target, taken)} for (doc_id, text, source) rows with distinct ids."""
    size = {i: len(words(t)) for i, t, _ in rows}
    source_of = {i: s for i, _, s in rows}
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(size[i] for i in size if source_of[i] == s) for s in sources}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    capped = set()
    while True:
        free = [s for s in sources if s not in capped]
        left = share * sum(total.values()) - sum(repeats * total[s] for s in capped)
        rate = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * rate >= repeats * total[s]}
        if not over:
            break
        capped |= over
    target = {s: float(repeats * total[s]) if s in capped else weight[s] * rate for s in sources}
    out = {}
    for s in sources:
        ids = [i for i in size if source_of[i] == s]
        passes = int(target[s] // total[s]) if total[s] else 0
        budget, run, taken = target[s] - passes * total[s], 0, set()
        for i in sorted((i for i in ids if size[i]), key=lambda i: hashlib.md5(f"mix:{i}".encode()).hexdigest()[:15]):
            if budget <= 0 or run >= budget:
                break
            if budget - run >= run + size[i] - budget:
                taken.add(i)
            run += size[i]
        out |= {i: (size[i], total[s], target[s], size[i] * (passes + (i in taken))) for i in ids}
    return out


def repeats(text, min_words):
    """Words covered by substrings of ``min_words`` words or more that occur twice, the longest such, words in repeated windows of 8."""
    w = words(text)
    n, longest, covered = len(w), 0, set()
    common = [[0] * (n + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(n - 1, i, -1):
            if w[i] == w[j]:
                k = common[i][j] = common[i + 1][j + 1] + 1
                if k >= min_words:
                    longest = max(longest, k)
                    covered.update(range(i, i + k))
                    covered.update(range(j, j + k))
    windows = Counter(tuple(w[i : i + 8]) for i in range(n - 7))
    in_window = {k for i in range(n - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    return len(covered), longest, len(in_window)
