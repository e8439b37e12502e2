"""Plain versions of the operators, over lists of rows, for comparison."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def mixing_targets(sizes: dict):
    """Target of each source by giving out the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, out, open_ = 1.5 * sum(sizes.values()), {}, list(names)
    while open_:
        share = (total - sum(out.values())) / sum(weight[s] for s in open_)
        full = [s for s in open_ if share * weight[s] > 2 * sizes[s]]
        if not full:
            return out | {s: share * weight[s] for s in open_}
        out |= {s: 2.0 * sizes[s] for s in full}
        open_ = [s for s in open_ if s not in full]
    return out


def dedup_lines(docs):
    """(doc_id, text) to doc_id: (n_lines, n_dropped, kept text); ids differ."""
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate(A_Z)
    having = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            having[key(line)].add(i)
    out = {}
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 20 or len(having[key(x)]) < 3 or max(having[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def base_statistics(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
        len(w) < 20 or 100 * len(covered) > 30 * len(w),
    )


def dedup_substrings(docs, n=20):
    seen, out = set(), {}
    for i, text in sorted(docs):
        w = words(text)
        gone = set()
        for k in range(len(w) - n + 1):
            window = tuple(w[k : k + n])
            if window in seen:
                gone |= set(range(k, k + n))
            seen.add(window)
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), sha(" ".join(kept)))
    return out


def jaccard_components(docs, percent=85, size=4):
    sets = {}
    for i, text in docs:
        w = words((text or "").translate(A_Z))
        sets[i] = frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    holding = defaultdict(list)
    for i, s in sets.items():
        for token in s:
            holding[token].append(i)
    near = {i: Counter(j for t in s for j in holding[t] if j < i) for i, s in sets.items()}
    for i, found in near.items():
        for j, common in found.items():
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


_BASE = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def base_spans(text):
    out = []
    for kind, pattern in _BASE:
        for m in pattern.finditer(text or ""):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
                if not 13 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def top_k(vectors, k=5):
    """(vec_id, whole numbers) with ids that differ."""
    out = []
    for q, a in vectors:
        if q % 50 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), v) for v, b in vectors if v != q]
            out += [(q, r + 1, v, -s) for r, (s, v) in enumerate(sorted(scored)[:k])]
    return out
