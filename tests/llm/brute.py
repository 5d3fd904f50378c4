"""Plain single-process versions of the text operators, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

BLANK = r"[^\x20\x09-\x0D]+"


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def item_words(s):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(s or ""))


def runs_removed(parts_of_rows, n):
    """For rows of parts in order: which parts a run of n parts covers that started earlier."""
    seen, out = set(), []
    for parts in parts_of_rows:
        gone = [False] * len(parts)
        for j in range(len(parts) - n + 1):
            key = tuple(parts[j : j + n])
            if key in seen:
                gone[j : j + n] = [True] * n
            seen.add(key)
        out.append(gone)
    return out


def shingles(text, k):
    w = re.findall(BLANK, lower(text or ""))
    return frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components(sets, percent):
    """Smallest reachable index of each set."""
    parent = list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            o = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(sets))]


def contaminated(docs, items, n):
    """Per text: words, hit words, item ids."""
    windows = defaultdict(set)
    for item, text in items:
        w = item_words(text)
        for j in range(max(1, len(w) - n + 1) if w else 0):
            windows[tuple(w[j : j + n])].add(str(item))
    out = []
    for text in docs:
        w = item_words(text)
        hit, found = [0] * len(w), set()
        for size in set(map(len, windows)):
            for j in range(len(w) - size + 1):
                key = tuple(w[j : j + size])
                if key in windows:
                    found |= windows[key]
                    hit[j : j + size] = [1] * size
        out.append((len(w), sum(hit), len(found - {"None"}), ",".join(sorted(found - {"None"}))))
    return out


def secrets(text):
    found = []
    rules = [
        ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 20),
        ("hex", r"[0-9a-f]+", 0, 24),
    ]
    for at, (kind, pattern, group, least) in enumerate(rules):
        found += [(m.start(), at, kind, m.end()) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def bm25(docs, queries, k):
    """docs, queries: (id, text); lists (score, id) of the k best."""
    words = [(i, item_words(t)) for i, t in docs]
    full = [(i, w) for i, w in words if w]
    n, mean = len(full), sum(len(w) for _, w in full) / max(1, len(full))
    df = Counter(t for _, w in full for t in set(w))
    out = {}
    for q, text in queries:
        scores = []
        for i, w in full:
            c, s = Counter(w), 0.0
            for t in set(item_words(text)):
                if c[t]:
                    s += math.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * len(w) / mean))
            if s:
                scores.append((round(s, 9), i))
        out[q] = sorted(scores, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
    return out


def collocations(docs, top, support, longest, covered):
    """docs: (lang, text); rows (lang, rank, phrase, a, l, r, n, score)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        known = {p: c for p, c in counts.items() if len(p) > 1 and c >= support}
        inner = {p[i : i + s] for p, c in known.items() for s in range(2, len(p)) for i in range(len(p) - s + 1) if 100 * c >= covered * counts[p[i : i + s]]}
        best = []
        for p, a in known.items():
            if p not in inner:
                score, _, left, right = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return out
