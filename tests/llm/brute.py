"""Plain-Python statements of what the operators return, for small inputs."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(fold(text))


def shingles(text, width=5):
    w = words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def jaccard(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if both else 0.0


def classes(rows, at_least=0.8):
    """{(key, text): least key} of the connected components of equal texts and similar pairs."""
    texts = {}
    for k, t in rows:
        texts.setdefault(t or "", []).append(k)
    names = list(texts)
    sets = [shingles(t) for t in names]
    up = list(range(len(names)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    pairs = {(a, b) for own in where.values() for a in own for b in own if a < b}
    for a, b in pairs:
        if jaccard(sets[a], sets[b]) >= at_least - 1e-12:
            up[find(a)] = find(b)
    least = {}
    for i, t in enumerate(names):
        ks = [k for k in texts[t] if k is not None]
        if ks:
            least[find(i)] = min(least.get(find(i), min(ks)), min(ks))
    return {(k, t): least.get(find(i)) for i, t in enumerate(names) for k in texts[t]}


def removed_lines(rows, order, min_words=1):
    """{(key, text): line numbers removed}; ``order`` sorts distinct (key, text) pairs."""
    lines = []
    for k, t in sorted({r for r in rows if r[1] is not None}, key=order):
        for i, line in enumerate(t.split("\n")):
            w = words(line)
            if len(w) >= min_words:
                lines.append((k, t, i, frozenset(w)))
    out, seen, by_word = {}, [], {}
    for k, t, i, s in lines:
        near = {j for w in s for j in by_word.get(w, ())}
        hit = any(5 * len(s & seen[j]) >= 4 * len(s | seen[j]) for j in near)
        if hit:
            out.setdefault((k, t), set()).add(i)
        for w in s:
            by_word.setdefault(w, []).append(len(seen))
        seen.append(s)
    return out


def hits(text, items, width=10):
    """(words, hit words, sorted item ids)."""
    w = ALNUM.findall(fold(text))
    mark, found = set(), set()
    for name, t in items:
        v = ALNUM.findall(fold(t))
        n = min(width, len(v))
        for i in range(len(v) - n + 1 if v else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == v[i:i + n]:
                    mark.update(range(j, j + n))
                    found.add("null" if name is None else str(name))
    return len(w), len(mark), sorted(found)


def repeats(text):
    w = WORD.findall(text or "")
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(tri)
    return len({p for i, g in enumerate(tri) if n[g] > 1 for p in (i, i + 1, i + 2)})
