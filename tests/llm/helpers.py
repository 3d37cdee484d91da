"""Brute-force versions and small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs_frame(spark, rows):
    """Documents of (id, text) pairs with the other columns filled in."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)


def words(text, pattern="[^\x20\x09-\x0d]+"):
    return re.findall(pattern, text or "")


def contamination(text, items, size=13):
    pattern = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    w = words((text or "").translate(LOWER), pattern)
    hit, found = set(), set()
    for item_id, item in items:
        iw = words((item or "").translate(LOWER), pattern)
        k = min(size, len(iw))
        for i in range(len(iw) - k + 1 if k else 0):
            for j in range(len(w) - k + 1):
                if w[j : j + k] == iw[i : i + k]:
                    hit.update(range(j, j + k))
                    found.add(str(item_id))
    return len(w), len(hit), sorted(found)


def repeated(text):
    w = words(text)
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    return len({i + d for own in at.values() if len(own) > 1 for i in own for d in range(3)})


def shingles(text, k):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def near_components(rows, k=3, share=85):
    """(set size, smallest reachable id) of each id, by comparing all sets that share a shingle."""
    sets = {i: shingles(t, k) for i, t in rows}
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        common = defaultdict(int)
        for x in s:
            for j in by[x]:
                if j < i:
                    common[j] += 1
        for j, n in common.items():
            if 100 * n >= share * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}
            if good[kind]:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()
