"""Plain versions of the operators' rules, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

KINDS = ("email", "ip", "card", "phone")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def bag(text, n=5):
    w = words(text)
    return Counter(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else Counter()


def weighted_jaccard(a, b):
    both = sum((a & b).values())
    union = sum((a | b).values())
    return both / union if union else 0.0


def classes(n, linked):
    """Smallest member of each member's component."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def line_form(line):
    return re.sub(r"[ \t\x0b\x0c\r]+", " ", line.lower()).strip()


def line_shingles(line, width=5):
    return {line[k : k + width] for k in range(max(1, len(line) - width + 1))}


def windows(items, window=10):
    """Item ids of each window."""
    out = {}
    for item_id, item in items:
        x = words(item)
        for k in range(len(x) - window + 1 if len(x) >= window else bool(x)):
            out.setdefault(tuple(x[k : k + window]), set()).add(item_id)
    return out


def leaks(text, runs):
    """(n_words, n_hit, item ids) by looking up every run of words of a window's length."""
    w = words(text)
    hit, ids = set(), set()
    for n in {len(run) for run in runs}:
        for k in range(len(w) - n + 1):
            if found := runs.get(tuple(w[k : k + n])):
                hit.update(range(k, k + n))
                ids |= found
    return len(w), len(hit), ids


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (2 if k % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text):
    out = []
    # a text without @ has no match, and the plain pattern would take quadratic time to find out
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text if "@" in text else ""):
        out.append((0, m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, m.start(), m.end()))
    return sorted(out)


def span_text(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
