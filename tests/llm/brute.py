"""Plain Python versions of the operators, for small inputs."""
import re
from collections import defaultdict

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def lower(text):
    return (text or "").translate(UP)


def exact(rows):
    """doc_id -> (keep_id, size) for (doc_id, text) with distinct ids."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    return {i: (max(g), len(g)) for g in groups.values() for i in g}


def hits(docs, items, window=13):
    """doc_id -> (n_words, hit positions, item ids)."""
    spans = defaultdict(set)
    for item, text in items:
        w = BENCH_WORD.findall(lower(text))
        size = min(window, len(w))
        for p in range(len(w) - size + 1 if size else 0):
            spans[tuple(w[p:p + size])].add(str(item) if item is not None else "")
    sizes = {len(s) for s in spans}
    out = {}
    for doc, text in docs:
        w = BENCH_WORD.findall(lower(text))
        at, found = set(), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                if (own := spans.get(tuple(w[p:p + size]))):
                    at |= set(range(p, p + size))
                    found |= own
        out[doc] = len(w), at, sorted(found)
    return out


def shingles(text, size):
    w = SPACE_WORD.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def near(rows, size, percent=80):
    """doc_id -> least id of its component."""
    own = [(i, shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in own}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(own):
        for j, b in own[:n]:
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: root(i) for i, _ in own}


def luhn(digits):
    total = 0
    for place, c in enumerate(reversed(digits)):
        n = int(c) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def pii(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(x) > 255 for x in m[0].split("."))
                    or kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out
