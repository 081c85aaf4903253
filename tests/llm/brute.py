"""Plain versions of what the operators compute, for small tables."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(lowered)


def shingles(text, width):
    w = words(text)
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def components(rows, num, den, width):
    """(doc_id, set size, least doc_id of the component) of each row."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both, union = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if sets[i] and sets[j] and den * both >= num * union:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return [(d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)]


def repeated_bytes(rows, length):
    """By row in order of ids: bytes, and a flag for each whether it is removed."""
    seen, out = set(), {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        out[doc_id] = raw, bytes(gone)
    return out
