"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

OP1_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
OP3_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def lower(text: str | None) -> str:
    return (text or "").translate(_LOWER)


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def contamination(docs: list[tuple], items: list[tuple], span: int = 10) -> list[tuple]:
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = OP1_WORD.findall(lower(text))
        if item is None or not w:
            continue
        n = min(span, len(w))
        for i in range(len(w) - n + 1):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    lengths = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w = OP1_WORD.findall(lower(text))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i:i + n]))
                if got:
                    found |= got
                    hit |= set(range(i, i + n))
        names = ",".join(sorted(str(x) for x in found))
        out.append((doc, len(w), len(hit), len(found), sha(names), bool(hit)))
    return out


def shingles(text: str | None, k: int) -> frozenset:
    w = OP3_WORD.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def jaccard_components(docs: list[tuple], k: int, num: int, den: int) -> list[tuple]:
    sets = [shingles(t, k) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(docs)):
        for j in range(i):
            if not sets[i] or not sets[j]:
                continue
            if min(len(sets[i]), len(sets[j])) * den < max(len(sets[i]), len(sets[j])) * num:
                continue
            common = len(sets[i] & sets[j])
            if den * common >= num * (len(sets[i]) + len(sets[j]) - common):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    low: dict[int, int] = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            low[root(i)] = min(low.get(root(i), doc), doc)
    return [(doc, len(sets[i]), low.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(docs)]


def remove_repeats(docs: list[tuple], length: int = 100) -> list[tuple]:
    """docs in any order; a null id sorts last."""
    first: dict[bytes, tuple] = {}
    bodies = [((1 << 63) - 1 if d is None else d, (t or "").encode()) for d, t in docs]
    for doc, body in bodies:
        for p in range(len(body) - length + 1):
            key = body[p:p + length]
            if key not in first or (doc, p) < first[key]:
                first[key] = (doc, p)
    out = []
    for (name, _), (doc, body) in zip(docs, bodies):
        gone = bytearray(len(body))
        for p in range(len(body) - length + 1):
            if first[body[p:p + length]] < (doc, p):
                gone[p:p + length] = b"\x01" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((name, len(body), sum(gone), spans, sha(kept)))
    return out
