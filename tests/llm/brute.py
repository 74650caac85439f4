"""Plain versions that the operators are held against."""

from __future__ import annotations

import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def fingerprint(text):
    w = words(text)
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(grams))


def components(prints):
    """Smallest id reachable over links of two bits, for a list of (id, fingerprint)."""
    label = [i for i, _ in prints]
    changed = True
    while changed:
        changed = False
        for a in range(len(prints)):
            for b in range(len(prints)):
                if (prints[a][1] ^ prints[b][1]).bit_count() <= 2 and label[b] > label[a]:
                    label[b] = label[a]
                    changed = True
    return label


def repeats(rows):
    """doc_id -> (bytes, removed, spans, digest) for a list of (id, text)."""
    texts = sorted((i, (t or "").encode()) for i, t in rows)
    first = {}
    for i, t in texts:
        for p in range(len(t) - 49):
            first.setdefault(t[p : p + 50], i)
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, x in zip(t, gone, strict=True) if not x)
        spans = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
    return row[-1]
