"""Plain forms of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def decontamination(docs, items):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows: dict[tuple, set] = {}
    for name, text in items:
        w = word.findall((text or "").translate(LOWER))
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add("" if name is None else str(name))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w = word.findall((text or "").translate(LOWER))
        hit, names = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    names |= found
        out.append((doc, len(w), len(hit), len(names), sha(",".join(sorted(names)).encode()),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    grams = [words[i:i + 4] for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(" ".join(g).encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash(docs):
    docs = [(d, fingerprint(t)) for d, t in docs]
    distinct = sorted({f for _, f in docs})
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    least: dict[int, int] = {}
    for d, f in docs:
        if d is not None:
            r = root(f)
            least[r] = min(least.get(r, d), d)
    return [(d, f"{f:016x}", least.get(root(f))) for d, f in docs]


def tokens(docs, library):
    out, start = [], 0
    for doc, text in sorted(docs, key=lambda d: d[0]):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def repeats(docs, length=400):
    texts = [(d, (t or "").encode()) for d, t in docs]
    seen: dict[bytes, int] = {}
    for _, t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
    out = []
    for d, t in texts:
        cover = bytearray(len(t))
        end = 0
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                for j in range(max(i, end), i + length):
                    cover[j] = 1
                end = i + length
        spans = sum(1 for i, c in enumerate(cover) if c and not (i and cover[i - 1]))
        out.append((d, len(t), sum(cover), spans, sha(bytes(b for b, c in zip(t, cover) if not c))))
    return out
