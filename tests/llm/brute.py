"""The operators' contracts in plain Python, over lists of (doc_id, text)."""

import hashlib
import re
import struct

import xxhash

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def shingles(text, n=5):
    w = SPACED.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(docs, similarity=75):
    """{doc_id: smallest doc_id reached}, ids unique."""
    sets = {i: shingles(t) for i, t in docs}
    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = {(a, b) for ids in where.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= similarity * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in sets}


def passages(docs, window=50):
    """{doc_id: (kept words, words, removed)}, ids unique."""
    words = {i: SPACED.findall(t or "") for i, t in docs}
    first = {}
    for i, w in words.items():
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            first[g] = min(i, first.get(g, i))
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        out[i] = [x for k, x in enumerate(w) if k not in gone], len(w), len(gone)
    return out


def contamination(docs, items, window=13):
    """{doc_id: (words, hit, item ids, contaminated)}."""
    grams = {}
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[k:k + n]), set()).add("" if i is None else str(i))
    out = {}
    for i, t in docs:
        w, hit, ids = ALNUM.findall((t or "").translate(LOWER)), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit.update(range(k, k + n))
                    ids |= grams[tuple(w[k:k + n])]
        out[i] = len(w), len(hit), sorted(ids), 0 < len(hit) and 20 * len(hit) >= len(w)
    return out


def _signed(x, bits):
    return x - (1 << bits) if x >> (bits - 1) else x


def xx64(values):
    """The engine's 64-bit hash of strings and longs, one after another."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed)
    return _signed(seed, 64)


def murmur(values):
    """The engine's 32-bit hash of strings and longs, one after another."""
    def mixed(h, k):
        k = k * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        h ^= k * 0x1B873593 & 0xFFFFFFFF
        h = (h << 13 | h >> 19) & 0xFFFFFFFF
        return (h * 5 + 0xE6546B64) & 0xFFFFFFFF

    h = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<q", v)
        whole = len(raw) // 4 * 4
        for k in struct.unpack(f"<{whole // 4}I", raw[:whole]):
            h = mixed(h, k)
        for byte in raw[whole:]:
            h = mixed(h, _signed(byte, 8) & 0xFFFFFFFF)
        h ^= len(raw)
        for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            h = (h ^ h >> shift) * by & 0xFFFFFFFF
        h ^= h >> 16
    return _signed(h, 32)


def closed_syncmers(text, k=6, s=2, unit=16):
    """Hashes of the k consecutive units whose smallest s consecutive ones are the first or the last."""
    units = re.findall(rf"[^\x20\x09-\x0D]{{1,{unit}}}", text or "")
    out = []
    for i in range(len(units) - k + 1):
        inner = [xx64([xx64([u]) for u in units[j:j + s]]) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(murmur(inner[::s]))
    return out or ([murmur([text])] if text else [])


def jaccard(a, b):
    return len({*a} & {*b}) / len({*a} | {*b}) if a or b else 1.0
