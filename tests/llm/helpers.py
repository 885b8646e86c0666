"""Brute-force versions of the operators' contracts, and small tables with awkward rows."""

import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def documents(spark, rows, extra=()):
    """A documents table; extra adds columns whose names clash with the operators' own."""
    data = [(i, t, "en", "src0", None if t is None else len(t)) + tuple(0 for _ in extra) for i, t in rows]
    return spark.createDataFrame(data, DOCUMENTS + "".join(f", {c} long" for c in extra))


def substring_dedup(rows, width=100):
    """(n_bytes, n_removed, n_spans, sha256) of each (doc_id, text), by looking at every string."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        hit = bytearray(len(raw))
        for s in range(len(raw) - width + 1):
            w = raw[s : s + width]
            if w in seen:
                hit[s : s + width] = b"\1" * width
            seen.add(w)
        kept = bytes(b for b, h in zip(raw, hit) if not h)
        spans = len(re.findall(b"\1+", bytes(hit)))
        out[i] = (len(raw), sum(hit), spans, hashlib.sha256(kept).hexdigest())
    return out


def fingerprint(text):
    words = WORD.findall(low(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps):
    """{doc_id: (fp, component)} by comparing all pairs."""
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (f"{fps[i]:016x}", find(i)) for i in ids}


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def decontaminate(docs, bench):
    """{doc_id: (n_words, n_hit, n_items, sha, contaminated)}."""
    wins = {}
    for item, t in bench:
        w = BENCH_WORD.findall(low(t or ""))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k : k + n]), set()).add(item)
    sizes = {len(k) for k in wins}
    out = {}
    for i, t in docs:
        w = BENCH_WORD.findall(low(t or ""))
        hit, items = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                got = wins.get(tuple(w[k : k + n]))
                if got:
                    hit |= set(range(k, k + n))
                    items |= got
        sha = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
        out[i] = (len(w), len(hit), len(items), sha, bool(hit) and 20 * len(hit) >= len(w))
    return out
