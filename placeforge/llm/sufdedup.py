"""Exact substring dedup over all documents by external induced sorting of candidate passages.

A byte goes when a string of `width` bytes over it also starts earlier in the corpus. Every such string holds
one anchor, the gram with the least hash in it, and equal strings have equal anchors at equal places; so the
starts of a text fall into runs with one anchor, and the bytes under a run are its passage.

1. Runs are keyed by their anchor. A run whose anchor is nowhere else can't match and ends here. Of runs with
   equal passages the first stays and the starts of the others are covered.
2. Different passages under one anchor meet in one place, by anchor and by the half of the string beside it,
   and all their suffixes are sorted by external induced sorting (module induced). Neighbours in that order
   that share `width` bytes are one string; all but its first start are covered. A sort is in memory. Where the
   passages of one key have more than `hot_bytes`, its strings are not sorted there: each goes by a hash of all its
   `width` bytes, and equal ones meet as equal passages do in step 1.
3. Covered starts go back to their documents, where the bytes are removed.

Before anything is shuffled by anchor, each task keeps one run for each passage it has seen, so a passage that
stands in a third of all documents sends one row from each task.

Defined results: null texts are empty; texts shorter than the width lose nothing. Earlier means smaller
doc_id (null last), then the text's hash where a doc_id repeats, then the start. Of rows alike in doc_id and
text the first is judged as if alone and the others are copies of it. Extra columns are ignored. Offsets are bytes of UTF-8; matches never cross documents.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import durable, bounded_batches
from placeforge.llm.induced import END, SEPARATOR, equal_next, suffix_order

WIDTH = 100
GRAM = 32
#: Bytes hashed at a time; longer texts are cut into pieces that overlap by width - 1.
PIECE = 1 << 18
_BITS = 21
#: Runs that a task holds before it sends them on.
HELD_RUNS = 150_000
#: Bytes of passages that one sort takes, unless one key alone has more.
SORT_BYTES = 1 << 20
#: Bytes of passages under one key from which its strings are dealt out one by one.
HOT_BYTES = 4 << 20
#: Bits for the number of starts of a run; what is above them is the anchor's distance from the first.
STARTS = 15
MOST_WIDTH = (1 << STARTS) - 1
#: Row ids have 62 bits; this one says that the doc_id is null, and puts the row after all others.
LAST, NULL_ID = (1 << 63) - 1, 1 << 62

_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int) -> np.ndarray:
    if base not in _POWERS:
        p = np.full(PIECE + 2, base, dtype=np.uint64)
        p[0] = 1
        _POWERS[base] = np.multiply.accumulate(p)
    return _POWERS[base]


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A mixed rolling hash of each gram."""
    n = len(raw)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE)[:n], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * _powers(pow(_BASE, -1, 1 << 64))[: n - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def runs(pieces: list[bytes], width: int = WIDTH, gram: int = GRAM):
    """For texts of at most PIECE bytes together: piece, anchor hash, first start, last start, anchor."""
    buf = b"".join(pieces)
    lens = np.array([len(p) for p in pieces], dtype=np.int64)
    end = np.cumsum(lens)
    none = np.zeros(0, dtype=np.int64)
    if len(buf) < width:
        return none, none.astype(np.uint64), none, none, none, buf
    h = gram_hashes(np.frombuffer(buf, dtype=np.uint8), gram)
    low = np.uint64((1 << _BITS) - 1)
    m = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # the leftmost of equals wins
    reach, w = width - gram + 1, 1
    while 2 * w <= reach:
        m = np.minimum(m[:-w], m[w:])
        w *= 2
    if reach > w:
        m = np.minimum(m[: w - reach], m[reach - w :])
    start = np.arange(len(m))
    owner = np.repeat(np.arange(len(pieces)), lens)[: len(m)]
    ok = start + width <= end[owner]
    start, anchor, owner = start[ok], (m[ok] & low).astype(np.int64), owner[ok]
    if len(start) == 0:
        return none, none.astype(np.uint64), none, none, none, buf
    i = np.nonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))[0]
    last = start[np.concatenate([i[1:] - 1, [len(start) - 1]])]
    return owner[i], h[anchor[i]], start[i], last, anchor[i], buf


def _batches(ids: list, rids: list, texts: list, width: int):
    """Pieces of at most PIECE bytes with their document and offset."""
    docs: list[tuple[int, int, int]] = []
    pieces: list[bytes] = []
    size = 0
    for d, r, t in zip(ids, rids, texts, strict=True):
        raw = (t or "").encode("utf-8", "surrogatepass")
        at = 0
        while len(raw) - at >= width:
            p = raw[at : at + PIECE]
            if size + len(p) > PIECE:
                yield docs, pieces
                docs, pieces, size = [], [], 0
            docs.append((d, r, at))
            pieces.append(p)
            size += len(p)
            at += len(p) - width + 1
            if at + width - 1 >= len(raw):
                break
    if pieces:
        yield docs, pieces


_RUN_SCHEMA = "h long, c long, doc long, rid long, s long, n int"


def _table(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "c", "doc", "rid", "s", "n"])


def _settle(h, c, doc, rid, s, n):
    """Sort runs; the first of equal passages stays (n > 0), the others are covered (n < 0).

    A positive n holds the number of starts in its low STARTS bits and the anchor's distance from the first above them.
    """
    order = np.lexsort((s, rid, doc, c, h))
    cols = [x[order] for x in (h, c, doc, rid, s, n)]
    alike = np.ones(len(order), dtype=bool)  # the same run of rows that are alike
    alike[:1] = False
    for x in cols[:5]:
        alike[1:] &= x[1:] == x[:-1]
    h, c, doc, rid, s, n = (x[~alike] for x in cols)
    again = np.concatenate([[False], (h[1:] == h[:-1]) & (c[1:] == c[:-1])])
    return h, c, doc, rid, s, np.where(again, -(n & MOST_WIDTH), n)


def _settled(held: list[tuple]) -> pa.RecordBatch:
    """What a task sends on of the runs it holds."""
    h, c, doc, rid, s, n = _settle(*(np.concatenate([x[k] for x in held]) for k in range(6)))
    # Covered rows need no anchor; their key is spread.
    h = np.where(n < 0, ((doc ^ rid) * -7046029254386353131) ^ s, h)
    return _table(h, np.where(n < 0, 0, c), doc, rid, s, n.astype(np.int32))


def _find_runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    count = 0

    for b in batches:
        for docs, pieces in _batches(*(x.to_pylist() for x in b.columns), width):
            owner, h, first, last, anchor, buf = runs(pieces, width)
            if len(owner) == 0:
                continue
            digest = xxhash.xxh3_64_intdigest
            c = np.array([digest(buf[x : y + width], z) for x, y, z in zip(first.tolist(), last.tolist(), (anchor - first).tolist(), strict=True)], dtype=np.uint64)
            d = np.array(docs, dtype=np.int64)[owner]
            start = np.concatenate([[0], np.cumsum([len(p) for p in pieces])[:-1]])
            held.append((h.view(np.int64), c.view(np.int64), d[:, 0], d[:, 1], d[:, 2] + first - start[owner], (last - first + 1) | (anchor - first) << STARTS))
            count += len(owner)
            if count >= HELD_RUNS:
                yield _settled(held)
                held, count = [], 0
    if held:
        yield _settled(held)


def _find_strings(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Each string of passages under hot keys as a run of one start, keyed by 128 bits of its hash."""
    held: list[tuple] = []
    count = 0
    digest, low = xxhash.xxh3_128_intdigest, (1 << 64) - 1
    for b in batches:
        for d, r, s, n, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
            found = [digest(text[k : k + width]) for k in range(n)]
            h, c = (np.array(x, dtype=np.uint64).view(np.int64) for x in ([y >> 64 for y in found], [y & low for y in found]))
            held.append((h, c, np.full(n, d, dtype=np.int64), np.full(n, r, dtype=np.int64), s + np.arange(n), np.ones(n, dtype=np.int64)))
            count += n
            if count >= HELD_RUNS:
                yield _settled(held)
                held, count = [], 0
    if held:
        yield _settled(held)


def _match_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From runs sorted by anchor, passage and place: covered runs, and first runs whose anchor is shared.

    Between batches one row is kept: the only passage so far of the last anchor, until a second one comes.
    """
    last: tuple | None = None
    shared, pending = False, None
    for b in batches:
        cols = [x.to_numpy() for x in b.columns]
        gone = cols[5] < 0
        if gone.any():
            yield _table(*(x[gone] for x in cols))
            cols = [x[~gone] for x in cols]
        h, c, n = cols[0], cols[1], cols[5]
        if len(h) == 0:
            continue
        same_h = np.concatenate([[last is not None and h[0] == last[0]], h[1:] == h[:-1]])
        same_c = np.concatenate([[last is not None and c[0] == last[1]], c[1:] == c[:-1]]) & same_h
        alike = same_c.copy()
        for k in (2, 3, 4):
            alike &= np.concatenate([[last is not None and cols[k][0] == last[k]], cols[k][1:] == cols[k][:-1]])
        group = np.cumsum(~same_h)
        kinds = np.bincount(group, weights=~same_c).astype(np.int64)
        if same_h[0]:
            kinds[0] += 2 if shared else 1
            if pending is not None and kinds[0] >= 2:
                yield _table(*(np.array([x]) for x in pending))
                pending = None
        out = np.nonzero((same_c | (kinds[group] >= 2)) & ~alike)[0]
        if len(out):
            sent = [x[out] for x in cols]
            sent[5] = np.where(same_c[out], -(sent[5] & MOST_WIDTH), sent[5])
            yield _table(*sent)
        shared = bool(kinds[group[-1]] >= 2)
        if shared:
            pending = None
        elif not same_h[0] or group[-1] > 0:
            lead = int(np.nonzero((group == group[-1]) & ~same_c)[0][0])
            pending = tuple(x[lead] for x in cols)
        last = tuple(x[-1] for x in cols[:5])


def find_covered(df: DataFrame, width: int = WIDTH, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """doc, rid, s, len of covered bytes for df (doc, rid, text); ranges may overlap."""
    if not GRAM < width <= MOST_WIDTH:
        raise ValueError(f"a width of {GRAM + 1} to {MOST_WIDTH} bytes")
    spark = df.sparkSession
    bounded_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = df.select("doc", "rid", "text").mapInArrow(lambda it: _find_runs(it, width), _RUN_SCHEMA)
    dealt = found.repartition(parts, "h").sortWithinPartitions("h", "c", "doc", "rid", "s")
    bounded_batches(spark)
    matched = durable(dealt.mapInArrow(_match_runs, _RUN_SCHEMA), "runs")
    del dealt, found
    free(spark)
    sure = matched.filter("n < 0").select("doc", "rid", "s", (-F.col("n") + (width - 1)).alias("len"))
    bounded_batches(spark)
    open_runs = matched.filter("n > 0").groupBy(F.col("doc").alias("d2"), F.col("rid").alias("r2"))
    open_runs = open_runs.agg(F.collect_list(F.struct("h", "s", "n")).alias("runs")).hint("shuffle_hash")
    cut = df.join(open_runs, (F.col("doc") == F.col("d2")) & (F.col("rid") == F.col("r2")))
    cut = cut.select("rid", "doc", "text", "runs").mapInArrow(lambda it: _cut(it, width), "key long, doc long, rid long, s long, n int, text binary")
    bounded_batches(spark)
    sorted_ = cut.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(lambda it: _sort(it, width, hot_bytes), "doc long, rid long, s long, len int, text binary")
    done = durable(sorted_, "covered")
    free(spark)
    covered = sure.union(done.filter("text is null").drop("text"))
    hot = done.filter("text is not null")
    if hot.isEmpty():
        return covered
    strings = hot.mapInArrow(lambda it: _find_strings(it, width), _RUN_SCHEMA)
    dealt = strings.repartition(parts, "h").sortWithinPartitions("h", "c", "doc", "rid", "s")
    again = durable(dealt.mapInArrow(_match_runs, _RUN_SCHEMA), "strings")
    del dealt, strings
    free(spark)
    return covered.union(again.filter("n < 0").select("doc", "rid", "s", (-F.col("n") + (width - 1)).alias("len")))


def free(spark) -> None:
    """Let Spark drop the shuffle files of what has been written to the shared folder, once for each such table.

    Spark deletes them when the driver's objects are collected; on a driver with little to do that may take half an hour.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _cut(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Passages of open runs, dealt by anchor and by the half of the string on either side of it.

    A string has width - GRAM bytes beside its anchor, so at least half of them on one side: equal strings
    agree on that half too. Starts with the greater part before the anchor go by the bytes before it, the
    others by the bytes after.
    """
    half = (width - GRAM) // 2
    digest = xxhash.xxh3_64_intdigest
    for b in batches:
        rows: list[tuple] = []
        rid, doc, text, open_ = (x.to_pylist() for x in b.columns)
        for r, d, t, rs in zip(rid, doc, text, open_, strict=True):
            raw = t.encode("utf-8", "surrogatepass")
            for x in rs:
                s, n, at = x["s"], x["n"] & MOST_WIDTH, x["n"] >> STARTS
                part = raw[s : s + n + width - 1]
                split = at - half  # starts up to here have at least `half` bytes before the anchor
                for a, e in ((0, min(n - 1, split)), (max(0, split + 1), n - 1)):
                    if a <= e:
                        side = part[at - half : at] if e <= split else part[at + GRAM : at + GRAM + half]
                        key = digest(side, (x["h"] ^ (e <= split)) & (2**64 - 1))
                        rows.append((key - (1 << 63), d, r, s + a, e - a + 1, part[a : e + width]))
        if rows:
            names = ["key", "doc", "rid", "s", "n", "text"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def cover(doc: np.ndarray, rid: np.ndarray, s: np.ndarray, n: np.ndarray, texts: list[bytes], width: int = WIDTH):
    """doc, rid, start, length of covered bytes among passages that may share strings, by sorting all their suffixes."""
    lens = np.array([len(x) for x in texts], dtype=np.int64)
    raw = np.frombuffer(b"\0".join(texts) + b"\0" * 8, dtype=np.uint8)
    at = np.concatenate([[0], np.cumsum(lens + 1)[:-1]])
    t = raw[: int(lens.sum()) + len(lens)].astype(np.int16) + 2
    t[at + lens] = SEPARATOR
    t[-1] = END
    order = suffix_order(t)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lens + 1)
    inside = np.arange(len(t), dtype=order.dtype) - at.astype(order.dtype)[owner]
    order = order[inside[order] < n[owner[order]]]
    same = equal_next(raw, order, width)
    begin = np.nonzero(np.concatenate([[True], ~same]))[0]
    by = np.lexsort((rid, doc))
    place = np.empty(len(doc), dtype=np.int64)
    moved = (doc[by][1:] != doc[by][:-1]) | (rid[by][1:] != rid[by][:-1])
    place[by] = np.concatenate([[0], np.cumsum(moved)])
    o = owner[order]
    when = (place[o] << 36) | (s[o] + inside[order].astype(np.int64))
    first = np.minimum.reduceat(when, begin) if len(order) else when
    late = when != np.repeat(first, np.diff(np.concatenate([begin, [len(order)]])))
    hit = np.sort(order[late])
    if len(hit) == 0:
        return np.zeros((4, 0), dtype=np.int64)
    cut = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])])
    i = np.nonzero(cut)[0]
    end = hit[np.concatenate([i[1:] - 1, [len(hit) - 1]])]
    w = owner[hit[i]]
    return np.stack([doc[w], rid[w], s[w] + inside[hit[i]], end - hit[i] + width])


def _ranges(doc, rid, s, length) -> pa.RecordBatch:
    columns = [pa.array(doc), pa.array(rid), pa.array(s), pa.array(length.astype(np.int32)), pa.nulls(len(doc), pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["doc", "rid", "s", "len", "text"])


def _sort(batches: Iterator[pa.RecordBatch], width: int, hot_bytes: int = HOT_BYTES) -> Iterator[pa.RecordBatch]:
    """Sorts of about SORT_BYTES; a key is never split between two of them.

    Rows of a key with more than hot_bytes of passages pass through with their text, `len` being their starts.
    """
    held: list[pa.RecordBatch] = []
    tail: list[pa.RecordBatch] = []  # rows of the last key, which may go on
    size, own, last, hot = 0, 0, None, False

    def work(parts: list[pa.RecordBatch]):
        tab = pa.Table.from_batches(parts)
        key, doc, rid, s, n = (tab.column(k).to_numpy() for k in ("key", "doc", "rid", "s", "n"))
        n = n.astype(np.int64)
        texts = tab.column("text").to_pylist()
        # Equal passages under one key: the first one stays to be sorted.
        first: dict[tuple[int, bytes], tuple] = {}
        kept, again = [], []
        for i, k in zip((order := np.lexsort((s, rid, doc))).tolist(), key[order].tolist(), strict=True):
            place = (doc[i], rid[i], s[i])
            if (lead := first.setdefault((k, texts[i]), place)) is place:
                kept.append(i)
            elif lead != place:  # not the same passage of rows that are alike
                again.append(i)
        if again:
            i = np.array(again)
            yield _ranges(doc[i], rid[i], s[i], n[i] + width - 1)
        # A key alone can't match anything more.
        i = np.sort(np.array(kept))
        k = key[i]
        i = i[~(np.concatenate([[True], k[1:] != k[:-1]]) & np.concatenate([k[1:] != k[:-1], [True]]))]
        if len(i):
            out = cover(doc[i], rid[i], s[i], n[i], [texts[x] for x in i.tolist()], width)
            if out.shape[1]:
                yield _ranges(*out)

    def passed(part: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column(k) for k in ("doc", "rid", "s", "n", "text")], names=["doc", "rid", "s", "len", "text"])

    for b in batches:
        if b.num_rows == 0:
            continue
        key = b.column("key").to_numpy()
        cuts = np.concatenate([[0], np.nonzero(key[1:] != key[:-1])[0] + 1, [len(key)]])
        sums = np.add.reduceat(pc.binary_length(b.column("text")).to_numpy().astype(np.int64) + 40, cuts[:-1])
        # The first and the last key of a batch may go on in its neighbours.
        alone = sums > hot_bytes
        alone[[0, -1]] = True
        at = 0
        for k in np.nonzero(alone)[0].tolist():
            if last is None or key[cuts[k]] != last:
                held += tail
                size += 0 if hot else own
                tail, own, last, hot = [], 0, key[cuts[k]], False
            if at < k:
                held.append(b.slice(int(cuts[at]), int(cuts[k] - cuts[at])))
                size += int(sums[at:k].sum())
            if size >= SORT_BYTES:
                yield from work(held)
                held, size = [], 0
            part = b.slice(int(cuts[k]), int(cuts[k + 1] - cuts[k]))
            own += int(sums[k])
            hot |= own > hot_bytes
            tail.append(part)
            if hot:
                yield from map(passed, tail)
                tail = []
            at = k + 1
    held += tail
    if held:
        yield from work(held)


def remove(text: str | None, ranges: list) -> tuple[bytes, int, int]:
    """What is left of a text's bytes, how many went, and in how many maximal runs."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out, at, gone, spans, end = [], 0, 0, 0, -1
    for s, e in sorted((x["s"], x["s"] + x["len"]) for x in ranges or ()):
        if s > end:
            spans += 1
        if s > at:
            out.append(raw[at:s])
        if e > at:
            gone += e - max(s, at)
            at = e
        end = max(end, e)
    out.append(raw[at:])
    return b"".join(out), gone, spans


def substring_dedup(df: DataFrame, width: int = WIDTH, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row of df (doc_id, text)."""
    unique = df.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    # Where doc_id names a row, its text needn't.
    own = F.lit(0).cast("long") if unique else F.shiftrightunsigned(F.xxhash64("text"), 2)
    rid = F.when(F.col("doc_id").isNull(), own.bitwiseOR(F.lit(NULL_ID))).otherwise(own)
    rows = df.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), rid.alias("rid"), "text")
    ranges = find_covered(rows, width, hot_bytes).groupBy(F.col("doc").alias("d2"), F.col("rid").alias("r2"))
    ranges = ranges.agg(F.collect_list(F.struct("s", "len")).alias("ranges")).hint("shuffle_hash")
    on = (F.col("doc") == F.col("d2")) & (F.col("rid") == F.col("r2"))
    if unique or rows.groupBy("doc", "rid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        whole = rows.join(ranges, on, "left").select("doc", "rid", "text", "ranges", F.lit(1).alias("n"))
    else:  # rows alike become one row with their number
        one = rows.groupBy("doc", "rid").agg(F.first("text").alias("text"), F.count(F.lit(1)).cast("int").alias("n"))
        whole = one.join(ranges, on, "left").select("doc", "rid", "text", "ranges", "n")
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        for b in batches:
            out = []
            for d, rid, t, found, n in zip(*(x.to_pylist() for x in b.columns), strict=True):
                kept, gone, spans = remove(t, found)
                size, d = len(kept) + gone, None if rid >= NULL_ID else d
                out.append((d, size, gone, spans, hashlib.sha256(kept).hexdigest()))
                if n > 1:
                    other = (size, 1, b"") if size >= width else (0, 0, kept)
                    out += [(d, size, *other[:2], hashlib.sha256(other[2]).hexdigest())] * (n - 1)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.string() if k == 4 else pa.int64()) for k, v in enumerate(zip(*out, strict=True))], names=names)

    return whole.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
