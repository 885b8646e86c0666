"""External induced sorting of suffixes, bucket by bucket.

Suffixes are induced in the order of their first character: when a bucket is taken, the suffix before each
of its members goes to the queue of its own first character, in the order in which they were met. The queues
together are a monotone priority queue; each holds blocks of positions in memory and sends them to a file in
the given folder when all of them together pass the memory limit, and blocks that have been taken for the last time
are let go. The text, its types and the final order stay in memory, so the caller bounds the length of what it sorts.

LMS substrings are sorted by one such induction and named. The string of names, a third of the text's length or less,
is sorted by recursive induction, which gives the order of the LMS suffixes, and a second induction that of all.
Common prefixes aren't carried along: neighbours are compared eight bytes at a time afterwards (`equal_next`).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np

#: Positions that all queues of one induction hold in memory together.
MEMORY_ITEMS = 1 << 18
#: Positions from which a block is large enough to be worth a pass of its own.
BLOCK_ITEMS = 1 << 15
ALPHABET = 258  # the end, a separator, and 256 bytes
END, SEPARATOR = 0, 1


class Queues:
    """One first-in first-out queue of positions for each first character.

    When all together hold too much, the queue that holds most sends its part to disk in one piece.
    """

    def __init__(self, kinds: int = ALPHABET, memory_items: int = MEMORY_ITEMS, folder: str | None = None):
        self.blocks: list[list] = [[] for _ in range(kinds)]
        self.sizes = [0] * kinds  # what each holds in memory
        self.held, self.most, self.folder, self.file, self.spilled = 0, memory_items, folder, None, 0
        self.kind = np.dtype(np.int64)

    def put(self, c: int, block: np.ndarray) -> None:
        self.blocks[c].append(block)
        self.sizes[c] += len(block)
        self.held += len(block)
        self.kind = block.dtype
        if self.held > self.most:
            self.spill(max(range(len(self.sizes)), key=self.sizes.__getitem__))

    def spill(self, c: int) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile(dir=self.folder, buffering=0)
        at = self.file.seek(0, os.SEEK_END)
        kept = [b for b in self.blocks[c] if isinstance(b, tuple)]
        piece = np.concatenate([b for b in self.blocks[c] if not isinstance(b, tuple)])
        raw = memoryview(piece).cast("B")
        while raw:
            raw = raw[self.file.write(raw) :]
        self.blocks[c] = [*kept, (at, len(piece))]
        self.spilled += len(piece)
        self.held -= self.sizes[c]
        self.sizes[c] = 0

    def drop(self, c: int) -> None:
        """Let a queue go."""
        self.held -= self.sizes[c]
        self.sizes[c] = 0
        self.blocks[c] = []

    def deal(self, positions: np.ndarray, chars: np.ndarray) -> None:
        """Append each position to the queue of its character, order kept."""
        if len(positions):
            order = np.argsort(chars, kind="stable")
            chars = chars[order]
            cuts = np.concatenate([[0], np.nonzero(chars[1:] != chars[:-1])[0] + 1, [len(chars)]])
            positions = positions[order]
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                self.put(int(chars[s]), positions[s:e])

    def take(self, c: int) -> list[np.ndarray]:
        """The blocks of a queue in order."""
        out = []
        for b in self.blocks[c]:
            if isinstance(b, tuple):
                self.file.seek(b[0])
                raw = bytearray()
                while len(raw) < b[1] * self.kind.itemsize:
                    raw += self.file.read(b[1] * self.kind.itemsize - len(raw))
                b = np.frombuffer(raw, dtype=self.kind)
            out.append(b)
        return out

    def whole(self, c: int) -> np.ndarray:
        got = self.take(c)
        return got[0] if len(got) == 1 else np.concatenate(got) if got else np.zeros(0, dtype=self.kind)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def joined(blocks: Iterable[np.ndarray]) -> Iterator[np.ndarray]:
    """The same positions in the same order, small blocks put together."""
    held, size = [], 0
    for b in blocks:
        held.append(b)
        size += len(b)
        if size >= BLOCK_ITEMS:
            yield held[0] if len(held) == 1 else np.concatenate(held)
            held, size = [], 0
    if held:
        yield held[0] if len(held) == 1 else np.concatenate(held)


def types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the one after it (type S); the end is S."""
    n = len(t)
    rise = np.zeros(n, dtype=bool)
    rise[:-1] = t[:-1] < t[1:]
    rise[-1] = True
    differ = np.ones(n, dtype=bool)
    differ[:-1] = t[:-1] != t[1:]
    at = np.where(differ, np.arange(n, dtype=kind(n)), kind(n)(n - 1))
    return rise[np.minimum.accumulate(at[::-1])[::-1]]


def kind(n: int) -> type:
    """The narrowest integers that hold positions below n."""
    return np.int32 if n < 1 << 31 else np.int64


def induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, memory_items: int, folder: str | None) -> tuple[Queues, Queues]:
    """The queues of L suffixes (ascending) and of S suffixes (descending) from LMS suffixes in their order."""
    first = t[lms]
    order = np.argsort(first, kind="stable")
    seeds = lms[order]
    bounds = np.searchsorted(first[order], np.arange(ALPHABET + 1))
    up, down = Queues(ALPHABET, memory_items, folder), Queues(ALPHABET, memory_items, folder)

    def before(items: np.ndarray, want_small: bool) -> tuple[np.ndarray, np.ndarray]:
        p = items[items > 0] - 1
        p = p[small[p] == want_small]
        return p, t[p]

    for c in range(ALPHABET):
        wave = up.take(c)
        while wave:
            again = []
            for block in joined(wave):
                p, ch = before(block, False)
                same = ch == c
                if same.any():
                    again.append(p[same])
                up.deal(p[~same], ch[~same])
            # What is induced into the same bucket comes after all that was there before.
            for block in again:
                up.put(c, block)
            wave = again
        p, ch = before(seeds[bounds[c] : bounds[c + 1]], False)
        up.deal(p, ch)
    for c in range(ALPHABET - 1, -1, -1):
        if c == END:
            down.put(c, np.array([len(t) - 1], dtype=lms.dtype))
        wave = down.take(c)
        while wave:
            again = []
            for block in joined(wave):
                p, ch = before(block, True)
                same = ch == c
                if same.any():
                    again.append(p[same])
                down.deal(p[~same], ch[~same])
            for block in again:
                down.put(c, block)
            wave = again
        for block in joined(b[::-1] for b in reversed(up.take(c))):
            p, ch = before(block, True)
            down.deal(p, ch)
    return up, down


def suffix_order(t: np.ndarray, memory_items: int = MEMORY_ITEMS, folder: str | None = None) -> np.ndarray:
    """All suffixes of t (last symbol END, nowhere else) in order."""
    n = len(t)
    small = types(t)
    lms = (np.nonzero(small[1:] & ~small[:-1])[0] + 1).astype(kind(n))
    if len(lms) > 1:
        up, down = induce(t, small, lms, memory_items, folder)
        up.close()
        is_lms = np.zeros(n, dtype=bool)
        is_lms[lms] = True
        parts = []
        for c in range(ALPHABET):
            d = down.whole(c)[::-1]
            down.drop(c)
            parts.append(d[is_lms[d]])
        down.close()
        ordered = np.concatenate(parts)
        del up, down, parts, is_lms
        rank = np.zeros(n, dtype=lms.dtype)
        rank[ordered] = names(t, lms, ordered)
        r = rank[lms]
        del rank, ordered
        kinds = int(r.max()) + 1
        lms = lms[np.argsort(r, kind="stable") if kinds == len(r) else np.array(order_of_names(r.tolist(), kinds))]
    up, down = induce(t, small, lms, memory_items, folder)
    parts = []
    for c in range(ALPHABET):
        parts += [up.whole(c), down.whole(c)[::-1]]
        up.drop(c)
        down.drop(c)
    up.close()
    down.close()
    return np.concatenate(parts)


def order_of_names(s: list[int], kinds: int) -> list[int]:
    """The suffixes of s in order, by induction, with the names of its own LMS substrings sorted the same way.

    s has all numbers below `kinds`, and ends with its only 0.
    """
    t, n = np.array(s, dtype=np.int64), len(s)
    small = types(t)
    lms = np.nonzero(small[1:] & ~small[:-1])[0] + 1
    sizes = np.bincount(t, minlength=kinds)
    ends = np.cumsum(sizes)

    def before(is_small: bool) -> list[int]:
        """The symbol before each suffix where that is one of this type, else -1; so too for -1, an empty slot."""
        return np.concatenate([[-1], np.where(small[:-1] == is_small, t[:-1], -1), [-1]]).tolist()

    def induced(seeds: np.ndarray) -> list[int]:
        first = t[seeds]
        order = np.argsort(first, kind="stable")
        first = first[order]
        slots = np.full(n, -1, dtype=np.int64)
        slots[ends[first] - np.searchsorted(first, first, side="right") + np.arange(len(first))] = seeds[order]
        out = slots.tolist()
        del first, order, slots
        place, symbol = (ends - sizes).tolist(), before(False)
        for i in out:  # meets what is put further on
            c = symbol[i]
            if c >= 0:
                p = place[c]
                out[p] = i - 1
                place[c] = p + 1
        place = symbol = None
        place, symbol = ends.tolist(), before(True)
        for i in reversed(out):
            c = symbol[i]
            if c >= 0:
                place[c] = p = place[c] - 1
                out[p] = i - 1
        return out

    if len(lms) < 2:
        return induced(lms)
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    until = np.full(n, n, dtype=np.int64)
    until[lms[:-1]] = lms[1:] + 1
    ordered = np.array(induced(lms))
    ordered = ordered[is_lms[ordered]]
    found, count, last = [], -1, None
    for i, e in zip(ordered.tolist(), until[ordered].tolist(), strict=True):
        own = s[i:e]
        count += own != last
        found.append(count)
        last = own
    if count + 1 == len(lms):
        return induced(ordered)
    name = np.zeros(n, dtype=np.int64)
    name[ordered] = found
    inner = name[lms].tolist()
    del until, ordered, found, name, is_lms
    return induced(lms[order_of_names(inner, count + 1)])


def names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Equal names for equal LMS substrings, ascending along `ordered`; compared symbol by symbol."""
    n = len(t)
    end = np.full(n, n - 1, dtype=lms.dtype)
    end[lms[:-1]] = lms[1:]
    a, b = ordered[:-1], ordered[1:]
    length = end[ordered] - ordered + 1
    same = length[:-1] == length[1:]
    live = np.nonzero(same)[0]
    k = 0
    while len(live):
        eq = t[np.minimum(a[live] + k, n - 1)] == t[np.minimum(b[live] + k, n - 1)]
        same[live[~eq]] = False
        k += 1
        live = live[eq & (length[live] > k)]
    return np.concatenate([[0], np.cumsum(~same)])


def equal_next(raw: np.ndarray, positions: np.ndarray, width: int) -> np.ndarray:
    """Whether each position's `width` bytes equal those of the position before it."""
    a, b = positions[:-1], positions[1:]
    same = np.zeros(len(a), dtype=bool)
    if len(a) == 0:
        return same
    live = np.arange(len(a))
    words = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    for k in [*range(0, width - 7, 8), width - 8]:
        live = live[words[a[live] + k] == words[b[live] + k]]
    same[live] = True
    return same
