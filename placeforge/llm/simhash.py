"""SimHash near-duplicates by anchor-point covering.

A fingerprint of 64 bits is cut into blocks of 23, 23 and 18 bits. The anchors of a block are the words of
the perfect binary Golay code (length 23, covering radius 3), so every block value has one home anchor
within 3 bits. Two fingerprints at most t bits apart differ in at most d = t // 3 bits in some block. Take the value
half way between the two there: its home anchor is within 3 + d // 2 bits of either one, whichever is meant to be nearer,
and within 3 + (d + 1) // 2 of the other. So each distinct fingerprint goes to all anchors within the greater distance,
and at each anchor those within the smaller one, who are at home there, are compared with all that came.

Past PAIRED_FROM distinct fingerprints an anchor is a pair of code words, of two blocks at a time: some two
blocks differ in at most 2 * t // 3 bits together, and half of that in sum is what distances may exceed the radius by.
That is more copies of each and far fewer at each anchor; the links are the same.

Equal fingerprints are one fingerprint before anything is copied. An anchor's links leave it as a spanning
star for each group, never as all pairs. A crowded anchor is cut into tiles on both sides, so many at home against so
many that came, and no task holds more than one tile. Components are found by joins over distributed tables, with
lineage cut at each round.

`near_duplicates` links fingerprints of 64 bits. `keep_first` drops near copies by their similarity: the share of
differing bits of two fingerprints estimates the angle between the two texts' shingles, and so their Jaccard
similarity. It carries a second fingerprint word beside the first, finds candidates by the first in a wide radius, and
decides by the bits of both.

Defined results: null and empty texts have fingerprint zero and link like any other; repeated rows get equal
components; a component is named by its least doc_id that isn't null. Texts are hashed whole.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import bounded_batches, durable, map_columns, release

BITS = 64
BLOCKS = (23, 23, 18)
THRESHOLD = 4
SHINGLE = 4
SEED = 42
#: Golay generator x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
RADIUS = 3
#: From so many distinct fingerprints on, comparing at single anchors costs more than copying to pairs of them.
PAIRED_FROM = 40_000_000
#: Fingerprints at home at one anchor that one tile compares with so many that came there.
TILE, ARRIVALS = 8192, 65_536
MOST_ROUNDS = 60
#: What `keep_first` takes for near copies: words in a shingle and Jaccard similarity.
STAGE_SHINGLE, SIMILARITY = 5, 0.8
#: The radius in which it looks for candidates, some 65 copies of each; 9, 10 and 11 bits cost the same.
STAGE_THRESHOLD = 11

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The hash of each shingle of a whole text; of the whole sequence where it has fewer words; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    n = len(words)
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if n <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: n - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)], dtype=np.uint64)


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    counts = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(h), 4096):
        part = h[k : k + 4096]
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(h), bitorder="little").tobytes(), "little")


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes whose bits are independent of those of h."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The unsigned fingerprint of a whole text."""
    return majority(shingle_hashes(text, width))


def fingerprint_pair(text: str | None, width: int = STAGE_SHINGLE) -> tuple[int, int]:
    """Two independent words of a fingerprint."""
    h = shingle_hashes(text, width)
    return majority(h), majority(mixed(h))


def bits_apart(similarity: float, bits: int, deviations: float = 0.0) -> int:
    """How many of so many bits differ between two texts of a Jaccard similarity, with so many standard deviations more.

    Two sets of one size have the cosine 2 s / (1 + s), and a bit differs with the angle's share of a half turn.
    """
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.floor(bits * share + deviations * math.sqrt(bits * share * (1 - share)))


def _syndromes(x: np.ndarray) -> np.ndarray:
    """The remainder of each 23-bit word by the generator."""
    r = x.astype(np.int64).copy()
    for k in range(22, 10, -1):
        r ^= np.where((r >> k) & 1, GENERATOR << (k - 11), 0)
    return r


def _patterns(radius: int) -> np.ndarray:
    """For each syndrome, all error patterns of at most `radius` bits, lightest first, padded with -1."""
    words = np.array([0], dtype=np.int64)
    layers = [words]
    for _ in range(radius):
        words = np.unique((words[:, None] | (1 << np.arange(23))[None, :]).reshape(-1))
        words = words[np.bitwise_count(words.astype(np.uint64)) == len(layers)]
        layers.append(words)
    every = np.concatenate(layers)
    s = _syndromes(every)
    order = np.argsort(s, kind="stable")
    every, s = every[order], s[order]
    n = np.bincount(s, minlength=2048)
    out = np.full((2048, n.max()), -1, dtype=np.int64)
    out[s, np.arange(len(s)) - np.repeat(np.cumsum(n) - n, n)] = every
    return out


class Covering:
    """The anchors that each fingerprint goes to: code words of one block, or of two blocks together."""

    def __init__(self, threshold: int = THRESHOLD, blocks: tuple[int, ...] = BLOCKS, together: int = 1):
        self.blocks = blocks
        differing = together * threshold // len(blocks)
        #: What distances may exceed the radius by, for those that come and for those at home.
        self.over, self.near = (differing + 1) // 2, differing // 2
        self.sets = list(itertools.combinations(range(len(blocks)), together))
        self.patterns = _patterns(RADIUS + self.over)
        weight = np.bitwise_count(np.maximum(self.patterns, 0).astype(np.uint64)).astype(np.int64)
        self.excess = np.where(self.patterns < 0, 99, np.maximum(weight - RADIUS, 0))
        by_excess = [(self.excess == k).sum() / len(self.excess) for k in range(self.over + 1)]
        spread = by_excess if together == 1 else np.convolve(by_excess, by_excess)[: self.over + 1]
        #: Anchors that a fingerprint goes to, on average.
        self.copies = len(self.sets) * float(sum(spread))

    def anchors(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, anchor and whether it's at home there, over all blocks or pairs of blocks."""
        words, excess, shift = [], [], 0
        for width in self.blocks:
            x = ((fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
            s = _syndromes(x)
            words.append((x[:, None] ^ np.maximum(self.patterns[s], 0)) >> 11)
            excess.append(self.excess[s])
            shift += width
        rows, keys, homes = [], [], []
        for k, own in enumerate(self.sets):
            if len(own) == 1:
                i, j = np.nonzero(excess[own[0]] <= self.over)
                key, home = words[own[0]][i, j], excess[own[0]][i, j] <= self.near
            else:
                a, b = own
                i, j, l = np.nonzero(excess[a][:, :, None] + excess[b][:, None, :] <= self.over)
                key, home = words[a][i, j] << 12 | words[b][i, l], excess[a][i, j] + excess[b][i, l] <= self.near
            rows.append(i)
            keys.append(k << (12 * len(own)) | key)
            homes.append(home)
        return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least labels after joining the pairs i, j."""
    while True:
        a, b = labels[i], labels[j]
        differ = a != b
        if not differ.any():
            return labels
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        low = np.minimum(a, b)
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
        while True:
            jump = labels[labels]
            if (jump == labels).all():
                break
            labels = jump


ARRIVED, HOME = 1, 2


def link_tile(words: list[np.ndarray], role: np.ndarray, threshold: int, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star for each linked group in one tile, as row numbers: those at home against those that came.

    Two are linked when their first words differ in at most `threshold` bits, and all words together in at most `most`.
    """
    labels = np.arange(len(role))
    came = np.nonzero(role & ARRIVED)[0]
    at = np.nonzero(role & HOME)[0]
    theirs = words[0][came]
    step = max(1, (1 << 21) // max(len(came), 1))
    for k in range(0, len(at), step):
        mine = at[k : k + step]
        i, j = np.nonzero(np.bitwise_count(words[0][mine][:, None] ^ theirs[None, :]) <= threshold)
        a, b = mine[i], came[j]
        ok = a != b
        if most is not None:
            ok &= sum(np.bitwise_count(w[a] ^ w[b]).astype(np.int64) for w in words) <= most
        labels = merge(labels, a[ok], b[ok])
    moved = np.nonzero(labels != np.arange(len(labels)))[0]
    return moved, labels[moved]


def links(distinct: DataFrame, threshold: int = THRESHOLD, most: int | None = None) -> DataFrame:
    """Pairs (a, b) of fingerprints whose graph has the components of all linked pairs.

    distinct has the words of each fingerprint: `fp`, and `fp2` where two words decide. A node is the word or the struct
    of both.
    """
    spark = distinct.sparkSession
    names = [c for c in ("fp", "fp2") if c in distinct.columns]
    # Pairs of anchors for a wide radius would be hundreds of copies.
    together = 2 if 2 * threshold // len(BLOCKS) <= RADIUS and distinct.count() >= PAIRED_FROM else 1
    step = max(1, int(40_000_000 / (64 * Covering(threshold, together=together).copies)))

    def anchors(batches: Iterator[pa.RecordBatch]):
        cover = Covering(threshold, together=together)
        for batch in batches:
            words = [c.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in batch.columns]
            for k in range(0, len(words[0]), step):
                part = [w[k : k + step] for w in words]
                yield part, cover.anchors(part[0])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (rows, keys, homes) in anchors(batches):
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), *(pa.array(w[rows].view(np.int64)) for w in part), pa.array(homes)], names=["anchor", *names, "home"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (_, keys, homes) in anchors(batches):
            key, at = np.unique(keys, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(np.bincount(at)), pa.array(np.bincount(at, homes).astype(np.int64))], names=["a2", "came", "home"])

    bounded_batches(spark)
    fields = ", ".join(f"{c} long" for c in names)
    spreaded = distinct.select(*names).mapInArrow(spread, f"anchor int, {fields}, home boolean")
    crowd = distinct.select(*names).mapInArrow(count, "a2 int, came long, home long").groupBy("a2").agg(F.sum("came").alias("came"), F.sum("home").alias("homes"))
    crowd = crowd.filter((F.col("homes") > TILE) | (F.col("came") > ARRIVALS))
    tiles = crowd.select("a2", F.ceil(F.col("homes") / TILE).cast("int").alias("rows"), F.ceil(F.col("came") / ARRIVALS).cast("int").alias("columns"))
    if together == 1:  # at most 12,288 rows
        tiles = F.broadcast(tiles)
    placed = spreaded.join(tiles, F.col("anchor") == F.col("a2"), "left")
    row = F.pmod(F.xxhash64(*names), F.col("rows")).cast("int")
    column = F.pmod(F.xxhash64(*names, F.lit(1)), F.col("columns")).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.greatest(F.col(n), F.lit(1)) - 1)
    tile = lambda r, c, role: F.struct(r.alias("row"), c.alias("column"), F.lit(role).alias("role"))
    came = F.transform(every("rows"), lambda r: tile(r, column, ARRIVED))
    at_home = F.when(F.col("home"), F.transform(every("columns"), lambda c: tile(row, c, HOME))).otherwise(F.array().cast("array<struct<row:int,column:int,role:int>>"))
    alone = F.array(F.struct(F.lit(0).alias("row"), F.lit(0).alias("column"), F.when(F.col("home"), ARRIVED | HOME).otherwise(ARRIVED).alias("role")))
    placed = placed.select("anchor", *names, F.inline(F.when(F.col("rows").isNull(), alone).otherwise(F.concat(came, at_home))))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, list[np.ndarray]]] = []

        def flush():
            if held:
                columns = [np.concatenate([p[1][k] for p in held]) for k in range(len(names) + 1)]
                words, role = [c.view(np.uint64) for c in columns[:-1]], columns[-1]
                if (role & HOME).any() and len(role) > 1:
                    a, b = link_tile(words, role, threshold, most)
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(w[x].view(np.int64)) for x in (a, b) for w in words], names=[f"{x}{k}" for x in "ab" for k in range(len(names))])

        for batch in batches:
            anchor, line, column = (batch.column(k).to_numpy().astype(np.int64) for k in (0, len(names) + 1, len(names) + 2))
            values = [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (*range(1, len(names) + 1), len(names) + 3)]
            new = (anchor[1:] != anchor[:-1]) | (line[1:] != line[:-1]) | (column[1:] != column[:-1])
            cuts = np.concatenate([[0], np.nonzero(new)[0] + 1, [len(anchor)]])
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                key = (anchor[s], line[s], column[s])
                if held and held[0][0] != key:
                    yield from flush()
                    held.clear()
                held.append((key, [v[s:e] for v in values]))
        yield from flush()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.select("anchor", *names, "row", "column", "role").repartition(parts, "anchor", "row", "column").sortWithinPartitions("anchor", "row", "column")
    ends = ", ".join(f"{x}{k} long" for x in "ab" for k in range(len(names)))
    found = dealt.mapInArrow(compare, ends)
    node = lambda x: (F.col(f"{x}0") if len(names) == 1 else F.struct(F.col(f"{x}0").alias("fp"), F.col(f"{x}1").alias("fp2"))).alias(x)
    return found.select(node("a"), node("b")).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node of each component, by least-neighbour steps and pointer jumps.

    Edges shrink as they are rewritten to roots; a round ends when every edge is a loop. The loop works on
    tables in the shared folder, so a lost executor costs a task.
    """
    edges = durable(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    state = durable(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().select("node", F.col("node").alias("root")), "roots")
    for _ in range(MOST_ROUNDS):
        if edges.isEmpty():
            return state
        # Each root takes the least root next to it, if less; then chains are halved until they are stars.
        both = edges.select(F.col("b").alias("r"), F.col("a").alias("low")).groupBy("r").agg(F.min("low").alias("low"))
        moved = durable(both.withColumn("m", F.lit(True)), "hooks")
        while True:
            before, hooks = moved, moved.select("r", "low")
            nxt = hooks.select(F.col("r").alias("r2"), F.col("low").alias("low2"))
            jumped = hooks.join(nxt, F.col("low") == F.col("r2"), "left")
            moved = durable(jumped.select("r", F.coalesce("low2", "low").alias("low"), F.col("low2").isNotNull().alias("m")), "hooks")
            release(before)
            if moved.filter("m").isEmpty():
                break
        hooks, before = moved.select("r", "low"), (state, edges, moved)
        state = durable(state.join(hooks, F.col("root") == F.col("r"), "left").select("node", F.coalesce("low", "root").alias("root")), "roots")
        left = edges.join(hooks, F.col("a") == F.col("r"), "left").select(F.coalesce("low", "a").alias("a"), "b")
        left = left.join(hooks, F.col("b") == F.col("r"), "left").select("a", F.coalesce("low", "b").alias("b"))
        edges = durable(left.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        release(*before)
    raise RuntimeError("components did not settle")


def fingerprints(df: DataFrame) -> DataFrame:
    """doc_id and signed fp of each row of df (doc_id, text)."""

    def make():
        def run(ids, texts):
            return ids, np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)

        return run

    return map_columns(df, ("doc_id", "text"), "doc_id long, fp long", make)


def near_duplicates(df: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of each row of df (doc_id, text)."""
    rows = durable(fingerprints(df), "fingerprints")
    distinct = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct, threshold))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(names, "root").select(F.col("fp").alias("fp2"), "component_id")
    out = rows.join(by_fp, F.col("fp") == F.col("fp2"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: The most rows (16 bytes each) that keep_first broadcasts to drop them.
BROADCAST_ROWS = 2_000_000


def keep_first(df: DataFrame, similarity: float = SIMILARITY, width: int = STAGE_SHINGLE, threshold: int = STAGE_THRESHOLD) -> DataFrame:
    """df with one row of each component of near copies: the least (doc_id, text hash), null ids last.

    Two texts are near copies when the bits of both fingerprint words, over shingles of `width` words, put their
    similarity at `similarity` or more, one standard deviation granted. Rows alike in doc_id and text are one row.
    Texts stay where they are while the keys to drop are few enough to broadcast; beyond that the table is joined on them.
    """

    def make():
        def run(ids, texts, hashes):
            pairs = [fingerprint_pair(t, width) for t in texts]
            return ids, hashes, *(np.array([p[k] for p in pairs], dtype=np.uint64).view(np.int64) for k in (0, 1))

        return run

    own = df.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    rows = durable(map_columns(own, ("doc_id", "text", "hash"), "doc_id long, hash long, fp long, fp2 long", make), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "hash")
    distinct = durable(rows.groupBy("fp", "fp2").agg(F.min(place).alias("least")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp", "fp2"), threshold, bits_apart(similarity, 2 * BITS, 1.0)))
    both = F.struct("fp", "fp2")
    named = distinct.join(roots, both == F.col("node"), "left").select("least", F.coalesce("root", both).alias("root"))
    # Names that no column of df has, whatever it has.
    free = "_" * (1 + max(map(len, df.columns)))
    d, h = f"{free}d", f"{free}h"
    kept = named.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.doc_id").alias(d), F.col("least.hash").alias(h))
    same = F.col("doc_id").eqNullSafe(F.col(d)) & (F.col("hash") == F.col(h))
    counted = rows.groupBy("doc_id", "hash").agg(F.count(F.lit(1)).alias("n"))
    repeated = not counted.filter("n > 1").isEmpty()
    gone = counted.join(kept, same, "left_anti").select(F.col("doc_id").alias(d), F.col("hash").alias(h))
    gone = durable(gone, "dropped")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    out = df.join(gone, df["doc_id"].eqNullSafe(F.col(d)) & (F.xxhash64(df["text"]) == F.col(h)), "left_anti")
    if not repeated:
        return out
    # Of rows alike in doc_id and text but not in the rest, the one whose columns hash least.
    columns = F.struct(*df.columns)
    one = out.groupBy(F.col("doc_id").alias(d), F.xxhash64("text").alias(h)).agg(F.min_by(columns, F.xxhash64(F.to_json(columns))).alias(free))
    return one.select(f"{free}.*")
