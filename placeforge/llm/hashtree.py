"""Hierarchical weighted hash tree: placing rows by weighted draws at each level.

A tree has regions, racks and shards, each with a weight (a node's is the sum of its children's).
At every level the row's key and each child give one exponential draw of the child's weight, and the
least draw wins. A draw depends on its own child alone, so a changed weight moves rows only into (or
out of) the child whose weight changed, and never between the others.

Growth: the first `base` shards form the fixed tree. Each later shard is a region of its own, so it
takes rows only into itself, whatever the number of shards.

Defined results: a null text has no bytes. A null key is a key like any other. Repeated rows share a
shard and get slots of their own. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Regions, racks in a region, shards in a rack of the fixed tree.
BASE = (2, 2, 4)
#: Rows that one numbering group should hold; groups grow in number, not in size.
GROUP_ROWS = 20_000
LEAST_GROUPS = 16
#: Rows alike that one task writes at a time.
PART_ROWS = 50_000


def tree(shards: int, base: tuple[int, int, int] = BASE, weights: dict[int, float] | None = None) -> dict:
    """{region: {rack: {shard: weight}}} for so many shards."""
    w = weights or {}
    regions, racks, leaves = base
    out: dict = {}
    for s in range(shards):
        if s < regions * racks * leaves:
            rack = s // leaves
            out.setdefault(rack // racks, {}).setdefault(rack, {})[s] = float(w.get(s, 1.0))
        else:
            over = s - regions * racks * leaves
            out[regions + over] = {regions * racks + over: {s: float(w.get(s, 1.0))}}
    return out


def weight(node: dict | float) -> float:
    return sum(weight(x) for x in node.values()) if isinstance(node, dict) else float(node)


def draw(key: Column, level: int, child: int, w: float) -> Column:
    """-ln(u) / w with u in (0, 1] from 52 bits of a hash of level, child and key."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(level), F.lit(child), key), 12).cast("double") + F.lit(1.0)) / F.lit(float(1 << 52))
    return -F.log(u) / F.lit(float(w))


def choice(key: Column, level: int, children: dict) -> Column:
    alive = {c: weight(x) for c, x in children.items() if weight(x) > 0}
    if len(alive) == 1:
        return F.lit(next(iter(alive)))
    return F.array_min(F.array(*[F.struct(draw(key, level, c, w).alias("d"), F.lit(c).alias("c")) for c, w in alive.items()]))["c"]


def place(df: DataFrame, key: str, spec: dict, prefix: str) -> DataFrame:
    """Add <prefix>region, <prefix>rack and <prefix>shard to df; map-only and wholly in the JVM."""
    k = F.col(key)
    df = df.withColumn(f"{prefix}region", choice(k, 0, spec))
    rack = None
    for r, racks in spec.items():
        if weight(racks) > 0:
            c = choice(k, 1, racks)
            rack = F.when(F.col(f"{prefix}region") == r, c) if rack is None else rack.when(F.col(f"{prefix}region") == r, c)
    df = df.withColumn(f"{prefix}rack", rack)
    shard = None
    for racks in spec.values():
        for k2, leaves in racks.items():
            if weight(leaves) > 0:
                c = choice(k, 2, leaves)
                shard = F.when(F.col(f"{prefix}rack") == k2, c) if shard is None else shard.when(F.col(f"{prefix}rack") == k2, c)
    return df.withColumn(f"{prefix}shard", shard.cast("int"))


def number(df: DataFrame, shard: str, order: list[str], total: int) -> DataFrame:
    """Add `slot`, gapless from 0 in each shard, without ever sorting a whole shard in one task.

    Rows that are alike are one row with their number until the end, however many they are; they take neighbouring slots.
    Distinct rows go to hash groups within their shard. The groups' counts, a table of shards times groups, give
    each group its first slot; a window numbers the rows of each group. Rows that stand for many are dealt in parts.
    """
    groups = max(LEAST_GROUPS, total // GROUP_ROWS // 16)
    one = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    one = one.withColumn("__g", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(groups)).cast("int"))
    counts = one.groupBy(shard, "__g").agg(F.sum("__n").alias("__all"))
    before = Window.partitionBy(shard).orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(shard).alias("__s"), F.col("__g").alias("__sg"), F.coalesce(F.sum("__all").over(before), F.lit(0)).alias("__from"))
    inner = Window.partitionBy(shard, "__g").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    one = one.withColumn("__i", F.sum("__n").over(inner) - F.col("__n"))
    joined = one.join(starts, (F.col(shard) == F.col("__s")) & (F.col("__g") == F.col("__sg")))
    first = (F.col("__from") + F.col("__i")).cast("long")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / PART_ROWS))).alias("__part")
    parted = joined.select(*df.columns, "__n", first.alias("__first"), parts).repartition(*[F.col(c) for c in order], F.col("__part"))
    low = F.col("__part") * PART_ROWS
    each = F.explode(F.sequence(low, F.least(F.col("__n"), low + PART_ROWS) - 1)).alias("__at")
    return parted.select(*df.columns, "__first", each).select(*df.columns, (F.col("__first") + F.col("__at")).alias("slot"))


def hash_tree_shards(df: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the path of each row of df (doc_id, text)."""
    total = df.select("doc_id").count()
    rows = df.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = place(place(rows, "doc_id", tree(shards), ""), "doc_id", tree(shards + 1), "grown_")
    rows = number(rows, "shard", ["doc_id", "text_crc32", "size"], total)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "region", "rack"
    )
