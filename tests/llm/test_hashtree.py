import zlib
from collections import Counter

from helpers import documents
from pyspark.sql import functions as F

from placeforge.llm import hashtree


def placed(spark, n, shards):
    df = spark.range(n).withColumnRenamed("id", "k")
    return {r.k: (r.region, r.rack, r.shard) for r in hashtree.place(df, "k", hashtree.tree(shards), "").collect()}


def test_one_more_shard_takes_rows_only_into_itself(spark):
    for n in (16, 17, 20):
        a, b = placed(spark, 20_000, n), placed(spark, 20_000, n + 1)
        moved = [k for k in a if a[k] != b[k]]
        assert {b[k][2] for k in moved} == {n}
        assert abs(len(moved) / 20_000 - 1 / (n + 1)) < 0.01


def test_shares_follow_weights_and_moves_stay_in_the_changed_subtree(spark):
    df = spark.range(40_000).withColumnRenamed("id", "k")
    get = lambda spec: {r.k: (r.region, r.rack, r.shard) for r in hashtree.place(df, "k", spec, "").collect()}
    plain, heavy = get(hashtree.tree(16)), get(hashtree.tree(16, weights={5: 3.0}))
    share = Counter(s for _, _, s in heavy.values())[5] / 40_000
    assert abs(share - 3 / 18) < 0.01
    for k, (region, rack, shard) in plain.items():
        if heavy[k] != (region, rack, shard):
            assert heavy[k][0] == 0  # the region with the changed shard
            if region == 0:
                assert heavy[k][1] == 1 and (rack != 1 or heavy[k][2] == 5)
    none = get(hashtree.tree(16, weights={k: 0.0 for k in range(4)}))
    assert {r for _, r, _ in none.values()} == {1, 2, 3}


def test_query_rows(spark, monkeypatch):
    monkeypatch.setattr(hashtree, "GROUP_ROWS", 3)
    texts = [None, "", "é", "x" * 1000] * 100
    rows = list(enumerate(texts)) + [(5, "again"), (5, "again"), (None, "no id")]
    got = hashtree.hash_tree_shards(documents(spark, rows, extra=("shard", "slot", "size"))).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.law == "key" and 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    one = {r.doc_id: r for r in got}
    assert (one[2].size, one[2].text_crc32) == (3, zlib.crc32("é".encode())) and (one[0].size, one[0].text_crc32) == (1, 0)
    assert hashtree.hash_tree_shards(documents(spark, [])).count() == 0


def test_plan_stays_in_the_jvm(spark):
    df = hashtree.place(spark.range(10), "id", hashtree.tree(17), "")
    assert "Python" not in df.select(F.col("shard"))._jdf.queryExecution().executedPlan().toString()


def slow_shard(spark, key, spec):
    """The tree walked draw by draw, each draw taken from the JVM's hash on its own."""
    import math

    def u(level, child):
        h = spark.sql(f"SELECT xxhash64({level}, {child}, {'CAST(NULL AS BIGINT)' if key is None else f'CAST({key} AS BIGINT)'}) AS h").first().h
        return (((h & (2**64 - 1)) >> 12) + 1) / 2**52

    node = spec
    for level in range(3):
        weights = {c: hashtree.weight(x) for c, x in node.items()}
        weights = {c: w for c, w in weights.items() if w > 0}
        best = next(iter(weights)) if len(weights) == 1 else min(weights, key=lambda c: (-math.log(u(level, c)) / weights[c], c))
        node = node[best]
    return best


def test_shards_and_slots_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hashtree, "PART_ROWS", 7)
    rows = [(k, f"text {k}") for k in range(12)] + [(3, "text 3")] * 40 + [(None, None)] * 3 + [(None, "x"), (5, "other")]
    got = hashtree.hash_tree_shards(documents(spark, rows, extra=("slot", "shard"))).collect()
    assert len(got) == len(rows)
    shards = {k: slow_shard(spark, k, hashtree.tree(16)) for k in {r[0] for r in rows}}
    grown = {k: slow_shard(spark, k, hashtree.tree(17)) for k in shards}
    assert all(r.shard == shards[r.doc_id] and r.grown_shard == grown[r.doc_id] for r in got)
    for shard in set(shards.values()):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(shards[i] == shard for i, _ in rows)))
