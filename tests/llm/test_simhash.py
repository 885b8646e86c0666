import random

import numpy as np
import pytest
from helpers import components, documents, fingerprint

from placeforge.llm import simhash


def test_every_block_value_has_one_home_within_the_radius():
    cover = simhash.Covering(4)
    x = np.arange(0, 1 << 23, 977, dtype=np.uint64)
    rows, keys, homes = cover.anchors(x)
    assert (np.bincount(rows[homes & (keys < 4096)], minlength=len(x)) == 1).all()


@pytest.mark.parametrize("together", [1, 2])
def test_pairs_within_the_threshold_meet_at_a_home_anchor(together):
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2)
    b = a.copy()
    for _ in range(4):
        b ^= np.uint64(1) << rnd.integers(0, 64, len(a), dtype=np.uint64)
    cover = simhash.Covering(4, together=together)
    ra, ka, ha = cover.anchors(a)
    rb, kb, _ = cover.anchors(b)
    home = {(r, k) for r, k, h in zip(ra, ka, ha) if h}
    met = {r for r, k in zip(rb, kb) if (r, k) in home}
    assert met == set(range(len(a)))


@pytest.mark.parametrize("text", ["", None, " \t\n", "one", "One two Three", "a b c d", "a b c d e", "É é A\xa0b " * 40, "x " * 10_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == fingerprint(text)


@pytest.mark.parametrize("paired_from", [0, 1 << 60])
def test_components_equal_all_pairs(spark, monkeypatch, paired_from):
    monkeypatch.setattr(simhash, "TILE", 3)  # many tiles
    monkeypatch.setattr(simhash, "ARRIVALS", 7)
    monkeypatch.setattr(simhash, "PAIRED_FROM", paired_from)
    rnd = random.Random(2)
    base = [" ".join(rnd.choice("the of and to in is it on as by".split()) + str(rnd.randrange(40)) for _ in range(150)) for _ in range(12)]
    rows = [(100 - i, None if i == 5 else "" if i == 6 else base[i % 12]) for i in range(30)]
    for i in range(60):
        w = rnd.choice(base).split()
        for _ in range(rnd.randrange(1, 4)):
            w[rnd.randrange(len(w))] = "changed"
        rows.append((200 + i, " ".join(w)))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(documents(spark, rows, extra=("fp", "root"))).collect()}
    assert got == components({i: fingerprint(t) for i, t in rows})


def test_long_chains_settle(spark):
    edges = [(k * 7 % 101, (k + 1) * 7 % 101) for k in range(100)] + [(500, 501), (501, 502)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(101)} == {0}
    assert got[502] == 500


def test_keep_first_leaves_one_of_each(spark):
    rows = [(3, "a b c d e f g"), (1, "a b c d e f g"), (1, "a b c d e f g"), (9, None), (8, ""), (None, "z y x w v u")]
    df = documents(spark, rows, extra=("fp", "d", "t", "hash", "last"))
    got = simhash.keep_first(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == [(False, 1), (False, 8), (True, 0)]
    assert list(got[0].asDict()) == df.columns
    assert simhash.keep_first(documents(spark, [])).count() == 0
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def near_copies(rnd, n):
    """Texts, and copies of them with some words changed."""
    words = [f"w{k}" for k in range(5000)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(60, 400))) for _ in range(n)]
    rows = [(k, t) for k, t in enumerate(texts)]
    for k in range(3 * n):
        w = texts[k % n].split()
        for _ in range(rnd.randrange(1, 2 + len(w) // 20)):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        rows.append((n + k, " ".join(w)))
    return rows


@pytest.mark.parametrize("tile", [3, 8192])
def test_keep_first_equals_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "ARRIVALS", 2 * tile)
    rows = near_copies(random.Random(4), 40) + [(5000, None), (5001, ""), (5002, "one two")]
    fps = {i: simhash.fingerprint_pair(t) for i, t in rows}
    most = simhash.bits_apart(0.8, 128, 1.0)
    root = {i: i for i in fps}
    for i in sorted(fps):
        for j in sorted(fps):
            if i < j:
                a, b = ((x ^ y).bit_count() for x, y in zip(fps[i], fps[j]))
                if a <= simhash.STAGE_THRESHOLD and a + b <= most and root[i] != root[j]:
                    low, high = sorted((root[i], root[j]))
                    root = {k: low if r == high else r for k, r in root.items()}
    got = {r.doc_id for r in simhash.keep_first(documents(spark, rows)).collect()}
    assert got == set(root.values())


def test_near_copies_by_similarity_are_found(spark):
    """Of pairs at a Jaccard similarity of 0.85 or more over five words most go, of those under 0.5 few."""
    rows = near_copies(random.Random(6), 60)
    shingles = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in rows for w in [t.split()]}
    got = {r.doc_id for r in simhash.keep_first(documents(spark, rows)).collect()}
    alike = lambda i, j: len(shingles[i] & shingles[j]) / len(shingles[i] | shingles[j])
    best = {i: max(alike(i, j) for j in shingles if j < i) for i in shingles if i >= 60}
    close, far = [i for i, s in best.items() if s >= 0.85], [i for i, s in best.items() if s < 0.5]
    assert sum(i not in got for i in close) >= 0.9 * len(close) and sum(i in got for i in far) >= 0.9 * len(far)


def test_bits_of_a_similarity():
    assert simhash.bits_apart(1.0, 64) == 0 and simhash.bits_apart(0.8, 64) == 9 and simhash.bits_apart(0.8, 128, 1.0) == 23
    h = np.arange(1 << 12, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert len(np.unique(simhash.mixed(h))) == len(h)


def test_very_long_texts(spark):
    rows = [(k, t) for k, t in enumerate(["a " * 500_000, "b" * 2_000_000, " " * 2_000_000, "\0" * 100_000, "0 " * 300_000])]
    assert simhash.near_duplicates(documents(spark, rows)).count() == 5 and simhash.keep_first(documents(spark, rows)).count() == 5
