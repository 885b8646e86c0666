import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, substring_dedup

from placeforge.llm import induced, sufdedup


@pytest.mark.parametrize("memory", [8, 10**6])
def test_suffix_order_equals_sorting(memory):
    rnd = random.Random(3)
    for kinds in (1, 2, 3, 20):
        for _ in range(25):
            t = [2 + rnd.randrange(kinds) for _ in range(rnd.randrange(1, 300))] + [0]
            got = induced.suffix_order(np.array(t, dtype=np.int16), memory_items=memory)
            assert got.tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def mixed(seed, n=160):
    """Copies, near copies, shared passages, periodic texts, and texts around the width."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(2, 8)))
    passage = [" ".join(word() for _ in range(k)) for k in (12, 20, 25, 60)]
    out = []
    for i in range(n):
        kind = rnd.randrange(9)
        if kind == 0 and out:
            t = rnd.choice(out)[1]
        elif kind == 1 and out:
            t = list(rnd.choice(out)[1] or "")
            for _ in range(3):
                if t:
                    t[rnd.randrange(len(t))] = rnd.choice("xyz")
            t = "".join(t)
        elif kind == 2:
            t = "ab" * rnd.randrange(0, 200)
        elif kind == 3:
            t = "!" * rnd.choice([0, 1, 99, 100, 101, 350])
        elif kind == 4:
            t = None
        else:
            t = " ".join(word() for _ in range(rnd.randrange(1, 80)))
            for _ in range(rnd.randrange(3)):
                at = rnd.randrange(len(t) + 1)
                t = t[:at] + rnd.choice(passage) + t[at:]
        out.append((i, t))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_removed_bytes_equal_brute_force(spark, seed):
    rows = mixed(seed)
    df = documents(spark, rows, extra=("rid", "h", "s", "n")).repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sufdedup.substring_dedup(df).collect()}
    assert got == substring_dedup(rows)


def test_long_texts_are_cut_into_pieces(spark, monkeypatch):
    rnd = random.Random(5)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(2_300_000))
    rows = [(1, long), (2, long[1_048_000:1_049_400]), (3, "x" + long[5:2_200_000])]
    df = documents(spark, rows)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in sufdedup.substring_dedup(df).collect()}
    assert got[1] == (2_300_000, 0, 0)
    assert got[2] == (1400, 1400, 1)
    assert got[3] == (2_199_996, 2_199_995, 1)


def test_batches_of_any_size_match_alike():
    rows = []
    rnd = random.Random(9)
    for h in range(60):
        for _ in range(rnd.randrange(1, 5)):
            rows.append((h, rnd.randrange(3), rnd.randrange(50), 0, rnd.randrange(9), 5 | 2 << 8))
    rows.sort()
    whole = None
    for size in (1, 2, 3, 7, 1000):
        parts = [sufdedup._table(*(np.array([r[k] for r in rows[i : i + size]]) for k in range(6))) for i in range(0, len(rows), size)]
        got = sorted(tuple(r.values()) for b in sufdedup._match_runs(iter(parts)) for r in b.to_pylist())
        whole = whole or got
        assert got == whole


def test_repeated_and_empty_tables(spark):
    t = "one sentence that is longer than a hundred bytes, so that all of it can be found again in a second copy of it"
    got = sufdedup.substring_dedup(documents(spark, [(7, t), (7, t)])).collect()
    assert sorted(r.n_removed for r in got) == [0, len(t)]
    assert sufdedup.substring_dedup(documents(spark, [])).count() == 0


def test_rows_alike_among_near_copies(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8)))
    base = [word() for _ in range(120)]
    rows = []
    for i in range(40):
        w = list(base)
        w[rnd.randrange(len(w))] = "other"
        rows.append((i, " ".join(w)))
    want = substring_dedup(rows)
    got = sufdedup.substring_dedup(documents(spark, [*rows, rows[0], rows[9], rows[9]]).repartition(3)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    for i, rs in by.items():
        assert want[i] in rs and len(rs) == {0: 2, 9: 3}.get(i, 1)
        assert all(r == want[i] or r[1] == r[0] for r in rs)


@pytest.mark.parametrize("hot_bytes", [0, 3000])
def test_hot_keys_are_split_without_loss(spark, hot_bytes):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(2, 8)))
    passage = " ".join(word() for _ in range(25))
    rows = mixed(12, 60) + [(i, f"{' '.join(word() for _ in range(20))} {passage} {' '.join(word() for _ in range(20))}") for i in range(60, 120)]
    df = documents(spark, rows).repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sufdedup.substring_dedup(df, hot_bytes=hot_bytes).collect()}
    assert got == substring_dedup(rows)


def test_no_sort_takes_more_than_a_hot_key(monkeypatch):
    taken = []
    monkeypatch.setattr(sufdedup, "cover", lambda d, r, s, n, texts, w: taken.append(sum(map(len, texts))) or np.zeros((4, 0), dtype=np.int64))
    rnd = random.Random(13)
    rows = [(k, i, 0, 0, 10, bytes(rnd.randrange(256) for _ in range(109))) for k, n in ((1, 3), (2, 500), (3, 2), (4, 400), (5, 2)) for i in range(n)]
    for step in (1, 7, 1000):
        taken.clear()
        names = ["key", "doc", "rid", "s", "n", "text"]
        parts = [pa.RecordBatch.from_pydict({c: [r[k] for r in rows[i : i + step]] for k, c in enumerate(names)}) for i in range(0, len(rows), step)]
        passed = sum(b.num_rows for b in sufdedup._sort(iter(parts), 100, 20_000))
        assert passed == 900 and sum(taken) == 7 * 109


def test_names_are_sorted_recursively():
    rnd = random.Random(8)
    for _ in range(300):
        kinds = rnd.randrange(2, 6)
        s = [rnd.randrange(1, kinds) for _ in range(rnd.randrange(60))] * rnd.randrange(1, 4) + [0]
        assert induced.order_of_names(s, kinds) == sorted(range(len(s)), key=lambda i: s[i:])


def test_queues_spill_and_let_go(tmp_path):
    q = induced.Queues(4, memory_items=10, folder=str(tmp_path))
    for k in range(6):
        q.put(k % 3, np.arange(4, dtype=np.int32) + 10 * k)
    assert q.spilled >= 12 and q.held <= 10
    assert q.whole(0).tolist() == [0, 1, 2, 3, 30, 31, 32, 33]
    assert q.whole(1).tolist() == [10, 11, 12, 13, 40, 41, 42, 43] and q.whole(2).tolist() == [20, 21, 22, 23, 50, 51, 52, 53]
    for c in range(3):
        q.drop(c)
    assert q.held == 0 and q.whole(0).tolist() == []
    q.close()


def test_a_sort_of_production_size_spills():
    rnd = np.random.default_rng(1)
    t = np.concatenate([rnd.integers(2, 28, sufdedup.SORT_BYTES), [induced.END]]).astype(np.int16)
    small = induced.types(t)
    lms = (np.nonzero(small[1:] & ~small[:-1])[0] + 1).astype(np.int32)
    up, down = induced.induce(t, small, lms, induced.MEMORY_ITEMS, None)
    assert up.spilled > 0 and down.spilled > 0
    order = induced.suffix_order(t)
    raw = (t.astype(np.uint8)).tobytes()
    some = order[rnd.integers(0, len(order) - 1, 2000)]
    assert len(np.unique(order)) == len(t)
    at = np.nonzero(np.isin(order, some))[0]
    assert all(raw[order[k] :][:400] <= raw[order[k + 1] :][:400] for k in at if k + 1 < len(order))


def test_a_sort_takes_few_passes(monkeypatch):
    """Small blocks of a queue are taken together, so passes don't multiply from bucket to bucket."""
    passes = []
    deal = induced.Queues.deal
    monkeypatch.setattr(induced.Queues, "deal", lambda q, p, ch: passes.append(len(p)) or deal(q, p, ch))
    rnd = np.random.default_rng(2)
    t = np.concatenate([rnd.integers(2, 28, 1 << 17), [induced.END]]).astype(np.int16)
    small = induced.types(t)
    lms = (np.nonzero(small[1:] & ~small[:-1])[0] + 1).astype(np.int32)
    induced.induce(t, small, lms, induced.MEMORY_ITEMS, None)
    assert 0 < sum(map(bool, passes)) < 26 * 20


@pytest.mark.parametrize("items", [1, 3, 50])
def test_blocks_of_any_size_sort_alike(monkeypatch, items):
    monkeypatch.setattr(induced, "BLOCK_ITEMS", items)
    rnd = random.Random(6)
    for kinds in (1, 2, 4):
        for memory in (8, 10**6):
            t = [2 + rnd.randrange(kinds) for _ in range(400)] + [0]
            got = induced.suffix_order(np.array(t, dtype=np.int16), memory_items=memory)
            assert got.tolist() == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("width", [33, 300, 400])
def test_other_widths_equal_brute_force(spark, width):
    rnd = random.Random(width)
    phrase = "".join(rnd.choice("abcd ") for _ in range(900))
    rows = []
    for k in range(60):
        a = rnd.randrange(300)
        rows.append((k, "".join(rnd.choice("xyz ") for _ in range(rnd.randrange(200))) + phrase[a : a + rnd.randrange(width - 20, width + 250)] + "".join(rnd.choice("xyz ") for _ in range(rnd.randrange(200)))))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sufdedup.substring_dedup(documents(spark, rows), width).collect()}
    assert got == substring_dedup(rows, width)
    with pytest.raises(ValueError, match="width"):
        sufdedup.substring_dedup(documents(spark, rows), 1 << 15)


def test_null_and_greatest_ids(spark):
    """A null doc_id comes after every other, the greatest one included, and both keep their ids."""
    rnd = random.Random(3)
    text = "".join(rnd.choice("abcdef ") for _ in range(300))
    rows = [((1 << 63) - 1, text), (None, text), (5, "short")]
    got = {r.doc_id: r.n_removed for r in sufdedup.substring_dedup(documents(spark, rows)).collect()}
    assert got == {(1 << 63) - 1: 0, None: 300, 5: 0}
    rows += [((1 << 63) - 1, "other " + text), (None, text)]
    got = sorted(((r.doc_id or 0, r.n_bytes, r.n_removed) for r in sufdedup.substring_dedup(documents(spark, rows)).collect()), key=str)
    assert sum(n for _, _, n in got) == 900 and sum(i == 0 for i, _, _ in got) == 2
