import random

from helpers import decontaminate, documents

from placeforge.llm import decontam


def rows_of(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


def case(seed=4):
    rnd = random.Random(seed)
    words = [rnd.choice(["the", "of", "Ünï", "q1", "B2b", "and"]) + str(rnd.randrange(30)) for _ in range(400)]
    bench = [(k, " ".join(words[k * 20 : k * 20 + rnd.randrange(14, 40)])) for k in range(10)]
    bench += [(20, "three Little words"), (21, "x"), (22, ""), (23, None), (24, bench[0][1]), (25, "five words, are just enough")]
    docs = []
    for i in range(80):
        w = [rnd.choice(["pad", "the", "of"]) + str(rnd.randrange(50)) for _ in range(rnd.randrange(0, 200))]
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(w) + 1)
            w[at:at] = words[(k := rnd.randrange(380)) : k + rnd.randrange(5, 60)]
        if i % 9 == 0:
            w.append("three LITTLE-words")
        docs.append((i, rnd.choice([" ", "\n", ", "]).join(w)))
    return docs + [(90, None), (91, ""), (92, "x"), (93, "--- ...")], bench


def test_hits_equal_brute_force(spark, monkeypatch):
    docs, bench = case()
    b = spark.createDataFrame(bench, "item_id long, text string")
    want = decontaminate(docs, bench)
    df = documents(spark, docs, extra=("th", "w", "pos", "key"))
    assert rows_of(decontam.decontaminate(df, b)) == want
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)  # the way beyond the bound
    assert rows_of(decontam.decontaminate(df, b)) == want


def test_clean_drops_contaminated_rows_only(spark, monkeypatch):
    docs, bench = case(6)
    b = spark.createDataFrame(bench, "item_id long, text string")
    want = sorted(i for i, r in decontaminate(docs, bench).items() if not r[4])
    for most in (decontam.BROADCAST_KEYS, 0):
        df = documents(spark, docs, extra=("__d", "__t", "th"))
        got = decontam.drop_rows(df, decontam.bad_rows(df, b), most)
        assert got.columns == df.columns
        assert sorted(r.doc_id for r in got.collect()) == want


def test_empty_benchmark_and_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontam.decontaminate(documents(spark, [(1, "a b c"), (1, "a b c")]), none).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in got] == [(3, 0, False)] * 2
    one = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontam.decontaminate(documents(spark, []), one).count() == 0


def test_main_path_is_native(spark):
    docs, bench = case()
    df = decontam.decontaminate(documents(spark, docs), spark.createDataFrame(bench, "item_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_beyond_the_bound_no_text_is_dealt_by_position(spark, monkeypatch):
    """The shuffle of positions carries keys only; words come back for what matched."""
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    docs, bench = case()
    h = decontam.hits(documents(spark, docs), spark.createDataFrame(bench, "item_id long, text string"))
    plan = h._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "key#" in plan


def test_very_long_texts(spark, monkeypatch):
    item = " ".join(f"w{k}" for k in range(20))
    docs = [(1, "a " * 300_000), (2, "b" * 1_000_000), (3, " " * 1_000_000), (4, ("x " * 50_000) + item + (" y" * 50_000)), (5, "\0" * 200_000), (6, item * 2000)]
    b = spark.createDataFrame([(1, item), (2, "z " * 100_000), (3, "a a")], "item_id long, text string")
    want = None
    for most in (64 << 20, 0):
        monkeypatch.setattr(decontam, "BROADCAST_BYTES", most)
        got = rows_of(decontam.decontaminate(documents(spark, docs), b))
        assert got[1][1:3] == (300_000, 1) and got[4][1:3] == (20, 1) and got[2][:2] == (1, 0) and got[3][0] == 0
        assert want in (None, got)
        want = got
