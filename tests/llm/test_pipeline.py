import corpus_pipeline
import pytest
from helpers import DOCUMENTS, decontaminate, documents
from pyspark.sql import functions as F

from placeforge.llm import nbest, qda, queries, simhash
from placeforge.llm.weakpii import base_spans


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus: clean texts, junk, copies, a benchmark text, personal data, nulls."""
    import random

    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9)))
    clean = lambda: ". ".join(" ".join(word() for _ in range(9)).capitalize() for _ in range(12))
    docs = [(k, " ".join([word()] * 90) if k % 5 == 0 else clean()) for k in range(200)]
    docs[11] = (11, docs[6][1])
    docs[12] = (12, docs[6][1] + " x")
    item = clean()
    docs[13] = (13, docs[13][1] + " " + item)
    docs[14] = (14, docs[14][1] + " write to joe.1@mail.example.com now")
    docs += [(300, None), (301, "")]
    d = tmp_path_factory.mktemp("corpus")
    documents(spark, docs).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(k, int(k % 5 != 0), 0) for k in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def near_copies_gone(texts):
    """The least id of each component of pairs whose two fingerprint words are close, by comparing all pairs."""
    fps = {i: simhash.fingerprint_pair(t) for i, t in texts.items()}
    most = simhash.bits_apart(simhash.SIMILARITY, 128, 1.0)
    root = {i: i for i in fps}
    for i in sorted(fps):
        for j in sorted(fps):
            if i < j and root[i] != root[j]:
                a, b = ((x ^ y).bit_count() for x, y in zip(fps[i], fps[j]))
                if a <= simhash.STAGE_THRESHOLD and a + b <= most:
                    low, high = sorted((root[i], root[j]))
                    root = {k: low if r == high else r for k, r in root.items()}
    return set(root.values())


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert 4 <= len(stages) <= 5

    step = stages["quality classifier"](spark, docs, folder)
    scored = {r.doc_id: r.predicted for r in qda.quality(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    want = {i for i, p in scored.items() if p == 1}
    assert {r.doc_id for r in step.collect()} == want >= {k for k in range(200) if k % 5}

    before = {r.doc_id: r.text for r in step.collect()}
    step = stages["simhash near-duplicates"](spark, step, folder)
    want = near_copies_gone(before)
    assert {r.doc_id for r in step.collect()} == want and not {11, 12} & want

    before = {r.doc_id: r.text for r in step.collect()}
    step = stages["benchmark decontamination"](spark, step, folder)
    bench = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = {i for i, r in decontaminate(before.items(), bench).items() if not r[4]}
    assert {r.doc_id for r in step.collect()} == want and 13 not in want

    step = stages["personal data"](spark, step, folder)
    assert [(f.name, f.dataType.simpleString()) for f in step.schema] == [tuple(c.replace("long", "bigint").split()) for c in DOCUMENTS.split(", ")]
    after = {r.doc_id: r for r in step.collect()}
    assert set(after) == want and after[14].text.endswith("write to [EMAIL] now") and after[14].n_chars == len(after[14].text)
    assert all(not base_spans(r.text or "") for r in after.values())

    last = {r.doc_id: r for r in stages["sentencepiece n-best"](spark, step, folder).collect()}
    enc = nbest.Encoder(nbest.Vocabulary.load())
    assert set(last) == want and all(r.exact and enc.decode(r.ids) == (after[i].text or "") for i, r in last.items())


def test_run_is_the_registered_query(spark, folder):
    got = queries.QUERIES["pipeline"](spark, folder)
    assert got.filter(~F.col("exact")).count() == 0 and got.count() > 100


def test_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_names_of_the_queries():
    assert [n for n in queries.QUERIES if n.startswith("op")] == sorted((n for n in queries.QUERIES if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert len(queries.QUERIES) == 11
