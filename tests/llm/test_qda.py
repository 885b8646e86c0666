import math
import random
import zlib

import numpy as np
from helpers import documents

from placeforge.llm import qda


def corpus(n=400):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9)))
    docs, labels = [], []
    for k in range(n):
        m = rnd.randrange(20, 200)
        if k % 4 == 0:
            t = rnd.choice([lambda: " ".join([word()] * m), lambda: " ".join(word().upper() + "!!" for _ in range(m)), lambda: " ".join(word() + "***" for _ in range(m))])()
        else:
            t = ". ".join(" ".join(word() for _ in range(8)).capitalize() for _ in range(m // 8 + 1))
        docs.append((k, t))
        labels.append((k, int(k % 4 != 0)))
    return docs, labels


def test_scores_equal_dense_gaussians():
    rnd = np.random.default_rng(0)
    x = np.concatenate([rnd.normal(0, 1, (300, 5)), rnd.normal(1.5, 2, (200, 5))])
    y = np.array([1] * 300 + [0] * 200)
    m = qda.fit(x, y)
    cov = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    within = (cov[0] * 200 + cov[1] * 300) / 500
    logs = []
    for k, n in ((0, 200), (1, 300)):
        s = (1 - qda.POOLED - qda.DIAGONAL) * cov[k] + qda.POOLED * within + qda.DIAGONAL * np.diag(np.diag(within)) + 1e-9 * np.eye(5)
        d = x - x[y == k].mean(0)
        logs.append(math.log(n / 500) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * (d @ np.linalg.inv(s) * d).sum(1))
    assert np.allclose(m.scores(x), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-9)


def test_held_out_accuracy_and_rows(spark):
    docs, labels = corpus()
    rows = docs + [(1000, None), (1001, ""), (1002, " "), (None, "no id here"), (5, docs[5][1])]
    lab = spark.createDataFrame(labels + [(1001, None), (None, 1)], "doc_id long, quality int")
    got = qda.quality(documents(spark, rows, extra=("score", "__y")), lab).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    held = [k for k, _ in docs if zlib.crc32(str(k).encode()) % 5 == 0]
    assert {k for k in by if by[k].held_out} >= set(held) and by[None].held_out is False
    assert all(by[k].predicted == int(k % 4 != 0) for k in held)
    assert all(r.predicted == int(r.score >= 0.3) for r in got)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = corpus(120)
    df = documents(spark, docs)
    flip = [(k, 1 - q if zlib.crc32(str(k).encode()) % 5 == 0 else q) for k, q in labels]
    a, b = ({r.doc_id: r.score for r in qda.quality(df, spark.createDataFrame(x, "doc_id long, quality int")).collect()} for x in (labels, flip))
    assert a == b


def test_without_two_classes(spark):
    docs, _ = corpus(8)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in qda.quality(documents(spark, docs), none).collect()} == {0.5}
    ones = spark.createDataFrame([(k, 1) for k in range(8)], "doc_id long, quality int")
    assert {r.score for r in qda.quality(documents(spark, docs), ones).collect()} == {1.0}
    assert qda.quality(documents(spark, []), none).count() == 0


def test_the_fitting_sample_is_bounded(spark):
    docs, labels = corpus(400)
    x, y = qda.labelled_vectors(documents(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int"), most=100)
    assert 50 < len(x) < 160 and len(x) == len(y)
