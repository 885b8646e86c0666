import math
import random
import time

import pytest
from helpers import documents

from placeforge.llm import nbest

VOC = nbest.Vocabulary.load()


def every_path(word):
    """All (score, ids) of a lattice by recursion."""
    if not word:
        return [(0.0, ())]
    out, single = [], False
    for e in range(1, len(word) + 1):
        p = VOC.pieces.get(word[:e])
        if p:
            single |= e == 1
            out += [(p[1] + s, (p[0], *i)) for s, i in every_path(word[e:])]
    if not single:
        raw = word[0].encode()
        out += [(VOC.byte_score * len(raw) + s, (*(VOC.bytes[b] for b in raw), *i)) for s, i in every_path(word[1:])]
    return out


@pytest.mark.parametrize("word", ["▁the", "▁tiontion", "ab", "▁", "▁▁x", "é☃a", "͸͹", "aaaaaaa"])
def test_words_equal_all_paths(word):
    want = sorted((s for s, _ in every_path(word)), reverse=True)
    got = nbest.n_best(word, VOC, 6)
    assert [s for s, _ in got] == want[:6]
    assert len({i for _, i in got}) == len(got)
    best, ids, loss, n_bytes = nbest.viterbi(word, VOC)
    assert best == want[0] and (best, ids) in every_path(word)
    assert n_bytes == sum(VOC.is_byte[i] for i in ids)
    assert loss == (want[0] - want[1] if len(want) > 1 else float("inf"))


@pytest.mark.parametrize("text", ["a b", "the of\nin", "ab  c", " x ", "thsh é\n\nwh"])
def test_texts_equal_all_paths_of_the_whole_lattice(text):
    want = sorted((s for s, _ in every_path("▁" + text.replace(" ", "▁"))), reverse=True)
    got = nbest.Encoder(VOC, 8).encode(text)
    assert [s for s, _ in got] == want[:8]
    assert len({tuple(i) for _, i in got}) == len(got)


def test_round_trip_of_odd_texts():
    rnd = random.Random(1)
    enc = nbest.Encoder(VOC)
    odd = ["", " ", "  a", "a  ", "\n", "\t\r\n", "\0", "\U0001f600 x", "ﬁ ½", "a" * 5000, "é́", "word " * 3000]
    odd += ["".join(rnd.choice("ab \nÉ☃一#1") for _ in range(rnd.randrange(60))) for _ in range(200)]
    for t in odd:
        for _, ids in enc.encode(t):
            assert enc.decode(ids) == t


def test_query_rows(spark):
    rows = [(1, "the of and"), (2, None), (3, ""), (4, "the of and"), (None, "x▁y")]
    got = {r.doc_id: r for r in nbest.encode_documents(documents(spark, rows, extra=("ids", "n_pieces"))).collect()}
    assert got[2].n_pieces == 0 and got[2].exact and got[2].n_paths == 1 and got[3].best_score == 0
    assert got[1].ids == got[4].ids and got[1].n_paths == 4 and got[1].exact and not got[None].exact
    paths = nbest.Encoder(VOC).encode("the of and")
    second = paths[1][1]
    assert second[got[1].second_at : got[1].second_at + len(got[1].second_ids)] == got[1].second_ids
    assert nbest.encode_documents(documents(spark, [])).count() == 0


def test_rows_hold_all_n_paths(spark):
    texts = ["the of and", "thsh é\n\nwh tiontion", "", None, "a", "x▁y", "word " * 40]
    enc = nbest.Encoder(VOC)
    for r in nbest.encode_documents(documents(spark, list(enumerate(texts)))).collect():
        want = enc.encode(texts[r.doc_id])
        got = []
        for p in r.paths:
            ids = list(r.ids)
            for c in reversed(p.changes):
                ids[c.at : c.at + c.n] = c.ids
            got.append((p.score, ids))
            assert p.exact == (enc.decode(ids) == (texts[r.doc_id] or ""))
        assert got == want and len(got) == r.n_paths and got[-1][0] == r.last_score


def test_scores_are_log_probabilities():
    total = sum(math.exp(w) for _, w in VOC.pieces.values())
    assert 0.99 < total < 1.01 and VOC.byte_score < min(w for _, w in VOC.pieces.values())
    # A known word is one piece, however late it was merged.
    assert [VOC.names[i] for i in nbest.Encoder(VOC).encode("The quick")[0][1]] == ["▁The", "▁quick"]


def test_best_paths_are_close_to_the_model_s_own():
    """The model merges greedily, the search doesn't; on common words both give the same pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=nbest.MODEL)
    words = "The quick brown fox jumps over the lazy dog near an old bridge where people wait for the morning train and read their papers".split()
    same = sum(nbest.Encoder(VOC).encode(w)[0][1] == model.encode(w) for w in words)
    assert same > 0.9 * len(words)


@pytest.mark.parametrize("make", [lambda n: "a" * n, lambda n: "qz" * n, lambda n: " " * n, lambda n: "é☃" * n, lambda n: "\0" * n, lambda n: "ab " * n, lambda n: "#" * n])
def test_time_grows_with_length(make):
    def took(n):
        start = time.perf_counter()
        got = nbest.Encoder(VOC).encode(make(n))
        assert all(sum(len(VOC.raw[i]) for i in ids) for _, ids in got)
        return time.perf_counter() - start

    took(100)
    assert took(100_000) < 9 * max(took(25_000), 0.05)


def test_very_long_texts_round_trip(spark):
    texts = ["a" * 1_000_000, " " * 1_000_000, "\0" * 200_000, "word " * 200_000]
    rows = nbest.encode_documents(documents(spark, list(enumerate(texts)))).collect()
    assert len(rows) == 4 and all(r.exact and all(p.exact for p in r.paths) for r in rows)
