import math
import random

import pytest

from placeforge.llm import urllm


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("https://A.Example.NET/En/x?q#f", ("a.example.net", "/En/x")),
        ("http://h#top", ("h", "")),
        ("x://h?q/y", ("h", "")),
        ("nothing", ("", "")),
        (None, ("", "")),
        ("", ("", "")),
        ("a://b://c/d", ("b:", "//c/d")),
        ("http://É.org/p", ("É.org", "/p")),
    ],
)
def test_split(url, want):
    assert urllm.split_url(url) == want


@pytest.mark.parametrize(
    ("host", "path", "want"),
    [
        ("x.net", "/a", ("net/", "block")),
        ("net", "/", ("net/", "block")),
        ("example.net", "/en/1", ("example.net/en/", "allow")),
        ("a.example.net", "/fr/1", ("net/", "block")),
        ("notexample.net", "/en/1", ("net/", "block")),
        ("example.com", "/de/", ("example.com/de/", "block")),
        ("myexample.com", "/de/", (None, None)),
        ("example.org", "/fr/x", ("org/fr/", "allow")),
        ("x.net", "", (None, None)),
        ("", "", (None, None)),
    ],
)
def test_rules(host, path, want):
    assert urllm.rule_of(host, path) == want


def slow_models(urls):
    """Counts of every context of 0 to 4 characters by dictionaries, for accepted and rejected URLs."""
    models = ({}, {})
    for u in urls:
        v = urllm.rule_of(*urllm.split_url(u))[1]
        if v and not urllm.held_out(u):
            code = [0] * 4 + [int(urllm._CODE[b]) for b in urllm.whole(u).encode()] + [0]
            for i in range(4, len(code)):
                for k in range(urllm.ORDERS):
                    own = models[v == "block"].setdefault(tuple(code[i - k : i]), {})
                    own[code[i]] = own.get(code[i], 0) + 1
    return models


def slow_score(models, text):
    if not text:
        return 0.0
    code = [0] * 4 + [int(urllm._CODE[b]) for b in text.encode()] + [0]
    total = 0.0
    for sign, model in zip((1, -1), models):
        for i in range(4, len(code)):
            p = 1 / urllm.SYMBOLS
            for k in range(urllm.ORDERS):
                row = model.get(tuple(code[i - k : i]))
                if row:
                    p = (row.get(code[i], 0) + len(row) * p) / (sum(row.values()) + len(row))
            total += sign * math.log(p)
    return total / (len(code) - 4)


def corpus():
    rnd = random.Random(1)
    out = [f"https://{rnd.choice('abcÄ')}.example.{rnd.choice(['net', 'com', 'org'])}/{rnd.choice(['en', 'de', 'fr', 'es'])}/{k}{rnd.choice(['', '?page=2&Ref=x', '#top'])}" for k in range(400)]
    return [*out, None, "", "no scheme", "http://", out[0], out[0]]


@pytest.mark.parametrize("most", [10**9, 0])
def test_ratios_and_verdicts_equal_a_slow_version(spark, most):
    urls = corpus()
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    got = {r.page_id: r for r in urllm.url_filter(df, most=most).collect()}
    models = slow_models([u for u in urls if u])
    want = {k: slow_score(models, urllm.whole(u)) for k, u in enumerate(urls)}
    assert all(abs(got[k].log_ratio - x) < 1e-5 for k, x in want.items()) and len(got) == len(urls)
    # The cut again: of unseen accepted URLs at most one in a hundred below it, halfway to the rejected where there is room.
    fold = {v: sorted(math.floor(want[k] * 1024) for k, u in enumerate(urls) if u and urllm.held_out(u) and urllm.rule_of(*urllm.split_url(u))[1] == v) for v in ("allow", "block")}
    high = fold["allow"][int(len(fold["allow"]) * 0.01)] / 1024
    low = (fold["block"][::-1][int(len(fold["block"]) * 0.01)] + 1) / 1024
    cut = (low + high) / 2 if low < high else high
    for k, u in enumerate(urls):
        if abs(want[k] - cut) > 1e-5:
            assert got[k].verdict == (urllm.rule_of(*urllm.split_url(u))[1] or ("allow" if want[k] >= cut else "block"))


def test_counts_are_exact_and_grow(spark):
    urls = [u for u in corpus() if u]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    want = {}
    for u in urls:
        code = [0] * 4 + [int(urllm._CODE[b]) for b in urllm.whole(u).encode()] + [0] if urllm.whole(u) else []
        v = urllm.rule_of(*urllm.split_url(u))[1] if not urllm.held_out(u) else None
        for i in range(4, len(code)):
            own = want.setdefault(sum(c << (6 * k) for k, c in enumerate(reversed(code[i - 4 : i + 1]))), [0, 0])
            own[0] += v == "allow"
            own[1] += v == "block"
    assert {r.gram: [r.accepted, r.rejected] for r in urllm.gather(df).collect()} == want
    assert urllm.gather(df.limit(50)).count() < len(want)


def test_ties_at_the_cut_are_allowed(spark):
    rows = [("allow", -1.0)] * 3 + [("block", -1.0)] * 3 + [(None, -1.0)]
    scored = spark.createDataFrame([(v, x, u) for (v, x), u in zip(rows, [u for u in (f"u{k}" for k in range(100)) if urllm.held_out(u)])], "verdict string, log_ratio double, url string")
    assert urllm.calibrate(scored) == -1.0
    assert urllm.calibrate(scored.limit(0)) == 0.0


def test_very_long_urls(spark):
    rows = [(1, "http://a.net/" + "x" * 500_000), (2, "http://" + "/" * 300_000), (3, "http://good.example.net/en/1"), (4, "://" * 100_000), (5, "\0" * 100_000)]
    assert urllm.url_filter(spark.createDataFrame(rows, "page_id long, url string")).count() == 5


def test_query_rows(spark):
    rows = [(k, f"http://good{k % 9}.example.net/en/{k}") for k in range(60)] + [(100 + k, f"http://spam-{k}.x.net/{k}") for k in range(60)]
    rows += [(300, None), (301, "no scheme"), (302, "http://good1.example.nex/en/7"), (303, "http://spam-1.x.nex/7"), (303, "http://spam-1.x.nex/7")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, host long, verdict string")
    got = {}
    for r in urllm.url_filter(df).collect():
        got.setdefault(r.page_id, []).append(r)
    assert len(got[303]) == 2 and got[300][0].host == "" and got[300][0].rule is None and got[301][0].verdict in ("allow", "block")
    assert got[302][0].verdict == "allow" and got[303][0].verdict == "block"
    assert all(got[k][0].verdict == "allow" and got[k][0].rule == "example.net/en/" for k in range(60))


def test_without_labels_everything_passes(spark):
    df = spark.createDataFrame([(1, "http://a.b/c"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in urllm.url_filter(df).collect()} == {"allow"}
    assert urllm.url_filter(df.limit(0)).count() == 0
