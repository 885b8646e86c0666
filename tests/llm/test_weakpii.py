import hashlib
import random
import re

from helpers import documents

from placeforge.llm import weakpii as w

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def base(text):
    """The contract's patterns as they are written."""
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub(r"[^0-9]", "", m[0])
            ok = (True, all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else 0, 12 <= len(d) <= 19 and w.luhn(d), 9 <= len(d) <= 15)[k]
            if ok:
                out.append((k, m.start(), m.end()))
    return sorted(out, key=lambda x: (x[1], x[0]))


def test_base_spans_equal_the_patterns():
    rnd = random.Random(3)
    parts = ["a@b.c", "x.y@z", "@", ".", "@d.e_f@g.h", "10.0.0.1", "1.2.3.4.5.6.7.8", "256.1.1.1", "007.08.9.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (269) 555-3296", "+", "+1", " ", "-", "12", "é", "\n", "٣", "+44 20 7946 0958 ", "....", "%+-"]
    for _ in range(3000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randrange(12)))
        assert w.base_spans(t) == base(t), t


def test_long_runs_are_linear():
    for t in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "a@" * 100_000, "+1 " * 70_000, "a@b" + ".c" * 100_000):
        w.base_spans(t)


def corpus():
    rnd = random.Random(5)
    rows = [(k, f"text {rnd.randrange(9)} call +1 (26{k % 10}) 555-32{k % 90 + 10} or mail me{k}@mail.example.com from 10.1.{k % 250}.7 card 4539578763621486 end") for k in range(60)]
    rows += [(100, "phone +1 (269) 555-3296 4539578763621486 next"), (101, None), (102, ""), (103, "nothing here 12 34"), (104, "token 0641917ea4e9feb9cda83477b57ac2654884f485 x"), (100, "phone +1 (269) 555-3296 4539578763621486 next")]
    return rows


def test_query_rows(spark):
    rows = corpus()
    got = {r.doc_id: r for r in w.find_pii(documents(spark, rows, extra=("spans", "base"))).collect()}
    for i, t in dict(rows).items():
        want = w.joined(base(t or ""))
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert not want or set(want.split(",")) <= set(got[i].spans.split(","))
        assert [got[i][f"n_{k}"] for k in w.KINDS] == [sum(x[0] == j for x in base(t or "")) for j in range(4)]
    assert got[100].spans == "phone:6:23,card:24:40"  # both are lost to the base patterns
    assert got[101].spans == got[102].spans == got[103].spans == got[104].spans == ""
    assert w.find_pii(documents(spark, [])).count() == 0


def test_redaction(spark):
    rows = corpus()
    got = {r.doc_id: r for r in w.redact(documents(spark, rows)).collect()}
    assert got[100].text == "phone [PHONE] [CARD] next" and got[100].n_chars == 25
    assert got[101].text is None and got[103].text == "nothing here 12 34"
    assert "@" not in got[0].text and "[IP]" in got[0].text


def test_em_finds_reliable_labelers():
    truth = {True: [2, 2, 1, 2], False: [0, 0, 1, 0]}
    counts = {}
    for good, votes in truth.items():
        n = 0
        for v in votes:
            n = n * 3 + v
        counts[(2 * 81 + n) * 8] = 100 if good else 40
    odd = (2 * 81 + (2 * 27 + 0 * 9 + 1 * 3 + 2)) * 8
    counts[odd] = 3
    posterior, table = w.reliabilities(counts)
    assert table[2, 0, 1, w.YES] > 0.9 and table[2, 0, 0, w.NO] > 0.8
    good = w.accepted(counts)
    assert max(counts, key=counts.get) in good and all(w.decode(c)[1][0] == w.YES for c in good)
    assert w.decode((3 * 81 + 80) * 8 + 7) == (3, [2, 2, 2, 2], 3, 1)
    assert w.accepted({}) == set()


def test_local_numbers_are_found_and_redacted(spark):
    rows = corpus() + [(k, f"please call 555-123-45{k % 90 + 10} today") for k in range(200, 230)]
    df = documents(spark, rows)
    got = {r.doc_id: r.spans for r in w.find_pii(df).collect()}
    assert got[200] == "phone:12:24"
    assert {r.doc_id: r.text for r in w.redact(df).collect()}[200] == "please call [PHONE] today"


def test_large_counts_keep_their_proportions():
    codes = [(2 * 81 + n) * 8 for n in (80, 0, 54)]
    counts = dict(zip(codes, (1_000_000, 400_000, 30_000), strict=True))
    posterior = dict(zip(codes, (0.99, 0.02, 0.6), strict=True))
    more = {c: n * 1000 for c, n in counts.items()}
    assert abs(w.train(counts, posterior) - w.train(more, posterior)).max() < 1e-6


def slow_added(texts):
    """Added spans by EM over single spans (not patterns) and plain gradient ascent of the classifier."""
    import math

    spans = []
    for i, t in texts:
        t = t or ""
        b = w.base_spans(t)
        spans += [(i, x, True, w.votes(t, *x), w.code(t, *x)) for x in b] + [(i, x, False, w.votes(t, *x), w.code(t, *x)) for x in w.further(t, b)]
    q = [(1 + 2 * v.count(w.YES)) / (2 + 2 * v.count(w.YES) + 2 * v.count(w.NO)) for _, _, _, v, _ in spans]
    for _ in range(50):
        prior, table = {}, {}
        for k in range(4):
            own = [n for n, s in enumerate(spans) if s[1][0] == k]
            prior[k] = (sum(q[n] for n in own) + 1) / (len(own) + 2)
            for j in range(4):
                for c in (0, 1):
                    mass = [sum((q[n] if c else 1 - q[n]) for n in own if spans[n][3][j] == v) + (2.0 if v == (w.YES if c else w.NO) else 0.5) for v in range(3)]
                    table[k, j, c] = [m / sum(mass) for m in mass]
        odds = [sum(math.log(table[s[1][0], j, 1][v] / table[s[1][0], j, 0][v]) for j, v in enumerate(s[3])) + math.log(prior[s[1][0]] / (1 - prior[s[1][0]])) for s in spans]
        q = [1 / (1 + math.exp(-max(-30, min(30, o)))) for o in odds]
    x = [w.features(s[4]) for s in spans]
    weights = x[0] * 0
    for _ in range(6000):
        grad = -weights
        for xi, y in zip(x, q):
            grad = grad + xi * (y - 1 / (1 + math.exp(-float(xi @ weights))))
        weights = weights + 0.02 * grad
    return {(i, s) for (i, s, is_base, _, _), xi in zip(spans, x) if not is_base and 1 / (1 + math.exp(-float(xi @ weights))) >= w.SURE}


def test_added_spans_equal_a_slow_version(spark):
    rows = [r for k, r in enumerate(corpus()) if k < 12 or r[0] in (103, 104)] + [
        (200, "call 555-123-4567 now"), (201, "order 555-123-4567 x"), (202, "card 4111111111111112 y"), (203, "write to joe(at)mail.com"),
        (204, "ip 1:2:3:4:5:6:7:8 z"), (205, "a4539578763621486"), (206, "phone +1 (269) 555-3296 4539578763621486 next"),
    ]
    want = slow_added(rows)
    got = set()
    for r in w.find_pii(documents(spark, rows)).collect():
        own = {(w.KINDS.index(k), int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)}
        got |= {(r.doc_id, x) for x in own - set(w.base_spans(dict(rows)[r.doc_id] or ""))}
    assert got == want and want


def test_very_long_texts(spark):
    texts = ["0" * 5000 + ".1.1.1", "0" * 2_000_000, " " * 2_000_000, "a" * 2_000_000, "\0" * 500_000, "1.1.1." + "0" * 6000 + "7"]
    got = {r.doc_id: r for r in w.find_pii(documents(spark, list(enumerate(texts)))).collect()}
    assert [got[k].n_ip for k in range(6)] == [1, 0, 0, 0, 0, 1]
    again = {r.doc_id: r for r in w.redact(documents(spark, list(enumerate(texts)))).collect()}
    assert again[0].text == "[IP]" and again[3].text == texts[3]


def test_redaction_keeps_any_columns(spark):
    df = documents(spark, corpus(), extra=("spans", "base")).drop("n_chars", "lang")
    got = w.redact(df)
    assert got.columns == df.columns and got.count() == df.count()
    assert {r.doc_id: r.text for r in got.collect()}[100] == "phone [PHONE] [CARD] next"
