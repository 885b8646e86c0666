import itertools
import math
import random
import time

import pytest

from placeforge.llm import density as d
from placeforge.llm.density import extract, main_text

LONG = "A sentence of the article that is long enough to weigh more than any menu on this page."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("<html><head><title>t</title></head><body></body></html>", ""),
        (f"<body><nav><a href=x>Home</a></nav><article><h1>T</h1><p>{LONG}</p><p>{LONG}</p></article><footer>f</footer>", f"T\n{LONG}\n{LONG}"),
        (f"<body><div class='ad'>buy</div><article><p><b>{LONG}<br><p>two&amp;&eacute; &lt;x&gt;</p></article>", f"{LONG}\ntwo&é <x>"),
        (f"<body><article><p>{LONG}</p><p>a\n  b<br>c&nbsp;d</p><ul><li>x<li>y</ul></article>", f"{LONG}\na b c d\nx\ny"),
        (f"<body><div id=main><p>{LONG}</p><div class='comments'><p>{LONG} no</p></div><p>{LONG}</p></div><aside>{LONG}</aside>", f"{LONG}\n{LONG}"),
        (f"<body><header><h1>Site</h1></header><main><p>{LONG}</p><form>f<input></form><script>var a='<p>no</p>'</script><style>p{{}}</style><!-- <p>no</p> --></main>", LONG),
        (f"<body><article><p>{LONG}</p><section id='comments'><article class='comment'>no</article></section></article>", LONG),
        (f"<body><article><p>{LONG}</p><p>short</p><div class='notice'>no</div><table><tr><td>c1<td>c2</table><p>cut &am", f"{LONG}\nshort\nc1\nc2\ncut &am"),
        (f"<body><p>{LONG}</p></body>", LONG),
        ("plain text only", "plain text only"),
        (f"<body><article><p>{LONG}</p><p>1 < 2 and a > b</p></article>", f"{LONG}\n1 < 2 and a > b"),
    ],
)
def test_pages(page, want):
    assert main_text(page) == want


def test_deep_and_long_pages_end():
    deep = "<div>" * 30_000 + LONG + "</div>" * 30_000
    assert main_text(f"<body>{deep}") == LONG
    assert main_text("<body><article>" + f"<p>{LONG}</p>" * 20_000).count("\n") == 19_999
    assert main_text("<" * 50_000).strip("<") == ""


def test_query_rows(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", 9), (1, "u", f"<article><p>{LONG}</p></article>", 9), (2, None, None, 9)]
    got = sorted(extract(spark.createDataFrame(rows, "page_id long, url string, html string, text long")).collect())
    assert [(r.page_id, r.text, r.n_chars) for r in got] == [(1, LONG, len(LONG))] * 2 + [(2, "", 0)]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


KEPT = "Another sentence that has to stay on the page because it is a part of the text itself."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        # One furniture word beside other words is no furniture.
        (f"<article><p>{LONG}</p><section id='related-work'><p>{KEPT}</p></section></article>", f"{LONG}\n{KEPT}"),
        (f"<article><div class='entry-header'><h1>Title</h1></div><p>{LONG}</p></article>", f"Title\n{LONG}"),
        (f"<article><p>{LONG}</p><p class='social-history'>{KEPT}</p></article>", f"{LONG}\n{KEPT}"),
        (f"<article><p>{LONG}</p><div class='x ad-box'>{KEPT}</div><div id='comments-area'>{KEPT}</div></article>", LONG),
        # No mark at all: density alone tells menus and link lists from text.
        (f"<body><div><ul>{'<li><a href=x>link to a page</a></li>' * 8}</ul></div><div><h1>Title</h1><p>{LONG}</p><p>{KEPT}</p><p>ok.</p></div><div><a href=x>a</a> <a href=y>b</a></div></body>", f"Title\n{LONG}\n{KEPT}\nok."),
        (f"<body><div><p>{LONG}</p><ul>{'<li><a href=x>other page</a></li>' * 5}</ul><p>{KEPT}</p></div></body>", f"{LONG}\n{KEPT}"),
        # What stands beside the core stays by the threshold, and short text with it.
        (f"<body><article><h1>A title of some words</h1><div><p>{LONG}</p><p>{KEPT}</p></div><p>ok.</p><p>{KEPT}</p></article><div>x</div></body>", f"A title of some words\n{LONG}\n{KEPT}\nok.\n{KEPT}"),
        (f"<body><article><p>{LONG}</p><p>{KEPT}</p></article><article><p>{KEPT}</p><p>{LONG}</p></article></body>", f"{LONG}\n{KEPT}\n{KEPT}\n{LONG}"),
        (f"<body><form id=frame><div><p>{LONG}</p><p>{KEPT}</p><form>search</form></div></form></body>", f"{LONG}\n{KEPT}"),
        (f"<body><div class=post><header><h1>Title</h1></header><p>{LONG}</p><p>{KEPT}</p></div><div>x</div>", f"Title\n{LONG}\n{KEPT}"),
        (f"<body><div id=story>{LONG}<br><br>{KEPT}</div><div><a href=x>n</a></div>", f"{LONG} {KEPT}"),
        (f"<body><article><p>{LONG}</p><p data-id='comments' title=\"a > b\">{KEPT}</p></article>", f"{LONG}\n{KEPT}"),
    ],
)
def test_what_stays(page, want):
    assert main_text(page) == want


def test_density_decides(monkeypatch):
    """Without densities nothing is found; with another density another part of the page is."""
    page = f"<body><div id=a><p>{LONG}</p><p>{KEPT}</p></div><div id=b><p>{'<a href=x>w</a> ' * 30}</p><p>x</p></div></body>"
    assert main_text(page) == f"{LONG}\n{KEPT}"
    monkeypatch.setattr(d, "density", lambda *a: 0.0)
    assert main_text(page) == ""
    monkeypatch.setattr(d, "density", lambda c, lc, t, lt, r: 100.0 * lc)
    assert main_text(page) != f"{LONG}\n{KEPT}"


def slow(node, ratio):
    """(chars, linked chars, tags, linked tags, density, sum) of a node by walking its whole subtree."""

    def below(n):
        return [n, *itertools.chain.from_iterable(below(x) for x in n.items if isinstance(x, d.Node))]

    def linked(n, top):
        while n is not top.parent:
            if n.tag == "a":
                return True
            n = n.parent
        return False

    def text(n):
        return sum(not c.isspace() for x in n.items if isinstance(x, str) for c in x)

    def full(n):
        seen = [x for x in below(n) if not x.silent]
        c, lc = sum(map(text, seen)), sum(text(x) for x in seen if linked(x, n))
        t = [x for x in seen if x is not n and x.tag not in d.VOID]
        lt = sum(linked(x, n) for x in t) + (n.tag == "a")
        if not c:
            return c, lc, len(t), lt, 0.0
        base = math.log(ratio * c + c * lc / max(c - lc, 1) + math.e)
        links = c / max(lc, 1) * max(len(t), 1) / max(lt, 1)
        return c, lc, len(t), lt, c / max(len(t), 1) * math.log(max(links, 1)) / max(math.log(base), 0.1)

    total = sum(full(x)[4] for x in node.items if isinstance(x, d.Node) and not (x.silent or x.junk or x.head))
    for x in node.items:
        if isinstance(x, str):
            c = sum(not ch.isspace() for ch in x)
            total += d.density(c, c * (node.tag == "a"), 1, int(node.tag == "a"), ratio)
    return (*full(node), total)


def test_measures_equal_brute_force():
    rnd = random.Random(4)
    tags = ["div", "p", "a", "span", "b", "ul", "li", "section", "nav", "article", "br", "script"]
    for _ in range(150):
        page = "<body>" + "".join(rnd.choice([f"<{rnd.choice(tags)}>", f"</{rnd.choice(tags)}>", "word ", "some more words of text ", "<p class=ad>"]) for _ in range(rnd.randrange(50)))
        nodes = d.walk(d.parse(page))
        d.measure(nodes)
        body = d.body_of(nodes)
        ratio = body.link_chars / max(body.chars, 1)
        for n in nodes:
            # A link in a link would count twice; the parser keeps it, so leave such trees out.
            if not n.silent and not any(x.tag == "a" and any(y.tag == "a" for y in d.walk(x)[1:]) for x in nodes):
                assert (n.chars, n.link_chars, n.tags, n.link_tags, pytest.approx(n.density), pytest.approx(n.total)) == slow(n, ratio)
        best, threshold = d.core(nodes)
        fit = [n for n in nodes if not (n.junk or n.head or n.silent) and (n.tag in d.CONTAINERS or n.parent is None)]
        assert best is None or best.total == max(n.total for n in fit)


@pytest.mark.parametrize(
    "make",
    [
        lambda n: "<b>" * n + "<li>x" * n,
        lambda n: "<span>" * n + "</i>" * n,
        lambda n: "<td>" + "<b>" * n + "</i>" * n,
        lambda n: "<div>" * n + "<p>x" * n,
        lambda n: '<a "' * n,
        lambda n: "<a '\"" * n,
        lambda n: "<dl>" + "<dt><b>x" * n,
        lambda n: "<!--" * n,
        lambda n: "<script>" * n,
        lambda n: "&amp" * n,
        lambda n: " " * 20 * n,
        lambda n: "\0" * 20 * n,
        lambda n: "<p class='" + "ad " * n + "'>x",
    ],
)
def test_time_grows_with_length(make):
    def took(n):
        start = time.perf_counter()
        main_text("<body>" + make(n))
        return time.perf_counter() - start

    took(100)
    assert took(40_000) < 12 * max(took(10_000), 0.02)
