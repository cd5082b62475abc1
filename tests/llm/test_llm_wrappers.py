"""Wrapper inference: expressions that match the pages they come from, and the texts taken by them."""

import html
import random
import re
import time

import pytest

import __spark_entry__ as entry
from inciscope.llm import wrappers as W

SCHEMA = "page_id long, url string, html string"


def stream(node):
    """A page as the tags and texts that an expression matches."""
    out = []
    for child in node.children:
        if isinstance(child, W.Node):
            out.append(f"<{child.key}>{stream(child)}</{child.key}>")
        elif child[0] and not child[0].isspace() and (not out or out[-1] != "#"):
            out.append("#")
    return "".join(out)


def learnt(pages):
    total = W.Wrapper()
    for page in pages:
        total.merge(W.infer(W.parse(page)))
    return total


def page_text(page, others=()):
    """Text of one page by the wrapper of it and others."""
    kind = W.kind_of(W.parse(page))
    found = learnt([p for p in (page, *others) if W.kind_of(W.parse(p)) == kind])
    return W.main_text(W.parse(page), frozenset(W.content_slots(found, kind)))


def test_expression_of_aligned_streams():
    a = "<div><h1>t</h1><p>x</p><p>y</p></div>"
    b = "<div><h1>t</h1><p>x</p><table></table><p>z</p><em>more</em></div>"
    c = "<div><p>x</p><ul><li>1</li><li>2</li></ul></div>"
    assert learnt([a]).expression() == "<div><h1>#</h1>(?:<p>#</p>)+</div>"
    assert learnt([a, c]).expression() == "<div>(?:<h1>#</h1>)?(?:<p>#</p>)+(?:<ul>(?:<li>#</li>)+</ul>)?</div>"
    assert "(?:(?:<p>#</p>)*(?:<table></table>)?)+" in learnt([a, b]).expression()


def random_page(rng, depth=0):
    out = []
    for _ in range(rng.randint(0, 4)):
        tag = rng.choice(["p", "div", "section", "h2", "b", "a", "ul"])
        inner = random_page(rng, depth + 1) if depth < 3 and tag in ("div", "section") else rng.choice(["", "some text", " "])
        inner = "<li>1</li><li></li>" if tag == "ul" else inner
        out.append(f"<{tag}>{inner}</{tag}>" + rng.choice(["", "", "tail"]))
    return "".join(out)


@pytest.mark.parametrize("seed", range(5))
def test_expression_matches_every_page(seed):
    rng = random.Random(seed)
    pages = [random_page(rng) for _ in range(12)]
    expression = re.compile(learnt(pages).expression())
    assert all(expression.fullmatch(stream(W.parse(p))) for p in pages)


def test_alignment_is_associative():
    rng = random.Random(11)
    pages = [random_page(rng) for _ in range(30)]
    whole = learnt(pages)
    for _ in range(5):
        cut = rng.randint(1, 29)
        left, right = learnt(pages[:cut]), learnt(pages[cut:])
        left.merge(W.Wrapper.unpacked(right.packed()))

        def sets(w):
            return w.n, w.chars, w.same, sorted(map(sorted, w.groups)), w.within, {k: sets(c) for k, c in w.children.items()}

        assert sets(left) == sets(whole)


def test_article_without_its_surroundings():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
    <div class="cookie-notice"><p>We use cookies</p></div>
    <div id="wrap" class="with-sidebar"><article class="post post-123"><header><h1>Title &amp; more</h1></header>
    <p>First <b>bold</b>, <a href="x">link</a> and\n  tail&nbsp;end.</p><div class="ad-slot">Buy</div>
    <script>var x = "</p><p>no</p>";</script><!-- <p>no</p> -->
    <ul><li>one<li>two</ul><blockquote>said</blockquote><form><label>Name</label><input></form>
    <table><tr><td>a<td>b<tr><td>c</table>
    <p>Last<br>line &#x41;&lt;b&gt;<p>open <aside>x</aside><footer>by me</footer>
    <section class="comments"><p>Reader says</p></section></article>
    <div class="sidebar">side</div></div><section id="comments"><article class="comment">No</article></section>
    <footer>&copy; us</footer></body></html>"""
    want = "Title & more\nFirst bold, link and tail end.\none\ntwo\nsaid\na\nb\nc\nLast line A<b>\nopen"
    assert page_text(page) == want
    assert page_text(page, [page.replace("First", "Other")]) == want


def test_pages_without_article_element():
    def page(k):
        links = "".join(f"<li><a href='/{i}'>Section {i}</a></li>" for i in range(9))
        return (
            f"<html><body><div class='top'><a href='/'>Logo of the site</a></div><div class='links'><ul>{links}</ul></div>"
            f"<div class='main-col'><h1>Story {k}</h1><p>{'word ' * (30 + k)}</p><p>End of {k}</p><p class='again'>Always the same</p></div>"
            f"<div class='bottom'>All rights kept</div></body></html>"
        )

    pages = [page(k) for k in range(6)]
    assert page_text(pages[2], pages) == f"Story 2\n{('word ' * 32).strip()}\nEnd of 2"
    main = "<body><div class=menu>m</div><main><p>Only this</p></main><div>other</div></body>"
    assert page_text(main, pages) == "Only this"


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""), ("", ""), ("plain text", "plain text"), ("a < b and <3 c", "a < b and <3 c"), ("<article>cut <p>he", "cut\nhe"),
        ("<article><p>x</p", "x"), ("<article><a title='>'>y</a>", "y"), ('<article><p class="un>z</p>', "z"),
        ("<article>&amp &notit; &am &#65 &bogus;</article>", "& ¬it; &am A &bogus;"), ("<article></article>", ""),
        ("<article><p>İ<script>var a='İ';</SCRIPT>b</article>", "İb"), ("<ARTICLE><P>up</P></ARTICLE>", "up"), ("<!-- open", ""),
        ("<article><b>bold<div>in</b> block</div>tail</article>", "bold\nin block\ntail"), ("<article>a</>b<!x>c<?y>d</article>", "abcd"),
    ],
)
def test_broken_pages(page, want):
    assert page_text(page) == want


@pytest.mark.parametrize(
    "unit", ["<div>", "<b>", "<p><i>", "<ul>", "</section>", "<i><div><b></i>", '<a "', "<a '\">", "<", "<!--", "<script>", "<div class='a b'>x", "&amp;", "<li>", "<td>"]
)
def test_long_broken_pages_take_linear_time(unit):
    start = time.time()
    page = "<article>" + unit * 40_000 + "end"
    page_text(page)
    assert time.time() - start < 8


def test_deep_text_is_kept():
    assert page_text("<article>" + "<div>" * 1000 + "deep" + "</div>" * 1000 + "<p>after</p></article>").split("\n") == ["deep", "after"]


def test_on_spark(spark, rows):
    body = "<nav><a>m</a></nav><article><h1>T{0}</h1><p>x{0}</p></article>"
    pages = [(k, f"http://{'Big' if k % 3 else 'host' + str(k)}.org/p", body.format(k)) for k in range(40)]
    pages += [(50, None, body.format(50)), (51, "nowhere", None), (None, "http://big.org", body.format(9)), (52, "http://big.org?x", "")]
    pages += [pages[0]] * 2
    frame = spark.createDataFrame(pages, SCHEMA).repartition(7)
    found = rows(W.extract(frame))
    want = [(k, u, *((f"T{k}\nx{k}", 2 * len(str(k)) + 3) if k is not None else ("T9\nx9", 5))) for k, u, h in pages if h]
    want += [(k, u, "", 0) for k, u, h in pages if not h]
    assert found == sorted(want, key=lambda t: tuple((v is not None, str(v)) for v in t))
    hosts = rows(W.wrappers(frame).select("host", "kind"))
    assert ("big.org", "article") in hosts and ("", "article") in hosts and len(hosts) == len(set(hosts))
    assert W.extract(frame.limit(0)).collect() == []
    extra = frame.selectExpr("*", "1 AS host", "'z' AS slots", "2 AS text", "3 AS kind")
    assert rows(W.extract(extra)) == found


def test_given_pages(spark):
    """Every given page has one article of headings and paragraphs: its text by plain splitting."""
    pages = spark.read.parquet(f"{entry.SMOKE_DIR}/pages.parquet").collect()
    found = {r.page_id: r for r in entry.queries()["op13_wrapper_inference"](spark, entry.SMOKE_DIR).collect()}
    assert len(found) == len(pages)
    for page in pages:
        article = re.search(r"<article>(.*)</article>", page.html, re.S).group(1)
        blocks = [html.unescape(re.sub("<[^>]*>", "", b)).split() for b in re.split(r"</?p>|</?h1>", article)]
        want = "\n".join(" ".join(b) for b in blocks if b)
        assert found[page.page_id].text == want and found[page.page_id].n_chars == len(want)
