import html as references
import json
import re
import time

from tidewatch.llm import html
from tidewatch.llm.shared import table

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header>Site</header><nav><ul>{menu}</ul></nav>'
    '<div class="ad">Buy</div><div id="cookie-notice">We use</div><article><h1>A &amp; B</h1>{body}<form><label>mail</label></form></article>'
    '<aside>More</aside><div class="comments"><p>First!</p></div><footer>&copy; x</footer></body></html>'
)


def page(*paragraphs, menu=2):
    return PAGE.replace("{menu}", "<li><a href=/>m</a></li>" * menu).replace("{body}", "".join(paragraphs))


def test_pages_against_plain_reading(spark):
    """Between article tags of the given pages nothing stands aside: cut the markup out directly."""
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r for r in html.extracted(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(references.unescape(re.sub(r"</?b>|<br>", lambda m: " " if m[0] == "<br>" else "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id].text == "\n".join(b for b in blocks if b) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_rules_and_blocks():
    text = html.main_text(page("<p>one\n  <b>two</b>&nbsp;x</p>", "<p>three<br>four<p>five", "<ul><li>a</li><li>b <ul><li>c</li></ul></li></ul>", "<p>&lt;tag&gt; &eacute;</p>"))
    assert text == "A & B\none two x\nthree four\nfive\na\nb\nc\n<tag> é"
    assert html.main_text("") == "" and html.main_text("plain <b>text") == "plain text" and html.main_text("<p>a < b <!-- x --> c <script>no") == "a < b c"


def test_wrapper_generalises():
    shown = [page("<p>x</p>", menu=2), page("<p>x</p><p>y</p>", menu=5), page("<p>x</p><blockquote>q</blockquote>", menu=3)]
    said = html.aligned_all(map(html.expression, shown))
    wrapper = html.Wrapper(said)
    fits = lambda p: wrapper.fits(html.Reading(p))
    assert all(map(fits, shown))
    assert fits(page("<p>n</p>" * 7, "<blockquote>z</blockquote>", menu=9)) and not fits("<p>other</p>")
    kinds = {x[0] for x in json.loads(said) if isinstance(x, list)}
    assert kinds == {"+", "?"}
    assert html.main_text(shown[2], wrapper) == html.main_text(shown[2]) == "A & B\nx\nq"


SCHEMA = "page_id long, url string, html string"


def texts_of(spark, pages):
    rows = [(k, "https://one.example/", p) for k, p in enumerate(pages)]
    return {r.page_id: r.text for r in html.extracted(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_what_pages_share_is_no_main_text(spark):
    """A notice that no name tells apart is known by its being the same on all pages; without the wrapper it stays."""
    pages = [f"<html><body><article><h1>same title</h1><div>Read our terms.</div><p>story {k}</p><p>the same line</p></article></body></html>" for k in range(4)]
    assert texts_of(spark, pages) == {k: f"same title\nstory {k}\nthe same line" for k in range(4)}
    assert html.main_text(pages[0]) == "same title\nRead our terms.\nstory 0\nthe same line"
    # Copies of one page, and hosts with too few pages, tell nothing.
    assert set(texts_of(spark, pages[:1] * 9).values()) == {html.main_text(pages[0])}
    assert texts_of(spark, pages[:2]) == {k: html.main_text(pages[k]) for k in (0, 1)}


def test_names_that_only_look_aside():
    text = '<article><h1>t</h1><div class="social impact">one</div><section class="share-price">two</section><div class="share bar">out</div><div class="ad top-story">out</div></article>'
    assert html.main_text(text) == "t\none\ntwo"


def test_long_broken_and_deep_pages():
    started = time.process_time()
    for broken in ("<a " * 350_000, "<div>x" * 170_000, "<!" * 500_000, "<p \"" * 250_000, "</b>" + "<i>y</b>" * 120_000):
        html.expression(broken)
        html.main_text(broken)
    assert time.process_time() - started < 120


def test_edge_cases(spark):
    schema = "page_id long, url string, html string, host string, text string"
    rows = [(1, None, None, "h", "t"), (1, "https://a.b/x", "", "h", "t"), (None, "nonsense", "<p>x", "h", "t"), (2, "https://a.b/y", page("<p>" + "w " * 100_000), "h", "t")]
    rows += [(3, "https://a.b/y", "<div " * 2000 + "<<<>", None, None), (4, "HTTPS://A.B?q", '<p class="x>y', None, None)] * 2
    got = html.extracted(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert {r.text for r in got if r.page_id in (1, None)} == {"", "x"}
    assert html.extracted(spark.createDataFrame([], schema)).collect() == []


def test_host_with_and_without_article(spark):
    """One host, two templates that both fit its wrapper: whether a page has an article is told by the page."""
    whole = [f"<html><body><article><p>story {k}</p></article></body></html>" for k in range(3)]
    plain = [f"<html><body><div><p>plain {k}</p></div></body></html>" for k in range(3)]
    said = html.Wrapper(html.aligned_all(map(html.expression, whole + plain)))
    assert said.fits(html.Reading(whole[0])) and said.fits(html.Reading(plain[0]))
    rows = [(k, "https://two.example/", p) for k, p in enumerate(whole + plain)]
    got = {r.page_id: r.text for r in html.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: "story 0", 1: "story 1", 2: "story 2", 3: "plain 0", 4: "plain 1", 5: "plain 2"}
