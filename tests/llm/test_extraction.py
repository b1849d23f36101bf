"""Main text of web pages."""

import html
import re

import pytest

from riskweave.llm import extraction, queries
from riskweave.llm.extraction import Page
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("source, text", [
    ("", ""),
    ("plain words only", "plain words only"),
    ("<article><h1>T &amp; U</h1><p>a <b>b</b>c\n d<br>e</p><p>f</p></article>", "T & U a bc d e f"),
    ("<nav>menu</nav><article><p>one<p>two</article><footer>f</footer>", "one two"),
    ("<body><header>h</header><div id=content><p>one</p></div><aside>s</aside>", "one"),
    ("<article>a<div class='ad box'>buy</div><form>f<input value='x>y'></form>b<script>if(a<b)\"</p>\"</script>c</article>", "a b c"),
    ("<article>a</article><section class=comments><p>nice</p></section>", "a"),
    ("<article>a<div class=\"cookie-notice\">c</div><div id='commentList'>r</div></article>", "a"),
    ("<article>cut off <b>here", "cut off here"),
    ("<article>text<p class=\"half", "text"),
    ("<article>1 < 2 &lt; 3 &#x41;&eacute;&nbsp;x</article>", "1 < 2 < 3 Aé x"),
    ("<!-- <article>no</article> --><main>yes</main><!-- open", "yes"),
    ("<style>p{}</style><title>t</title><p>x</p>", "x"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a b c d"),
    ("</div></p>a</article>", "a"),
])
def test_one_page(source, text):
    assert Page(source).main_text(set()) == text


def page(i, body):
    return (i, f"https://Site.example/x{i}", f"<body><div class=top>Welcome to Site</div><div class=wrap>{body}</div><p>All of Site</p></body>", "k")


def test_template_text_is_taken_away(spark):
    rows = [page(i, f"<p>story {i} tells</p><p>more {i * 7}</p>") for i in range(5)]
    rows += [(9, "https://other.example/", "<div>Welcome to Site</div><p>lone</p>", "k"), (10, None, None, "k"),
             (11, "no-host", "<p>x</p>", "k"), (12, "https://site.example/x", "", "k"), (None, "https://three.example/", "<p>same</p>", "k")]
    rows += [(i, "https://same.example/", "<p>equal copies</p>", "k") for i in (20, 21, 22, 22)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, template string")
    got = {(r.page_id, r.text) for r in extraction.main_texts(df.where("page_id <> 12 OR page_id IS NULL")).collect()}
    assert got == {(i, f"story {i} tells more {i * 7}") for i in range(5)} | {
        (9, "Welcome to Site lone"), (10, ""), (11, "x"), (None, "same")} | {(i, "equal copies") for i in (20, 21, 22)}
    assert extraction.main_texts(df).count() == len(rows)
    assert extraction.main_texts(df).columns == ["page_id", "url", "template", "text"]
    assert extraction.main_texts(df.limit(0)).count() == 0


def test_classes_share_occurrence_vectors(spark):
    rows = [(i, "https://h.example/", "<ul>" + "".join(f"<li>x{i}{j}</li>" for j in range(i + 1)) + f"</ul><p>t{i}</p>")
            for i in range(4)]
    t = extraction.templates(spark.createDataFrame(rows, "page_id int, url string, html string")).first()
    assert (t.n_pages, t.n_classes) == (4, 2)  # ul and p once on each page; li as often as each other
    assert len(t.root) == 4 and len(t.template) == 6


def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = queries.op3_extraction(spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id].html, re.S)[1]
        plain = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))
        assert r.text == " ".join(html.unescape(plain).split()) and r.n_chars == len(r.text)


def texts_of(spark, rows):
    df = spark.createDataFrame(rows, "page_id int, url string, html string")
    return {r.page_id: r.text for r in extraction.main_texts(df).collect()}


def test_slots_decide_on_every_page(spark):
    body = "long sentences of the body stand here, number {0}. " * 6
    rows = [(i, "https://h.example/", f"<div class=b><p>{body.format(i)}</p></div><article class=card>Teaser {i}</article>")
            for i in range(2)]
    rows += [(10 + i, "https://a.example/", f"<article><p>Read our terms</p><p>tale {i} of many words here</p><p>the end {i}, "
              "Read our terms</p></article><p>Made by A</p>") for i in range(4)]
    rows += [(20 + i, "https://c.example/", f"<article><p>one article in copies</p><p>no. {i}</p></article>") for i in range(4)]
    rows += [(30 + i, "https://o.example/", "<div>" + "".join(f"<p>{w}</p>" for w in ws) + f"</div><p>x{i}</p><p>End</p>")
             for i, ws in enumerate([("red", "blue"), ("blue", "red"), ("red", "blue"), ("blue", "red")])]
    got = texts_of(spark, rows)
    assert all(got[i] == body.format(i).strip() for i in range(2))
    # nothing of a marked article that has text of its own is taken away
    assert all(got[10 + i] == f"Read our terms tale {i} of many words here the end {i}, Read our terms" for i in range(4))
    assert all(got[20 + i] == f"one article in copies no. {i}" for i in range(4))
    # "red" and "blue" stand once on each page, but in no one order: only one of them can be template
    assert all(len({"red", "blue"} & set(got[30 + i].split())) == 1 and "End" not in got[30 + i] for i in range(4))


def test_empty_cut_and_error_pages_leave_the_template(spark):
    rows = [page(i, f"<p>story {i} tells</p><p>more {i * 7}</p>")[:3] for i in range(8)]
    url = rows[0][1]
    rows += [(20, url, ""), (21, url, None), (22, url, "<h1>404</h1><p>gone</p>"), (23, url, rows[0][2][:90]), (24, url, "   ")]
    got = texts_of(spark, rows)
    assert {i: got[i] for i in range(8)} == {i: f"story {i} tells more {i * 7}" for i in range(8)}
    assert (got[20], got[21], got[22], got[24]) == ("", "", "404 gone", "") and "Welcome" not in got[23]
    df = spark.createDataFrame(rows, "page_id int, url string, html string")
    assert extraction.templates(df).first().n_pages == 10


@pytest.mark.parametrize("source, text", [
    ('<div class="content-sidebar-wrap"><main><p>body</p></main><div class=sidebar>s</div></div>', "body"),
    ('<body class="x"><div class="page has-sidebar with-banner"><div><article>body<div class=ad>buy</div></article></div></div>', "body"),
    ('<div id="search-page"><p>found</p><div role="main">body</div></div>', "body"),
    ('<div class="no-sidebar"><p>the body of the page</p></div>', "the body of the page"),
    ('<article>a tale</article><section class=comments><article class=comment>nice</article></section>', "a tale"),
    ('<article>a tale of ten</article><div class=related><article>other</article></div>', "a tale of ten"),
    ('<nav class="has-sidebar">menu</nav><div class="with-banner">text</div>', "text"),
    ('<nav><main>menu</main></nav>', ""),
])
def test_names_do_not_take_the_body(source, text):
    assert Page(source).main_text(set()) == text


def test_deep_markup():
    assert Page("<div>" * 5000 + "deep").main_text() == "deep"


def test_a_heading_of_every_article_stays(spark):
    rows = [(i, "https://r.example/", f"<nav>menu</nav><article><p>tale {i} of many words</p><h2>References</h2><p>book {i}</p></article>"
             "<article><p>Join our club today</p></article><p>Made by R</p>") for i in range(5)]
    got = texts_of(spark, rows)
    assert got == {i: f"tale {i} of many words References book {i}" for i in range(5)}  # the card that all pages share goes


OLD_EVENT = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)


def test_tag_ends_equal_a_pattern():
    import random
    rng = random.Random(6)
    for _ in range(4000):
        source = "".join(rng.choice(["<a ", "<b ", "</a ", ">", "'", '"', "<!", "<!--", "-->", "x", " y=", "<", "/", "<?"]) for _ in range(rng.randrange(14)))
        ends, at, want, got = extraction._TagEnds(source), 0, [], []
        for m in iter(lambda: OLD_EVENT.search(source, at), None):
            at = m.end()
            if m[2] is not None:
                want.append((m.start(), m.end()))
        page = type("Probe", (Page,), {"_start": lambda s, t, a: got.append(a), "_close": lambda s, t: got.append(t), "_text": lambda s, t: None})
        page(source)
        assert len(got) == len(want), source
        assert all(ends.after(extraction.NAME.match(source, a + 1 + (source[a + 1] == "/")).end()) == b for a, b in want), source


@pytest.mark.parametrize("source", [
    "<a " * 350_000, "<div>" * 100_000 + "</x>" * 100_000, "<a '" * 250_000, "<a \"'" * 200_000 + ">", "<!" * 500_000, "</script" * 120_000,
    "<div>" * 60_000 + "<article></article>" * 40_000, "<a " + "x" * 1_000_000 + " y=1>t", "&#" + "9" * 1_000_000 + ";", "<li>" * 250_000,
    "<div class=nav>" * 60_000 + "<article>t" * 10_000, "<script>" * 120_000,
], ids=range(12))
def test_a_megabyte_of_hostile_markup_is_read_in_seconds(source):
    import time
    began = time.process_time()
    Page(source).main_text()
    assert time.process_time() - began < 8


def plain_read(page):
    def chain(e):
        return e and (e.tag, e.path, e.link, e.barred, e.names(), e.article and e.article.path, e.box.path)

    return page.order, [(r.block, r.at, r.token, r.text, r.size, chain(r.element)) for r in page.runs], page.main_text()


def test_plain_tags_are_read_as_all_others(monkeypatch):
    """Reading tag by tag, and keeping what equal tags say, changes nothing."""
    import random
    rng = random.Random(8)
    parts = ["<a ", "<p>", "<P CLASS=ad>", "</a ", "</p>", ">", "'", '"', "<!--", "-->", "x", " y=", "<", "</", "<div class=\"ad box\">",
             "<div id=sidebar ROLE='main'>", "<article>", "</article>", "<article class='comment'>", "</div>", "<script>", "</SCRIPT x>",
             "<li>", "<td>", "<br/>", "<img src=a>b'>", "<a href='/id<' Class=ad>", "<a href=/1>", "&amp;", "text words", "<t'r>", "<h1 class =ad>"]
    sources = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    got = [plain_read(Page(s)) for s in sources]
    monkeypatch.setattr(extraction, "PLAIN_TAG", re.compile(r"(?!)"))
    monkeypatch.setattr(extraction, "_kind", extraction.Kind)
    assert got == [plain_read(Page(s)) for s in sources]


def test_ordinary_markup_is_read_without_a_scan_of_its_signs(monkeypatch):
    class Pattern:
        calls = 0

        def finditer(self, attributes):
            Pattern.calls += 1
            return ATTRIBUTE.finditer(attributes)

    def scan(*_):
        raise AssertionError("signs scanned")

    ATTRIBUTE = extraction.ATTRIBUTE
    monkeypatch.setattr(extraction, "ATTRIBUTE", Pattern())
    monkeypatch.setattr(extraction, "_TagEnds", scan)
    source = "".join(f"<li class='once-read'><a href=\"/{i}\">t{i}</a></li>" for i in range(500))
    assert Page(f"<ul>{source}</ul>").main_text() == " ".join(f"t{i}" for i in range(500))
    assert Pattern.calls <= 1  # attributes that are equal or tell nothing are not taken apart again


@pytest.mark.parametrize("source", [
    "<a <a' " * 150_000 + ">", "<a x='" * 160_000 + "\">", "<a '\"" * 200_000 + ">", "<" * 1_000_000 + ">", "<a x=\"'\" " * 100_000 + ">",
    "".join(f"<a class=c{i}>" for i in range(70_000)), "<" + "a" * 1_000_000 + " class=x>t",
], ids=range(7))
def test_a_megabyte_of_broken_tags_is_read_in_seconds(source):
    import time
    began = time.process_time()
    Page(source).main_text()
    assert time.process_time() - began < 8
    assert extraction._kept_kind.cache_info().currsize <= extraction.KINDS
