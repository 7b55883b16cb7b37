import html
import re

from filelake.llm import html_extract

PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style><script>if (a<b) "</p>"</script></head><body>
<header><h1>Site</h1><a href=/>Home</a></header><nav><ul><li><a href="/a">A</a></ul></nav>
<div id="sidebar"><p>Side text, long enough to count as text. Yes.</p></div><!-- <p>no</p> -->
<div class="content"><h1>Title &amp; more</h1><p>First para, with <b>bold</b> and
 <a href=x title="a>b">link</a>. It is long enough. And more, and more.<p>Second<br>para &lt;ok&gt;&nbsp;&eacute;. Longer text here, as always, for the score.</p>
<ul><li>Item one, as text.<li>Item two</ul><blockquote>Quoted, too.</blockquote><form>Search <input></form><div class="share-buttons">Share this</div></div>
<section class="comments"><p>Nice article, very good. I like it a lot, really, and more words.</p></section>
<div class=cookie-notice>We use cookies, as all do. Is this fine?</div><footer>Foot &copy;</footer></body></html>"""


def test_article_without_the_rest():
    assert html_extract.main_text(PAGE) == (
        "Title & more\nFirst para, with bold and link. It is long enough. And more, and more.\n"
        "Second para <ok> é. Longer text here, as always, for the score.\nItem one, as text.\nItem two\nQuoted, too."
    )


def test_odd_pages():
    assert html_extract.main_text(None) == html_extract.main_text("") == html_extract.main_text("<p>") == ""
    assert html_extract.main_text("<script>x") == html_extract.main_text("<!-- x") == html_extract.main_text("<nav>x</nav>") == ""
    assert html_extract.main_text("plain  text < 3 and <b>x</b>") == "plain text < 3 and x"
    assert html_extract.main_text("<p>One.</p><p>Two") == "One.\nTwo"
    assert html_extract.main_text("<article><p>Cut off. <a hre") == "Cut off."
    assert html_extract.main_text('<p title="unclosed>A, b.</p>') == html_extract.main_text("<p title='x>A, b.</p>")
    long_page = "<div>" * 3000 + "text, and more. " * 20_000 + "<" * 50_000
    assert html_extract.main_text(long_page).startswith("text, and more.")


def expected(page):
    """The article of the given pages, by their one known form."""
    body = page[page.find("<article>") + 9 :].split("</article>")[0].split("<footer")[0]
    parts = [re.sub(r"<[^>]*(>|$)", "", re.sub(r"<br>", " ", p)) for p in re.split(r"</?(?:p|h1)>", body)]
    texts = [" ".join(html.unescape(p).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_query_on_all_pages(spark):
    from filelake.llm import queries

    sf = "/root/testdata/sf0.1"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op2_html_extract(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == expected(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_rows_and_columns(spark):
    df = spark.createDataFrame([(1, PAGE, "old"), (1, PAGE, "old"), (2, None, "old")], "page_id long, html string, text string")
    rows = html_extract.extract(df).orderBy("page_id").collect()
    assert [len(r["text"]) == r["n_chars"] for r in rows] == [True] * 3 and rows[2]["text"] == "" and rows[0] == rows[1]
    assert html_extract.extract(df.limit(0)).count() == 0


def test_deep_pages_take_linear_time():
    import time

    for tag in ("div", "blockquote", "li", "ul><li", "section"):
        start = time.time()
        text = html_extract.main_text(f"<{tag}>x" * 50_000)
        # The innermost element with four fifths of the text is the article.
        assert text.count("x") >= 40_000
        assert time.time() - start < 20
    start = time.time()
    text = html_extract.main_text("<article>" + "<div><p>Some text, with marks.</p>" * 30_000 + "</div>" * 30_000 + "</article>")
    assert text.split("\n") == ["Some text, with marks."] * 30_000 and time.time() - start < 20


def test_elements_know_what_is_inside_them():
    found, elements = html_extract.blocks("<div><p>a</p><section><p>b</p></section></div><p>c</p>")
    assert elements.tag == ["", "div", "p", "section", "p", "p"] and elements.parent == [0, 0, 1, 1, 3, 0]
    assert elements.last() == [5, 4, 2, 4, 4, 5] and elements.weights(found) == [3, 2, 1, 1, 1, 1]


# Nothing in its names or elements tells what the article is.
PLAIN = """<html><body><div><table><tr><td><a href=/>Home</a><td><a href=/n>News</a><td>Mon 3</table></div>
<div><div><h1>The bridge</h1><p>The old bridge, built in 1820, was closed on Monday; nobody knows why, or until when.</p>
<p>Those who live nearby, as we do, now walk for an hour. It is, they say, a nuisance.</p>
<p><a href=/map>A map of the way round, with all its stops.</a></p></div>
<ul><li><a href=/1>Rain in May</a><li><a href=/2>A new mayor</a><li>Weather 12 C</ul></div>
<dl><dt>Tel</dt><dd>12 34</dd><dt>Fax</dt><dd>56 78</dd></dl></body></html>"""
PLAIN_TEXT = (
    "The bridge\nThe old bridge, built in 1820, was closed on Monday; nobody knows why, or until when.\n"
    "Those who live nearby, as we do, now walk for an hour. It is, they say, a nuisance.\nA map of the way round, with all its stops."
)


def test_ratios_find_the_article_where_names_tell_nothing(monkeypatch):
    assert html_extract.main_text(PLAIN) == PLAIN_TEXT
    with monkeypatch.context() as m:
        # With equal scores the list beside it belongs to it.
        m.setattr(html_extract, "path_scores", lambda candidates: {b.path: 1.0 for b in candidates})
        assert html_extract.main_text(PLAIN) == PLAIN_TEXT + "\nRain in May\nA new mayor\nWeather 12 C"


def part(name):
    para = "<p>The first study, by far the best known, was done in 1990; others, less so, came later. All agree.</p>"
    inner = f"<h2>Head</h2>{para}" if name in ("related-work", "share_price") else "<h2>Head</h2><p>More</p><p>Two</p>"
    return f'<article><h1>T</h1>{para * 3}<div class="{name}">{inner}</div></article>'


def test_ratios_decide_on_twofold_names(monkeypatch):
    for name in ("related-work", "share_price"):
        assert html_extract.main_text(part(name)).count("\n") == 5
    for name in ("share-facts", "related", "related-posts", "share buttons", "social-2", "comment-price", "search"):
        assert html_extract.main_text(part(name)).count("\n") == 3
    monkeypatch.setattr(html_extract, "path_scores", lambda candidates: {b.path: 1.0 for b in candidates})
    assert html_extract.main_text(part("share-facts")).endswith("Head\nMore\nTwo")


def test_links_of_a_stated_article_stay():
    page = "<article><p>Read, if you like, these.</p><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></article>"
    assert html_extract.main_text(page) == "Read, if you like, these.\nOne\nTwo"


def test_classes_tell_paths_apart():
    page = "<div class=a7>{}</div><div class=a8>{}</div><div class=b>{}</div>".format(
        "<p>Long text of this page, with marks. And more, and more.</p>" * 3, "<p>Long text of this page, with marks.</p>" * 3, "<p>x</p>" * 9
    )
    found, _ = html_extract.blocks(page)
    assert len({b.path for b in found}) == 2
    scores = html_extract.path_scores(found)
    assert scores[found[0].path] > scores[found[-1].path]
