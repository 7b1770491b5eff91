"""Main text of pages: the given pages against their markup, other layouts, odd input."""

import html
import random
import re
import time

import pytest

from tessera.llm.op12_path_ratios import extract_pages, main_text

SF = "/root/testdata/sf0.001"


def article(page):
    """Plain reading of the generated pages: what stands between the article tags."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = {r.page_id: r for r in pages.collect()}
    got = extract_pages(pages).collect()
    assert sorted(r.page_id for r in got) == sorted(rows)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (rows[r.page_id].url, article(rows[r.page_id].html), len(article(rows[r.page_id].html)))


FURNITURE = [
    '<header class="site"><h1>My Site</h1><a href="/">home</a></header>', '<nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>',
    '<div class="cookie-notice">We use cookies, as all do. Accept?</div>', '<aside><p>Sidebar text, of some length, here.</p></aside>',
    '<div id="sidebar"><p>More of the side, with commas, too.</p></div>', '<form>Sign up <input name=a> <button>Go</button></form>',
    '<script>var t = "<p>no</p>"; if (a < b) c()</script>', "<style>p { margin: 0 }</style>", "<!-- a <p>comment</p> -->",
    '<div class="ad">Buy this, buy that, buy all!</div>', '<section id="comments"><h2>Comments</h2><p>A long reader comment, well written.</p></section>',
    '<footer>&copy; somebody, some year.</footer>', '<div hidden>Not shown, never.</div>', '<ul class="social-share"><li>Share</ul>',
    '<div role="alert">Notice, notice.</div>', "<noscript>Turn scripts on.</noscript>", '<ul><li><a href="x">Related story</a></ul>']


@pytest.mark.parametrize("seed", range(10))
def test_blocks_come_out_whole(seed):
    """Random articles between random furniture: every block and nothing else, in order."""
    rng = random.Random(seed)
    words = ["alpha", "b&b", "café", "x < y", "end.", "no,", "日本", '"quoted"', "q?"]
    out, want = [], []
    for k in range(rng.randint(1, 12)):
        text = " ".join(rng.choice(words) for _ in range(rng.choice((1, 5, 40))))
        want.append(text)
        raw = html.escape(text).replace(" ", rng.choice((" ", "\n\t", "&nbsp;", " <br> ")))
        raw = rng.choice(("{}", "<b>{}</b>", "<em>{}", "<span class=x>{}</span>", "{}<!-- c -->")).format(raw)
        out.append(rng.choice(("<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<div><p>{}</p></div>", "<blockquote>{}</blockquote>",
                               "<ul><li>{}</ul>", "<table><tr><td>{}</td></tr></table>", "<DIV>{}</DIV>", "<pre>{}</pre>")).format(raw))
        if rng.random() < 0.4:
            out.append(rng.choice(FURNITURE[1:]))  # a header inside the article is the headline and stays
    around = [rng.choice(FURNITURE) for _ in range(8)]
    tag = rng.choice(("article", "main", "div role=article"))
    page = "".join([*around[:5], f"<{tag}>", *out, f"</{tag.split()[0]}>", *around[5:]])
    assert main_text(f"<html><body class='has-sidebar'>{page}") == "\n".join(want)


def test_pages_without_a_marked_article():
    page = """<div id=top><a href=1>Home</a> <a href=2>News</a> | <a href=3>About</a></div><table><tr><td><a href=x>x</a><br>
    <a href=y>y</a></td><td><div><h2>Head line</h2><div class=text>This is the long story of it, told well. It goes on, and on.</div>
    <div class=text>Another sentence follows, with commas, here.</div></div></td></tr></table><div class="footer">Imprint, of all.</div>"""
    assert main_text(page) == ("Head line\nThis is the long story of it, told well. It goes on, and on.\n"
                               "Another sentence follows, with commas, here.")


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<article></article><div class=ad>Buy, buy, buy!</div>", ""), ("<article><p>Hi</article><div class=ad>Buy, buy!</div>", "Hi"),
    ("just text", "just text"), ("&am", "&am"), ("a < b &amp b &#x41;&#0;", "a < b & b A�"), ("<p", ""), ("<!-- x", ""), ("<p title='x>y", "y"),
    ("<article><p>one <a href=\"a>b\">two</a> three</article>", "one two three"), ("</p></div>x", "x"),
    ("<article>un<b>bro</b>ken <span class=ad>Buy!</span>line</article>", "unbroken line")])
def test_odd_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page", ['<a "' * 100_000, "<b>" * 50_000 + "x", "<div>" * 20_000 + "x", "<p><b>" * 20_000 + "</i>" * 20_000,
                                  '<a b="' * 60_000, "<a b='\"" * 50_000, "<script>" * 50_000, "<article>" + "long text, " * 100_000])
def test_long_pages_take_linear_time(page):
    began = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - began < 10


def test_rows(spark):
    rows = [(1, "u", "<article>a</article>", 5), (1, "u", "<article>a</article>", 6), (None, None, None, 7), (2, "v", "", 8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    assert sorted(map(tuple, extract_pages(df).collect()), key=repr) == sorted(
        [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0), (2, "v", "", 0)], key=repr)
    assert extract_pages(df.limit(0)).count() == 0
