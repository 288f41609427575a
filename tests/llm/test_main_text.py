import random
import time

import pytest

from asiento.llm import main_text as M

ARTICLE = "<h1>Title</h1><p>First   paragraph\nwith <b>bold</b> &amp; <a href=x>link</a>.<p>Second &eacute;&#33;<br>line"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><script>var t='</p>';</script></head><body><nav><ul><li><a>Home</a></ul></nav>"
        f"<div class=ad>Buy now, all of it</div><article>{ARTICLE}</article><footer>&copy; site</footer>",
        f"<body><header><p>The site of sites</p></header><!-- <p>no</p> --><main><article><header>{ARTICLE}</header></article></main>"
        "<section id='comments'><h2>Comments</h2><article class=comment><p>I disagree at some length here</p></article></section>",
        f"<div class='cookie-notice'><p>We use cookies</p></div><div id=content>{ARTICLE}</div>"
        "<aside><p>More to read</p></aside><form><label>Mail</label><input><button>Go</button></form>",
        f"<nav>never closed <div class=ad>ad never closed<article>{ARTICLE}</article></nav><footer>end",
        f"<article>{ARTICLE.replace('<p>Second', '<div class=advert><p>Ad</p></div><form><p>x</form><style>p</style><p>Second')}",
        f"<SCRIPT>if (a<b) '<article>'</SCRIPT><ARTICLE>{ARTICLE}</ARTICLE><div role='contentinfo'>imprint</div>",
    ],
)
def test_article_only(page):
    assert M.main_text(page) == "Title\nFirst paragraph with bold & link.\nSecond é! line"


def test_largest_stretch_wins_and_short_lines_stay():
    gap = "<nav>x</nav>" * 4
    page = f"<p>Teaser text</p>{gap}<p>No.</p><p>A much longer body than the teaser</p><p>Yes.</p>{gap}<p>Imprint</p>"
    assert M.main_text(page) == "No.\nA much longer body than the teaser\nYes."


LONG, OTHER = "A paragraph of the article with a good number of words.", "Another one, a little shorter."


@pytest.mark.parametrize(
    ("page", "lines"),
    [
        (f"<body><form id=aspnetForm><h1>Title</h1><p>{LONG}</p><input><p>{OTHER}</p></form>", ["Title", LONG, OTHER]),
        (f"<div id=text><p>{LONG}</p><ul class=related><li>a<li>b<li>c<li>d</ul><p>{OTHER}</p></div>", [LONG, OTHER]),
        (f"<article><p>{LONG}</p></article>{'<div class=ad><p>Buy</p></div>' * 4}<article><p>{OTHER}</p></article>", [LONG, OTHER]),
        (f'<p>x</p><nav>a</nav><nav>b</nav><nav>c</nav><article class="post ad-free"><p>{LONG}</p></article>', [LONG]),
        (f'<div class="sidebar-right"><p>{LONG}</p><p>{OTHER}</p></div>', [LONG, OTHER]),
        (f'<div><p>{LONG}</p><svg viewBox="0 0 1 1"/><p>{OTHER}</p></div>', [LONG, OTHER]),
        (f"<div><p><a href=x>{OTHER}</a></p><p>{LONG}</p></div>", [OTHER, LONG]),
        (f"<div><p>{OTHER}</p></div>{'<nav>x</nav>' * 4}<div><p>{OTHER[:-1]}!</p></div>", [OTHER]),  # as heavy: the first
        ("<form><label>Mail</label><input> Send us a line <button>Go</button></form>", []),
        ("<div class='cookie-notice'><p>We use cookies</p></div><nav>x</nav>", []),
        (f"<article><p>{LONG}</p></article><article class=comment><p>{OTHER}</p></article>", [LONG]),
    ],
)
def test_wrappers_and_gaps(page, lines):
    assert M.main_text(page).split("\n") == (lines or [""])


def slow_stretch(lengths, window):
    """All stretches that begin where text is, go on while a window holds text, and end where none does."""
    n, best = len(lengths), (0, 0)
    for i in range(n):
        if lengths[i] and not any(lengths[max(0, i - window) : i]):
            j = next((j for j in range(i, n) if not any(lengths[j : j + window])), n)
            best = max(best, (i, j), key=lambda s: (sum(lengths[s[0] : s[1]]), -s[0]))
    return best


def test_stretch_against_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        lengths = [rng.choice([0, 0, 0, 3, 8]) for _ in range(rng.randrange(25))]
        lines = [M.Line("x" * n, n, False, True, 0) for n in lengths]
        first, last = slow_stretch(lengths, 3)
        assert [line.text for line in M._stretch(lines, 3)] == ["x" * n for n in lengths[first:last] if n]


@pytest.mark.parametrize(
    ("page", "text"),
    [(None, ""), ("", ""), ("just text", "just text"), ("<p>", ""), ("<p>a <", "a <"), ("a<!-- open", "a"), ("<p title='>'>x", "x"),
     ("1 < 2 <p>b", "1 < 2\nb"), ("<p>x</p><script>never ended", "x"), ("<p>&am &amp &lt;i&gt;", "&am & <i>")],
)
def test_damaged(page, text):
    assert M.main_text(page) == text


@pytest.mark.parametrize("piece", ["<a ", "<p '", "<!--", "<script>", "<div class=\"x", "</p", "<p><b>x", "&", "<i></u>", "<span><p></p>", "<ul><li><i>"])
def test_time_is_linear(piece):
    def seconds(n):
        start = time.perf_counter()
        M.main_text(piece * n)
        return time.perf_counter() - start

    seconds(100)
    assert seconds(40_000) < 12 * max(seconds(10_000), 0.01)


def test_table(spark):
    rows = [(1, "u", f"<article>{ARTICLE}", "x", 5), (1, "u", f"<article>{ARTICLE}", "x", 5), (None, None, None, None, None)]
    rows.append((3, "v", "<article>" + "<p>many words here</p>" * 100_000, "x", 1))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    out = M.extract_main_text(pages)
    assert out.columns == [*pages.columns, "text_2"]
    got = {r.page_id: r.text_2 for r in out.collect()}
    assert got[None] == "" and got[1].startswith("Title\n") and got[3] == "\n".join(["many words here"] * 100_000)
    assert out.count() == 4 and M.extract_main_text(pages.limit(0)).collect() == []
