import re
from html import unescape

import pytest

from gridweave.llm import dom
from gridweave.llm import html_extraction as H

CASES = [
    ("<article><h1>T</h1><p>One  two<b>three</b>\n four.<br>five &amp; &lt;six&gt;</article>", "T One twothree four. five & <six>"),
    ('<nav><a href="/">Home</a></nav><article><p>Body text here.</p><div class="ad">Buy now</div><p>More.</p></article><footer>&copy; 2024</footer>', "Body text here. More."),
    ('<header><h1>Site</h1></header><main><p>Main body of the story goes on.</p></main><aside class="sidebar"><p>Related</p></aside>', "Main body of the story goes on."),
    ('<div id="content" class="post"><p>Kept text, a sentence.</p><form class="newsletter"><p>Subscribe</p><input></form></div><div class="comments"><p>First!</p></div>', "Kept text, a sentence."),
    ('<div class="cookie-notice">We use cookies</div><article><p>Story.</p></article><script>var a="</p>";</script><style>p{}</style>', "Story."),
    ("", ""),
    ("<article><p>cut off &am", "cut off &am"),
    ("<article><p>open <b>never closed", "open never closed"),
    ('<article><p>a < b and c > d</p><p title="x>y">q</p></article>', "a < b and c > d q"),
]


@pytest.mark.parametrize(("html", "want"), CASES)
def test_cases(html, want):
    page = html if not html or html.startswith("<article><p>cut") else f"<!DOCTYPE html><html><head><title>no</title></head><body>{html}</body></html>" if html.endswith(">") else f"<html><body>{html}"
    assert H.extract([page], H.train()) == [want]


def test_pages_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    out = H.op1_query(pages).collect()
    assert len(out) == len(html)
    for r in out:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", html[r.page_id], re.S)
        body = re.sub(r"<[^>]*(?:>|\Z)", "\n", re.sub(r"</?b>", "", article[1]))
        assert r.text == " ".join(unescape(body).split()) and r.n_chars == len(r.text)


def test_awkward(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>x</p></article>"), (4, "u", "<p>" * 3000 + "deep"), (5, "u", "<" * 5000), (6, "u", "<a href='" + "y" * 5000), (1, "u", None), (7, "u", "<div>" * 20 + "<p>Some text, as it is.</p>"), (8, "u", "<div>" * 2000 + "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' AS text", "1 AS n_chars")
    out = {r.page_id: r.text for r in H.op1_query(df).collect()}
    assert len(out) == 8 and out[1] == "" and out[None] == "x" and out[7] == "Some text, as it is."
    assert H.op1_query(df.limit(0)).count() == 0


@pytest.mark.parametrize(("mode", "floor"), [("english", 0.85), ("hashed", 0.72), ("foreign", 0.72), ("none", 0.72)])
def test_held_out_pages(mode, floor):
    """Pages of other seeds; but for the English ones their names are drawn anew, so they share no token with training."""
    model, right, total, exact = H.train(), 0, 0, 0
    for page, want in (H.labelled(p) for p in H.training_pages(150, 977, (mode,))):
        got = H.decode(page.parent, model.margins(H.features(page)).tolist())
        right += sum(g == bool(w) for g, w in zip(got, want))
        total += len(want)
        exact += H.kept_text(page, got) == H.kept_text(page, [bool(w) for w in want])
    assert right / total > 0.985 and exact / 150 > floor


STORY = "This is a long enough paragraph of the story, with sentences. It goes on for a while, and then it ends."
KEPT = f"Title here {STORY} {STORY}"
ARTICLE = f"<h1>Title here</h1><p>{STORY}</p><p>{STORY}</p>"
LAYOUTS = {
    "hashed names": f'<div class="css-q1w2"><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/c">Contact</a></li></ul></div><div class="css-zz91">{ARTICLE}</div><div class="css-pp3"><div class="css-k1"><b>Jane says:</b><p>I disagree with this.</p></div><div class="css-k1"><b>Joe says:</b><p>So do I, as ever.</p></div></div><div class="css-f">Copyright 2024 Some Firm</div>',
    "German names": f'<div class="hauptmenue"><ul><li><a href="/">Start</a></li><li><a href="/n">Nachrichten</a></li></ul></div><div class="inhalt">{ARTICLE}</div><div class="kommentare"><div class="kommentar"><b>Hans</b><p>Das sehe ich anders.</p></div><div class="kommentar"><b>Eva</b><p>Ich nicht.</p></div></div><div class="fusszeile"><a href="/i">Impressum</a> &copy; 2024 Verlag</div>',
    "a table": f'<table><tr><td><a href="/">Home</a><br><a href="/n">News</a><br><a href="/c">Contact</a></td><td>{ARTICLE}</td></tr></table>',
    "a column": f'<div id="main">{ARTICLE}</div><div id="right-col"><h3>Latest posts</h3><ul><li><a href="/1">One post</a></li><li><a href="/2">Two post</a></li></ul></div>',
    "an article named like comments": f'<nav><a href="/">Home</a></nav><div class="commentary">{ARTICLE}</div>',
    "a part named like a teaser": f'<nav><a href="/">Home</a></nav><article><h1>Title here</h1><p>{STORY}</p><section class="more-detail"><p>{STORY}</p></section></article>',
}


@pytest.mark.parametrize("layout", sorted(LAYOUTS))
def test_layouts_that_names_do_not_give_away(layout):
    assert H.extract([f"<html><body>{LAYOUTS[layout]}</body></html>"], H.train()) == [KEPT]


def test_decoding_is_optimal_and_consistent():
    import itertools
    import random

    rng = random.Random(1)
    for _ in range(60):
        n = rng.randrange(2, 9)
        parent = [-1] + [rng.randrange(i) for i in range(1, n)]
        odds = [rng.uniform(-2, 2) for _ in range(n)]
        best = max(
            (k for k in itertools.product([True, False], repeat=n) if k[0] and all(k[parent[i]] or not k[i] for i in range(1, n))),
            key=lambda k: sum(o if kept else -o for o, kept in zip(odds, k)),
        )
        assert H.decode(parent, odds) == list(best)


def test_reader_closes_what_browsers_close():
    page = dom.read("<ul><li>a<li>b</ul><p>c<div>d</div></p>e")
    assert page.tag == ["#document", "ul", "li", "li", "p", "div"] and page.parent[3] == 1 and page.parent[5] == 0
    assert [("".join(t for _, t in b)) for b in page.blocks] == ["a", "b", "c", "d", "e"]
