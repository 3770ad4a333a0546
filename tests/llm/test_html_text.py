import html
import re

import pytest

from tessera.llm.html_text import main_text, page_text

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li><li><a href="/b">Other</a></li></ul></nav><div class="ad">Buy this now please.</div>
{}<footer>&copy; someone &middot; words</footer></body></html>"""


@pytest.mark.parametrize(
    ("inner", "want"),
    [
        ("<article><h1>A &amp; B</h1><p><b>One\n two<br><p>Three</p></article>", "A & B\n\nOne two\n\nThree"),
        ("<article><h1>T</h1><p>Only.</p></article>", "T\n\nOnly."),
        ("<article><p>Of.</p></article>", "Of."),
        ("<article><h1>Same</h1><ul><li>x<li>y <a href=z>link</a></ul><p>end<p>", "Same\n\nx\n\ny link\n\nend"),
        ("<article><p>text</p><aside>side</aside><div class='comments'><p>first!</p></div><form><p>mail</p></form><p>more</article>", "text\n\nmore"),
        ("<main><div id=cookie-notice>We use cookies</div><article><section><p>long enough text a</p></section><section><p>b</p></section></article></main>", "long enough text a\n\nb"),
        ("<div class=sidebar><p>Some words to the side</p></div><div class=story><h2>Head</h2><p>First paragraph of it.</p><p>Second paragraph of it.</p></div>", "Head\n\nFirst paragraph of it.\n\nSecond paragraph of it."),
        ("<article><header><h1>Kept</h1></header><p>w&#x20AC;&eacute;&am;p</p></article>", "Kept\n\nw€é&am;p"),
        ("<article><p class=ad>Buy<p>real</p><ul><li class=share>tweet<li>kept</ul></article>", "real\n\nkept"),
        ("<div class='content has-sidebar'><div id='page' class='layout-sidebar-right'><article><p>kept</p></article></div></div>", "kept"),
        ("<div class='social-studies'><div class='sidebar'><article><p>kept all</p></article></div></div>", "kept all"),
        ("<article><p>Before.</p><div class='share-price'><p>The price.</p></div><div id='discussion'><p>We discuss.</p></div></article>", "Before.\n\nThe price.\n\nWe discuss."),
        ("<article><p>Text of it.</p><div class='share-buttons'>Tweet</div><section id='commentsSection'><article class=comment><p>first!</p></article></section></article>", "Text of it."),
        ("<div class='widget'><p>Nearly all of the text of this page</p><p>stands in here, in paragraphs,</p><p>whatever it is called.</p></div>", "Nearly all of the text of this page\n\nstands in here, in paragraphs,\n\nwhatever it is called."),
        ("", ""),
    ],
)
def test_pages(inner, want):
    assert main_text(PAGE.format(inner)) == want


@pytest.mark.parametrize("text", ["", "<", "plain words", "<p>a<p", "<article><p>x &am", "<script>never closed <p>x</p>", "</p></div>", "<p>" * 3000 + "deep" + "<div>" * 3000, "<nav>only <p>menu"])
def test_broken_pages_do_not_fail(text):
    main_text(text)


def test_cut_pages():
    assert main_text("<body><article><p>one two</p><p>three fo") == "one two\n\nthree fo"
    assert main_text("<body><article><p>one two</p><p cla") == "one two"


def expected(page):
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)
    blocks = re.split(r"</?(?:p|h1)>", inner[1]) if inner else []
    return "\n\n".join(t for b in blocks if (t := " ".join(html.unescape(re.sub(r"<[^>]*>?", " ", b)).split())))


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: expected(r.html) for r in pages.collect()}
    got = page_text(pages).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def plain_density(html_text):
    """Text of the node of the largest sum of child densities, straight from the definition, over a page of closed tags."""
    import math
    import xml.etree.ElementTree as Xml

    body = Xml.fromstring(html_text)
    chars = lambda n: sum(len("".join(t.split())) for t in n.itertext())
    tags = lambda n: sum(1 for _ in n.iter()) - 1
    links = lambda n: [a for a in n.iter("a")]
    link_chars = lambda n: sum(map(chars, links(n)))
    share = link_chars(body) / max(1, chars(body))

    def density(n):
        c, lc, t, lt = chars(n), max(1, link_chars(n)), max(1, tags(n)), max(1, sum(1 + tags(a) for a in links(n)))
        base = math.log(c / max(1, c - link_chars(n)) * link_chars(n) + share * c + math.e)
        return max(0.0, c / t * (math.log(c / lc * t / lt) if c else 0.0) / max(math.log(base), 0.05))

    best = max(body.iter(), key=lambda n: (sum(density(k) for k in n), chars(n)))
    return [" ".join(p.itertext()) for p in best.iter("p")]


def test_density_without_article_elements():
    import random

    rnd = random.Random(5)
    words = lambda n: " ".join(rnd.choice(["some", "plain", "words", "about", "things"]) for _ in range(n))
    for _ in range(60):
        menu = "".join(f"<li><a>{words(2)}</a></li>" for _ in range(rnd.randint(3, 9)))
        story = "".join(f"<p>{words(rnd.randint(20, 60))}</p>" for _ in range(rnd.randint(3, 8)))
        more = "".join(f"<div><a>{words(4)}</a></div>" for _ in range(rnd.randint(1, 6)))
        parts = [f"<div><ul>{menu}</ul></div>", f"<div>{story}</div>", f"<div>{more}</div>"]
        rnd.shuffle(parts)
        page = f"<body>{''.join(parts)}</body>"
        assert main_text(page) == "\n\n".join(plain_density(page)), page


def test_awkward_rows(spark):
    rows = [(1, "u", None, 1, "x"), (1, "u", None, 1, "x"), (None, None, "", 1, "x"), (3, "u", "<p>" + "word " * 50_000, 1, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")
    got = sorted(((r.page_id, r.url, r.n_chars) for r in page_text(df).collect()), key=str)
    assert got == sorted([(1, "u", 0), (1, "u", 0), (None, None, 0), (3, "u", 249_999)], key=str)
    assert page_text(df.limit(0)).collect() == []


def test_an_article_is_taken_before_longer_text_beside_it():
    say = lambda n, what: "".join(f"<p>{what} number {i}, a sentence of several plain words, and then another one of them.</p>" for i in range(n))
    for named in ("responses", "thread", "x"):
        for inner in (say(6, "Reply"), "".join(f"<div>{say(1, 'Reply')}</div>" for _ in range(6))):
            text = main_text(f'<body><article>{say(3, "Story")}</article><div class="{named}">{inner}</div></body>')
            assert text.count("Story") == 3 and "Reply" not in text
    text = main_text(f"<body><article>{say(1, 'Teaser')}</article><div>{say(12, 'Story')}</div></body>")
    assert text.count("Story") == 12
