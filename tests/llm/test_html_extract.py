import random

import pytest

from quarrylink.llm import html_extract as q

HEAD = '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">menu</a></li></ul></nav><!-- ad --><div class="ad">buy</div>'


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_article_is_the_text(spark):
    page = HEAD + '<article><h1>A &amp; B&am</h1><p><b>one \n two<br>three<p>said &lt;b&gt;</p><form>send</form><div class="reader comments">no</div><p hidden>no</p></article><footer>&copy; x</footer>'
    rows = q.extract(pages(spark, [(1, "http://a.b/c", page), (2, None, None), (3, "x", ""), (1, "http://a.b/c", page)])).collect()
    want = "A & B&am\none two three\nsaid <b>"
    assert sorted((r.page_id, r.text, r.n_chars) for r in rows) == [(1, want, len(want))] * 2 + [(2, "", 0), (3, "", 0)]


def test_repeated_article_lines_stay(spark):
    page = lambda i: HEAD + f"<article><p>own {i}</p><p>a passage all have</p></article>"
    rows = q.extract(pages(spark, [(i, f"http://a.b/{i}", page(i)) for i in range(200)])).collect()
    assert all(r.text == f"own {r.page_id}\na passage all have" for r in rows) and len(rows) == 200


def test_differencing_deletes_what_the_nearest_page_shares(spark):
    page = lambda i: f"<body><div>Site name</div><div>story {i}</div><div>Terms of use</div></body>"
    rows = [(i, f"http://a.b/news/{i:04d}", page(i)) for i in range(300)] + [(900, "http://other.c/news/0001", page(900))]
    got = {r.page_id: r.text for r in q.extract(pages(spark, rows)).collect()}
    assert all(got[i] == f"story {i}" for i in range(300))
    assert got[900] == "Site name\nstory 900\nTerms of use"


def test_differencing_does_not_depend_on_tasks(spark):
    page = lambda i: f"<body><p>top {i % 3}</p><p>story {i}</p></body>"
    df = pages(spark, [(i, f"http://a.b/{i % 7}/{i}", page(i)) for i in range(500)])
    once = {r.page_id: r.text for r in q.extract(df.repartition(1)).collect()}
    assert once == {r.page_id: r.text for r in q.extract(df.repartition(13)).collect()}


def test_common_subsequence():
    a, b = list("abcbdab"), list("bdcaba")
    pairs = q.common(a, b)
    assert len(pairs) == 4 and all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs)


def test_empty_table(spark):
    assert q.extract(pages(spark, [])).collect() == []


def test_copies_on_adjacent_urls_get_one_text(spark):
    page = lambda i: f"<body><div>Site name</div><div>story {i}</div><div>Terms of use</div></body>"
    rows = [(i, f"http://a.b/news/{i:04d}", page(0 if 10 <= i < 200 else i)) for i in range(300)] + [(7, "http://a.b/news/0007", page(7))] * 3
    got = q.extract(pages(spark, rows)).collect()
    assert len(got) == 303 and all(r.text == f"story {0 if 10 <= r.page_id < 200 else r.page_id}" for r in got)


@pytest.mark.parametrize("html, want", [
    ('<article><p>One</p><img class="banner"><p>Two</p></article>', "One\nTwo"),
    ("<article><p>One</p><input hidden><p>Two</p></article>", "One\nTwo"),
    ('<article><p>One<br class="ad">more</p><p>Two</p></article>', "One more\nTwo"),
    ('<p class="notice">n<p>Two<p>Three', "Two\nThree"),
    ("<ul><li class=share>s<li>a<li>b</ul><p>Two", "a\nb\nTwo"),
    ('<article><p>see <a href="/hidden-lake">the lake</a> now</p></article>', "see the lake now"),
    ('<article><p>see <a title="a hidden valley">the valley</a></p></article>', "see the valley"),
    ("<head><title>T</title><body><p>One", "One"),
    ("<article><p>a<svg><path d='M0'/></svg>b</p></article>", "ab"),
    ('<div class="menu"><p>m<div>n</div></div><p>Two', "Two"),
    ('<table><tr><td class="ad">x<td>y<tr><td>z</table>', "y\nz"),
    ('<dl><dt class="promo">p<dd>q</dl>', "q"),
    ("<article><p>a <b>b <i>c</b> d</i> e</p><p>f</p></article>", "a b c d e\nf"),
])
def test_elements_end_where_html_ends_them(html, want):
    assert q.main_text(html) == want


class Tree:
    """A plain tree parser over well-formed pages."""

    def __init__(self, r):
        self.r = r

    def page(self, depth=0):
        """(html, lines as (text, article, chrome)) of a random element."""
        r = self.r
        tag = r.choice(["div", "section", "nav", "p", "article", "footer", "span"] if depth < 4 else ["p", "span"])
        return tag, (f"text {r.randrange(10**6)}" if r.random() < 0.7 else ""), [self.page(depth + 1) for _ in range(r.randrange(4) if tag not in ("p", "span") else 0)]

    def html(self, node):
        tag, text, kids = node
        return f"<{tag}>{text}{''.join(map(self.html, kids))}</{tag}>"

    def pieces(self, node, article=False, chrome=False):
        """Texts and block ends in order."""
        tag, text, kids = node
        block = tag != "span"
        chrome = chrome or tag in ("nav", "footer")
        article = article or tag == "article" and not chrome
        yield from [None] * block
        if text:
            yield text, article and not chrome, chrome
        for kid in kids:
            yield from self.pieces(kid, article, chrome)
        yield from [None] * block


def test_lines_equal_those_of_a_tree():
    r = random.Random(5)
    for _ in range(300):
        tree = Tree(r)
        node = ("body", "", [tree.page() for _ in range(4)])
        want, now = [], []
        for piece in [*tree.pieces(node), None]:
            if piece:
                now.append(piece)
            elif now:
                want.append(("".join(p[0] for p in now), now[0][1], now[0][2]))
                now = []
        assert [(x.text, x.article, x.chrome) for x in q.lines_of(tree.html(node))] == want


def test_very_long_pages_and_clashing_columns(spark):
    html = "<article>" + "".join(f"<p>paragraph {i}</p>" for i in range(60_000)) + "</article>"
    df = spark.createDataFrame([(1, "http://a.b/c", html, "x", 2, [1])], "page_id long, url string, html string, text string, a int, kept array<int>")
    (row,) = q.extract(df).collect()
    assert row.n_chars == len(row.text) and row.text.endswith("paragraph 59999") and row.text.count("\n") == 59_999


def test_differencing_decides_on_pages_with_an_article(spark):
    """The site's header in an article goes as the nearest page shares it; the article's own header and body stay."""
    page = lambda i: f"<article><header>Site name</header><header><h1>Title</h1>by author {i}</header><p>own {i}</p><p>all have this</p><div class='footer'>Terms</div></article>"
    df = pages(spark, [(i, f"http://a.b/{i:03d}", page(i)) for i in range(150)] + [(900, "http://c.d/1", page(900))])
    got = {r.page_id: r.text for r in q.extract(df).collect()}
    assert all(got[i] == f"Title\nby author {i}\nown {i}\nall have this" for i in range(150))
    assert got[900] == "Site name\nTitle\nby author 900\nown 900\nall have this\nTerms"
    kept = q.differenced(q.outlined(df)).collect()
    assert len(kept) == 151 and sorted(len(r.kept) for r in kept) == [2] * 150 + [6]
