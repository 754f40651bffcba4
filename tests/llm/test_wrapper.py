"""Wrappers: inference on small streams, extraction, edge pages."""

from html.parser import HTMLParser

from revlens.llm import wrapper as W
from revlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


class Plain(HTMLParser):
    """Blocks of the article element, for pages like those of the tables."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.now = False, [], []

    def cut(self):
        text = " ".join("".join(self.now).split())
        self.now = []
        if text:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        elif tag in ("p", "h1"):
            self.cut()
        elif tag == "br":
            self.now.append(" ")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.cut()
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.now.append(data)


def plain(page):
    p = Plain()
    p.feed(page or "")
    p.close()
    p.cut()
    return "\n\n".join(p.blocks)


def wrap(*pages):
    out = None
    for p in pages:
        s = W.stream(W.parse(p))
        out = s if out is None else W.merge_lists(out, s)
    return W.describe(out)


def test_slots_repeats_and_options():
    assert wrap("<p>a</p>", "<p>b</p>") == "<p>#</p>"
    assert wrap("<ul><li>x<li>y</ul>", "<ul><li>z</ul>") == "<ul>(<li>#</li>)+</ul>"
    assert wrap("<h1>t</h1><p>x</p>", "<h1>t</h1><div>n</div><p>x</p>") == "<h1>'t'</h1>(<div>'n'</div>)?<p>'x'</p>"
    assert wrap("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "<dl><dt>a<dd>b</dl>").startswith("<dl>")
    assert "(<dt>#</dt><dd>#</dd>)+" in wrap("<dl><dt>a<dd>b<dt>c<dd>d</dl>")


def test_query_matches_plain_parser(spark):
    want = {r.page_id: (r.url, plain(r.html)) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op2_html"][0](spark, SF).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.url, r.text) == want[r.page_id] and r.n_chars == len(r.text)


PAGE = """<!doctype html><html><head><title>T</title></head><body><header><h1>Site</h1></header>
<nav><a href=x>menu</a></nav><div class="cookie-notice">We use cookies</div>
<div id=wrap><article><header><h1>Head &eacute;&#x21;</h1><span>by me</span></header><p title="a>b">One <b>two
 three<p>&lt;four&gt; <span class=ad>buy</span> five<br>six<aside>side</aside><ul><li>i<li>j</ul><form>f<input></form>
<section class="comments"><p>first!</p></section></article></div><footer>f</footer><script>if (a</p>b) {}</script>"""


def test_extract_boilerplate():
    paths, same = W.summarize(W.stream(W.parse(PAGE)), 1)
    assert paths == ["/html/body/div/article"] and not same
    want = "Head é!\n\nOne two three\n\n<four> five six\n\ni\n\nj"
    assert W.extract(PAGE, paths, same) == want
    assert W.extract(PAGE, [], []) == want
    swallowed = "<div class=ad>buy<article><p>y</p></article><section class=comments><article>no</article></section>"
    assert W.extract(swallowed, paths, same) == "y"
    assert W.extract("", [], []) == W.extract("<p", [], []) == ""


def test_pages_without_article(spark):
    pages = [(i, f"http://h.example/{i}", f"<body><div>Same top</div><p>Text {i}</p><div class=footer>z</div>", 1)
             for i in range(8)]
    pages += [(20, None, "<main><p>m</p></main>", 1), (21, "http://h.example/x", None, 1), (22, "bad", "", 1),
              (None, "http://one.example/", "just text &amp; more", 1), (23, "http://d.example", "<div>" * 3000 + "deep", 1),
              (24, "http://l.example", "<article>" + "<p>word " * 20000, 1),
              (24, "http://l.example", "<article>" + "<p>word " * 20000, 1)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, text int")
    rows = W.extract_pages(df).collect()
    assert len(rows) == len(pages)
    got = {r.page_id: r.text for r in rows}
    assert got[0] == "Same top\n\nText 0" or got[0] == "Text 0"
    assert got[20] == "m" and got[21] == got[22] == "" and got[None] == "just text & more" and got[23] == "deep"
    assert got[24] == "\n\n".join(["word"] * 20000)
    clean = W.extract_pages(df.where("page_id < 8")).collect()
    assert sorted(r.text for r in clean) == [f"Text {i}" for i in range(8)]
    assert W.extract_pages(df.limit(0)).count() == 0


def test_texts_of_one_page_alone_stay(spark):
    """Elements that only one page of a host has are its text; what every
    page has outside articles is not."""
    extra = "<h2>Only here</h2><blockquote>Quoted once</blockquote><ul><li>One item</li></ul>"
    rows = [(i, f"http://flat.example/{i}", f"<body><div><h1>Title {i}</h1><p>Para {i}</p>{extra if i == 7 else ''}</div>"
                "<section>On every page</section></body>") for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in W.extract_pages(pages).collect()}
    assert got[7] == "Title 7\n\nPara 7\n\nOnly here\n\nQuoted once\n\nOne item"
    assert got[0] == "Title 0\n\nPara 0"


def flat(spark, body, n=8, host="five.example"):
    rows = [(i, f"http://{host}/{i}", f"<body>{body(i)}</body>") for i in range(n)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return [r.text for r in W.extract_pages(pages).orderBy("page_id").collect()]


def test_slot_text_outvotes_part_of_a_class_name(spark):
    post = flat(spark, lambda i: f"<div class='post-content share-enabled'><h1>T {i}</h1><p>Long para {i}</p></div>"
                                 f"<div class=ad>Buy {i}</div>")
    assert post == [f"T {i}\n\nLong para {i}" for i in range(8)]
    article = flat(spark, lambda i: f"<article><h1>T {i}</h1><section class=social-science><p>Para of page {i}</p></section>"
                                    f"<section class=reader-comments><p>{'long comment ' * 9}{i}</p></section></article>")
    assert article == [f"T {i}\n\nPara of page {i}" for i in range(8)]
    one = flat(spark, lambda i: "<article><section class=social-science><p>All the text</p></section></article>", 1)
    assert one == ["All the text"]


def test_constants_inside_repeats_and_articles_go(spark):
    lines = flat(spark, lambda i: f"<div><h1>Title {i}</h1><p>Para {i}</p><p>Same copyright line</p></div>")
    assert lines == [f"Title {i}\n\nPara {i}" for i in range(8)]
    inside = flat(spark, lambda i: f"<article><div>Home News</div><p>{'Words of page ' * 9}{i}</p>"
                                   "<div>Subscribe now for more</div></article>")
    assert inside == [f"{'Words of page ' * 9}{i}" for i in range(8)]
    copies = flat(spark, lambda i: f"<article><p>One text</p><p>that all pages copy</p><p>but for {i}</p></article>")
    assert copies[3] == "One text\n\nthat all pages copy\n\nbut for 3"
    assert flat(spark, lambda i: "<p>One text</p><div>on all pages</div>") == ["One text\n\non all pages"] * 8


def test_menus_and_teasers_go(spark):
    menu = flat(spark, lambda i: f"<ul><li>Home<li>News<li>T{i}</ul><div><h1>Title {i}</h1><p>Para of {i}</p></div>")
    assert menu == [f"Title {i}\n\nPara of {i}" for i in range(8)]
    links = flat(spark, lambda i: f"<ul><li><a href=x>Topic {i}</a><li><a href=y>Other topic {i}</a></ul><h1>Title {i}</h1>"
                                  f"<p>Para <a href=z>with a link</a> of {i}</p>")
    assert links == [f"Title {i}\n\nPara with a link of {i}" for i in range(8)]
    teaser = flat(spark, lambda i: f"<article><h1>Title {i}</h1><p>{'Words ' * 20}{i}</p></article>"
                                   f"<article><h2>Next</h2><p>Teaser {i}</p></article>")
    assert teaser == [f"Title {i}\n\n{'Words ' * 20}{i}" for i in range(8)]


def test_text_outside_the_region_of_other_pages_stays(spark):
    """A page that keeps its text elsewhere than its host is read whole."""
    got = flat(spark, lambda i: f"<h1>Title {i}</h1><div id=a><p>{'Words ' * 9}{i}</p></div>" if i < 7 else
               "<table><tr><td>Only this page has a table</table>")
    assert got[0] == f"Title 0\n\n{'Words ' * 9}0" and got[7] == "Only this page has a table"


def test_alignment_is_a_longest_common_subsequence():
    import random

    import numpy as np
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.randrange(4) for _ in range(rng.randrange(12))]
        b = [rng.randrange(4) for _ in range(rng.randrange(12))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
        got = W.common(np.array(a, np.int32), np.array(b, np.int32))
        assert len(got) == best[0][0] and all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
    long = np.arange(3000, dtype=np.int32) % 7  # over the size that was a switch
    assert len(W.common(long, long[1:][::-1][::-1])) == 2999


def test_parts_of_a_host_give_one_wrapper(spark):
    """Layouts beyond one part; tasks and order do not change the result."""
    rows = [(i, f"http://big.example/{i}", "<body><h1>T%d</h1>%s<section>Same end</section></body>" % (
        i, "".join(f"<p>w {i}</p>" if (i >> k) & 1 else f"<div><p>v {i}</p></div>" for k in range(7)))) for i in range(128)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    a = {r.page_id: r.text for r in W.extract_pages(pages.repartition(1)).collect()}
    b = {r.page_id: r.text for r in W.extract_pages(pages.repartition(7)).collect()}
    assert a == b and len(a) == 128
    assert all("Same end" not in t and t.startswith(f"T{i}\n\n") and t.count("\n\n") == 7 for i, t in a.items())
