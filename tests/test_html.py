"""C1 against Python's html.parser text (script/style
skipped) on every driver page at sf0.01."""

from html.parser import HTMLParser

from revlens.operators import clean as C
from revlens.sources import testdata as td


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.skip:
            self.skip -= 1

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def _parse(html):
    p = _Text()
    p.feed(html)
    p.close()
    return "".join(p.out).lower()


def test_strip_html_matches_parser(spark):
    pages = td.pages(spark, "/root/testdata/sf0.01")
    rows = C.strip_html_tags(pages, "html", "cleaned_text").select("html", "cleaned_text").collect()
    bad = [r for r in rows if r.cleaned_text != _parse(r.html)]
    assert len(rows) > 0 and not bad, bad[:1]


def test_strip_html_inline_cases(spark):
    cases = ["plain text", "", "<b>Bold</b> &amp; <i>it</i>", "a<!-- c -->b", "<script>x=1</script>ok",
             "&lt;tag&gt; &quot;q&quot;", "&amp;lt;",
             "&mdash;caf&eacute; it&#8217;s &#x27;x&#x27; &hellip;&nbsp;&euro;5 &AMP; &notareference;",
             '<a title="a>b" href=\'c>d\'>x</a> y', "<STYLE type=a>b{}</STYLE >z", "a < b and c > d", "1<2 &&& 3"]
    df = spark.createDataFrame([(c,) for c in cases], "text string")
    got = [r.cleaned_text for r in C.strip_html_tags(df).collect()]
    assert got == [_parse(c) for c in cases]
