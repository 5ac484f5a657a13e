"""Main text by site style trees, against plain loops over a DOM of another parser."""

import html as references
import math
import random
from collections import Counter, defaultdict
from html.parser import HTMLParser

from pyspark.sql import functions as F

from tests.llm.helpers import prose
from tidemark.llm import site_tree

SCHEMA = "page_id long, url string, html string, main string, _host string, removed string"


def _pages(spark, rows):
    return spark.createDataFrame([(i, url, markup, "m", "h", "r") for i, (url, markup) in enumerate(rows)], SCHEMA)


def _texts(spark, rows, **limits):
    found = site_tree.extract(_pages(spark, rows).repartition(3), **limits)
    assert found.columns[:6] == ["page_id", "url", "html", "main", "_host", "removed"]
    got = found.select("page_id", "_main.*", "main", "_host", "removed").collect()
    assert all((r["main"], r["_host"], r["removed"]) == ("m", "h", "r") for r in got)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    return {r["page_id"]: r for r in got}


def _site(host, n, seed, copies=0):
    """Pages of plain divs: nothing but repetition tells the menu, the notice and the footer from the article."""
    rng, rows, articles = random.Random(seed), [], []
    for i in range(n):
        paragraphs = [prose(seed * 1000 + i * 10 + k, rng.randint(3, 12)) for k in range(rng.randint(1, 6))]
        articles.append(paragraphs)
    articles += [articles[0]] * copies
    for i, paragraphs in enumerate(articles):
        menu = "".join(f"<li><a href='/{w}'>{w} of {host}</a></li>" for w in ("home", "news", "about"))
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        rows.append(
            (
                f"https://{host}/{i}?x=1",
                f"<html><head><title>t</title></head><body><!-- {i} --><div><ul>{menu}</ul></div>"
                f"<div><p>We use a jar at {host}</p></div><div><h2>{paragraphs[0]} &amp; more</h2>{body}</div>"
                f"<div>&copy; {host}</div></body></html>",
            )
        )
    return rows, ["\n".join([f"{p[0]} & more", *p]) for p in articles]


def test_the_tree_alone_removes_what_a_site_repeats(spark):
    rows, want = _site("a.example", 12, 1)
    more, wanted = _site("b.example", 9, 2, copies=30)
    got = _texts(spark, rows + more)
    assert [got[i]["text"] for i in range(len(rows + more))] == want + wanted
    assert all(r["by_label"] == 0 and r["by_tree"] == 5 for r in got.values())


def test_few_pages_are_no_evidence(spark):
    """One page copied a hundred times is one page; nothing is known of its site."""
    (row,), _ = _site("a.example", 1, 1)
    for rows in ([row], [row] * 100):
        got = _texts(spark, rows)
        assert all("We use a jar" in r["text"] and r["by_tree"] == 0 for r in got.values())


class _Dom(HTMLParser):
    """Text blocks of well-formed pages with the labels of all elements around them."""

    def __init__(self, markup):
        super().__init__(convert_charrefs=True)
        self.path, self.blocks, self.children = [], [], {}
        self.styles = Counter()
        self.feed(markup)

    def handle_starttag(self, tag, attributes):
        self.children.setdefault(tuple(self.path), []).append(tag)
        if tag in ("a", "b"):
            return
        place = ""
        if tag in ("div", "ul"):
            place = Counter(self.children[tuple(self.path)])[tag]
        self.path.append(f"{tag}{place}")
        self.children[tuple(self.path)] = []

    def handle_endtag(self, tag):
        if tag not in ("a", "b"):
            self.styles[tuple(self.path), " ".join(self.children[tuple(self.path)])] += 1
            self.path.pop()

    def handle_data(self, data):
        if "title" not in self.path and data.strip():
            self.blocks.append((tuple(self.path), " ".join(data.split())))


def test_importances_equal_plain_loops(spark):
    rows = _site("a.example", 12, 3)[0] + _site("b.example", 10, 4, copies=5)[0]
    pages = {(url.split("/")[2], tuple(_Dom(markup).blocks)): _Dom(markup) for url, markup in rows}
    holding, texts, styles = defaultdict(set), defaultdict(lambda: defaultdict(set)), defaultdict(lambda: defaultdict(set))
    for key, dom in pages.items():
        for node, text in dom.blocks:
            holding[key[0], node].add(key)
            texts[key[0], node][text].add(key)
        for node, style in dom.styles:
            styles[key[0], node][style].add(key)
    want = []
    for node, on in holding.items():
        most = math.log(len(on)) if len(on) > 1 else 1
        content = 1 - sum(math.log(len(p)) for p in texts[node].values()) / len(texts[node]) / most
        counts = [len(p) for p in styles[node].values()]
        entropy = -sum(c / sum(counts) * math.log(c / sum(counts)) for c in counts) / most
        share = site_tree.GAMMA ** (len(counts) - 1)
        want.append((len(on), round((1 - share) * min(1, entropy) + share * content, 9)))
    got = [(r["pages"], round(r["importance"], 9)) for r in site_tree.importances(_pages(spark, rows)).collect()]
    assert sorted(got) == sorted(want)


PAGE = (
    "<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t='</p>';</script></head><body class='has-sidebar'>"
    "<header class=site-header><h1>Site</h1></header><nav><a href='x'>Menu</a></nav><div id='cookie-notice'>Cookies!</div>"
    "<main><article class='post'><header><h1>Title &lt;1&gt;</h1></header><p>One<b> two<br>three <i>four</p><p>Five&nbsp;six<p>seven &amp eight"
    "<span class='ad'>Buy</span> nine<ul><li>a<li>b</ul><div hidden>never</div><table><tr><td>c<td>d</table>"
    "<div class='advert-box'>Buy more</div><form><p>Mail</p><select><option>x</select></form><!-- no --></article>"
    "<section class='comments'><p>First!</p></section></main><aside>Side</aside><footer>&copy; 2020</footer></body></html>"
)


def test_labels_and_mended_markup(spark):
    want = "Title <1>\nOne two three four\nFive six\nseven & eight nine\na\nb\nc\nd"
    got = _texts(spark, [("http://x.example/", PAGE), (None, PAGE), ("not an address", PAGE)])
    assert {r["text"] for r in got.values()} == {want}


def test_odd_pages(spark):
    odd = [
        None, "", "  ", "just text < 3 & 4 > 2", "<p>a", "<p>a</p", "<p>cut <a href='x", "<div><div><div>deep", "</p></div>x",
        "<button>no end<p>kept</p>", "<svg><text>no</text></svg>yes", "<script>never closed <p>x", "<p>\n a \t b\x0b\x0c c\r\n</p>",
        "<h1>only</h1>", "<p class=\"a>b</p><p>c</p>", "&#65;&#x42;&am; &quo", "<nav>n<article>a</article>", "<div>" * 3000 + "x" + "</div>" * 3000,
        "<p>" + "word " * 300_000 + "</p>", "<select><option>a", "<p>ok</p><!-- open <p>x</p>",
    ]
    got = _texts(spark, [(f"http://h{i}.example/", m) for i, m in enumerate(odd)])
    texts = [got[i]["text"] for i in range(len(odd))]
    assert texts[:9] == ["", "", "", "just text < 3 & 4 > 2", "a", "a", "cut", "deep", "x"]
    assert texts[9:18] == ["no end\nkept", "yes", "", "a b c", "only", "b\nc", "AB&am; &quo", "n\na", "x"]
    assert texts[18:] == [("word " * 300_000).strip(), "a", "ok"]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert site_tree.extract(empty).count() == 0


def test_references_are_decoded_once(spark):
    text = "&amp;lt;b&amp;gt; &eacute;&#10;x"
    got = _texts(spark, [("http://x.example/", f"<p>{text}</p>")])
    assert got[0]["text"] == " ".join(references.unescape(text).split()) == "&lt;b&gt; é x"


def test_host_of(spark):
    urls = ["http://A.Example:80/x", "https://u:p@b.example?q", "ftp://c", "no", None, "http:///x", "//d/"]
    table = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in table.select(site_tree.host_of(F.col("u"))).collect()]
    assert got == ["a.example", "b.example", "c", None, None, None, None]
