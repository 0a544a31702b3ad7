"""Main texts: reading of untidy pages, templates against a plain deduction, whole pages."""

import html as escapes
import random
import re
from collections import defaultdict

from ledgerlark.llm import html_extract, queries
from ledgerlark.llm.html_blocks import read_page

SCHEMA = "page_id bigint, url string, html string, text string, host string, main int"


def texts(spark, rows):
    table = spark.createDataFrame([(n, u, h, "mine", "h", 1) for n, (u, h) in enumerate(rows)], SCHEMA)
    out = html_extract.extract_main_text(table)
    assert out.columns == [*table.columns, "text_", "n_chars"]
    found = {}
    for r in out.collect():
        assert (r["text"], r["host"], r["main"]) == ("mine", "h", 1) and r["n_chars"] == len(r["text_"])
        found[r["page_id"]] = r["text_"]
    assert len(found) == len(rows)
    return [found[n] for n in range(len(rows))]


def blocks(source):
    return [(b.element.path, b.text) for b in read_page(source).blocks]


def test_untidy_pages_are_read():
    assert blocks("<p><b>a<br><p>b &amp;&#x41; <i>c</i>\n\t d</p>") == [("/p", "a"), ("/p", "b &A c d")]
    assert blocks("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e") == [
        ("/ul/li", "a"), ("/ul/li", "b"), ("/ul/li/ul/li", "c"), ("/ul/li", "d"), ("", "e")
    ]
    assert blocks("a<!-- <p>no --> b<script>var t='</p>';</SCRIPT >c<style>x") == [("", "a bc")]
    assert blocks("<table><tr><td>a<td>b<tr><td>c</table>") == [(f"/table/tr/td", t) for t in "abc"]
    assert blocks('<div class="x1 y" title="a > b" id=z>t</div></p></div>u') == [("/div.x.y.z", "t"), ("", "u")]
    assert blocks("1 < 2 &lt; 3 <p/>x</span></section") == [("", "1 < 2 < 3"), ("", "x")]
    assert blocks("<p title=\"open>text <p title='x'>b")[-1] == ("/p", "b")
    assert blocks("") == blocks("<p") == blocks("<!-- ") == blocks("<p>&nbsp; \n</p>") == []
    long = "<p>" + "word " * 200_000 + "</p>" + "<div>" * 3000 + "deep"
    found = blocks(long)
    assert len(found[0][1]) == 999_999 and found[1][1] == "deep"


def prose(r, n):
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 9))) for _ in range(n))


def site(n, seed=1):
    """Pages without article elements: what is fixed shows only by comparing them."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        body = [prose(r, r.randint(20, 60)) for _ in range(r.randint(2, 6))]
        promo = "<div class=ad>" + prose(r, 5) + "</div>" if i % 3 == 0 else ""
        page = (
            f"<html><head><title>{prose(r, 3)}</title></head><body><div id=top><a href=/>Home</a> <a href=/x>More</a></div>"
            f"<div id=page><div class='c1'><h2>{prose(r, 4)}</h2><p>Read our letter every day.</p>{promo}"
            + "".join(f"<p>{b}</p>" for b in body)
            + f"<section class='reader-comments'><p>{prose(r, 30)}</p></section></div></div>"
            + "<div id=end>All rights kept by us, for ever and a day.</div></body></html>"
        )
        title = re.search("<h2>(.*?)</h2>", page).group(1)
        out.append((f"http://Plain.example/{i}", page, "\n".join([title, *body])))
    return out


def test_template_of_a_host(spark):
    rows = site(24)
    article = "<html><body><nav>menu</nav><article><h1>T</h1><p>One.</p><p>Two &amp; three.</p></article><footer>f</footer>"
    extra = [
        (None, article), ("no scheme", article), ("http://one.example", "<div><p>Alone on its host.</p></div>"),
        ("http://a.example/", None), ("http://a.example/", ""), ("http://a.example/", "no markup at all"),
        ("http://plain.example/other", "<html><body><main><p>Another layout.</p></main></body></html>"),
    ]
    found = texts(spark, [(u, h) for u, h, _ in rows] + extra + [(rows[0][0], rows[0][1])] * 5)
    assert found[:24] == [t for _, _, t in rows]
    assert found[24:31] == [
        "T\nOne.\nTwo & three.", "T\nOne.\nTwo & three.", "Alone on its host.", "", "", "no markup at all", "Another layout.",
    ]
    assert found[31:] == [rows[0][2]] * 5


def test_copies_make_no_template(spark):
    """Near copies that fill a host keep their shared paragraphs."""
    r = random.Random(5)
    shared = [prose(r, 30) for _ in range(5)]
    pages = [(f"http://c.example/{i}", "<article>" + "".join(f"<p>{s}</p>" for s in shared) + f"<p>{i}</p></article>") for i in range(9)]
    assert texts(spark, pages) == ["\n".join([*shared, str(i)]) for i in range(9)]


def test_what_is_not_the_article(spark):
    outside = (
        "<header><p>site</p></header><nav>n</nav><aside>side</aside><form><p>f</p></form><div class='cookie-notice'>c</div>"
        "<div id=comments><p>reply</p></div><div role=banner>b</div><div hidden>h</div><script>s</script><style>t</style>"
    )
    page = f"<body class='has-sidebar'>{outside}<div class='widget'><article><header><h1>Title</h1></header><p>Text.</p>{outside}<p>End.</p></article></div>{outside}</body>"
    assert texts(spark, [("http://h.example", page)]) == ["Title\nText.\nsite\nEnd."]  # a header within the article stays


def test_empty_table(spark):
    assert texts(spark, []) == []


def plain_classes(rows):
    """host -> {frozenset of tokens}: tokens with equal counts on all different pages of the host."""
    vectors = defaultdict(lambda: defaultdict(dict))
    for url, source in rows:
        host = re.search("://([^/?#]*)", url).group(1).lower()
        page = read_page(source)
        for e in page.elements:
            vectors[host][e.path].setdefault(source, 0)
            vectors[host][e.path][source] += 1
    out = {}
    for host, tokens in vectors.items():
        classes = defaultdict(set)
        pages = {s for v in tokens.values() for s in v}
        for token, vector in tokens.items():
            if len(vector) * html_extract.RARITY >= len(pages):
                classes[frozenset(vector.items())].add(token)
        out[host] = set(map(frozenset, classes.values()))
    return out


def test_classes_against_plain_vectors(spark):
    rows = [(u, h) for u, h, _ in site(30)] + [(u.replace("Plain", "b"), h) for u, h, _ in site(7, 2)]
    rows += rows[:4]
    table = spark.createDataFrame(rows, "url string, html string")
    tokens = html_extract.page_tokens(table, "url", "html").dropDuplicates(["host", "content"])
    found = defaultdict(lambda: defaultdict(set))
    for r in html_extract.host_classes(tokens).where("text IS NULL").collect():
        found[r["host"]][r["vector"]].add(r["path"])
    assert {h: set(map(frozenset, c.values())) for h, c in found.items()} == plain_classes(rows)


def test_classes_out_of_order_are_not_valid(spark):
    rows = [(f"http://h/{i}", f"<div class={'ab'[i % 2]}>x{i}</div><div class={'ba'[i % 2]}>y{i}</div><p>t</p>") for i in range(6)]
    tokens = html_extract.page_tokens(spark.createDataFrame(rows, "url string, html string"), "url", "html")
    classes = html_extract.host_classes(tokens)
    bad = {r["vector"] for r in html_extract.disordered(tokens, classes).collect()}
    assert {r["path"] for r in classes.where("text IS NULL").collect() if r["vector"] in bad} >= {"/div.a", "/div.b"}


def test_query_gives_the_articles(spark):
    sf = "/root/testdata/sf0.01"
    found = {r["page_id"]: r for r in queries.op13_html_extract(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        article = re.search("<article>(.*?)</article>", r["html"], re.S).group(1)
        parts = [escapes.unescape(re.sub("<[^>]*>", " ", p)).split() for p in re.split("</?(?:p|h1)>", article)]
        assert found[r["page_id"]]["text"] == "\n".join(" ".join(p) for p in parts if p)
        assert found[r["page_id"]]["url"] == r["url"]
