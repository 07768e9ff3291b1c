import math
import random
from collections import Counter, defaultdict

import pytest

from foliant.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad">Buy</div><header>Top</header>
<article><h1>Head&amp;line</h1><p><b>First.<br>More <i>te</i>xt<p>Second &lt;x&gt;  &#233;</p><div class="share">Share!</div><form>f</form>
<table><tr><td>a<td>b</table><section id="comments"><p>Nice</p></section></article><aside>Side</aside><footer>&copy; F</footer></body></html>"""


def test_article_only():
    assert H.Page(PAGE).text() == "Head&line\nFirst. More text\nSecond <x> é\na\nb"


def test_odd_pages():
    assert H.Page("").text() == ""
    assert H.Page("no tags &am").text() == "no tags &am"
    assert H.Page("a < b <p").text() == "a < b"
    assert H.Page("<p>one<p>two<!-- x").text() == "one\ntwo"
    assert H.Page("<main><p>in</p></main><p>out</p>").text() == "in"
    assert H.Page("<div>" * 2000 + "deep" + "</div>" * 2000).text() == "deep"
    assert H.Page("<p>x" * 3000).text().count("x") == 3000
    assert H.Page("<article>one</article><p>x</p><article>two</article>").text() == "one\ntwo"


def page(k: int, notice: str = "We sell all data") -> str:
    return f"<html><body><article><h1>Title {k}</h1><div class='box'>{notice}</div><p>Own text {k} {k * k}</p></article></body></html>"


def test_low_entropy_branches_go(spark):
    rows = [(k, "http://A.example:80/x", page(k)) for k in range(12)] + [(99, "http://b.example/", page(1)), (100, "http://a.example/y", page(3)), (101, None, None), (None, "x", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' as host", "1 as cut")
    want = {k: f"Title {k}\nOwn text {k} {k * k}" for k in range(12)} | {99: "Title 1\nWe sell all data\nOwn text 1 1", 100: "Title 3\nOwn text 3 9", 101: "", None: ""}
    for sent in (1000, 0):  # sent to the tasks, and joined
        got = {r.page_id: (r.text, r.n_chars) for r in H.extract_pages(df, sent=sent).collect()}
        assert got == {k: (t, len(t)) for k, t in want.items()}


def unnamed(rng, k: int) -> tuple[str, str]:
    """A page of neutral tags and class names, and its article; menu, notice and side differ from page to page."""
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    title, parts = words(4), [words(rng.randint(5, 40)) for _ in range(rng.randint(1, 12))]
    body = "".join(rng.choice(("<p>{}</p>", "<p><b>{}</b></p>", "<h2>{}</h2>")).format(x) for x in parts)
    menu = "".join(f"<span>{words(1)}</span>" for _ in range(6))
    source = f"<html><body><div class=q1>{menu}</div><div class=q2>{words(6)}</div><div class=q3><h1>{title}</h1><div class=q5>Same on all pages</div>{body}</div><div class=q4>{words(5)} {k}</div></body></html>"
    return source, "\n".join([title, *parts])


def test_main_branch_without_names(spark, monkeypatch):
    """No article element and no known names: the tree alone finds title and text on hosts with pages enough."""
    rng = random.Random(8)
    made = [unnamed(rng, k) for k in range(40)]
    df = spark.createDataFrame([(k, "http://n.example/", s) for k, (s, _) in enumerate(made)] + [(99, "http://few.example/", made[0][0])], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in H.extract_pages(df).collect()}
    assert [got[k] for k in range(40)] == [t for _, t in made]
    assert "Same on all pages" in got[99] and made[0][1].split("\n")[0] in got[99]


def test_names_still_cut_inside_the_main_branch(spark):
    rng = random.Random(9)
    rows, want = [], []
    for k in range(20):
        source, text = unnamed(rng, k)
        comments = "".join(f"<p>{rng.randrange(10**9)} says</p>" for _ in range(rng.randint(0, 5)))
        rows.append((k, "http://n.example/", source.replace("</div><div class=q4>", f"<section id=comments>{comments}</section></div><div class=q4>")))
        want.append(text)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in H.extract_pages(df).collect()} == dict(enumerate(want))


def plain_tree(sources: list[str]) -> dict[int, tuple[int, float, float, float]]:
    """pages, content, presentation and mass of each node, reckoned page by page."""
    seen = defaultdict(list)
    for s in set(sources):
        for path, content, look, size in H.Page(s, tree=True).nodes():
            seen[path].append((content, look, size))
    whole = sum(size for _, _, size in seen[0])

    def entropy(values):
        counts = Counter(values)
        return sum(n / len(values) * math.log(len(values) / n) for n in counts.values())

    out = {}
    for path, rows in seen.items():
        m = len(rows)
        content = entropy([r[0] for r in rows] + ["other"]) / math.log(m + 1)
        out[path] = m, content, min(1, entropy([r[1] for r in rows]) / math.log(8)), sum(r[2] for r in rows) / whole
    return out


def test_entropies_against_a_plain_reckoning(spark):
    rng = random.Random(10)
    hosts = {f"h{h}.example": [unnamed(random.Random(rng.randrange(20)), 0)[0] for _ in range(n)] for h, n in enumerate((1, 2, 5, 30))}
    hosts["h9.example"] = [PAGE, PAGE, PAGE + "<p>more"]
    df = spark.createDataFrame([(i, f"http://{h}/{i}", s) for h, pages in hosts.items() for i, s in enumerate(pages)], "page_id long, url string, html string")
    got = defaultdict(dict)
    for r in H.style_tree(df).collect():
        assert r.importance == pytest.approx((r.content + r.presentation) / 2)
        got[r.host][r.path] = r.pages, r.content, r.presentation, r.mass
    assert set(got) == set(hosts)
    for host, sources in hosts.items():
        want = plain_tree(sources)
        assert set(got[host]) == set(want)
        for path, numbers in want.items():
            assert got[host][path] == pytest.approx(numbers, abs=1e-9)


def test_copies_keep_their_text(spark):
    df = spark.createDataFrame([(k, "http://a.example/", page(1)) for k in range(30)], "page_id long, url string, html string")
    assert {r.text for r in H.extract_pages(df).collect()} == {"Title 1\nWe sell all data\nOwn text 1 1"}
    # one article under menus that differ: nothing is left but the article
    df = spark.createDataFrame([(k, "http://a.example/", page(1).replace("<body>", f"<body><nav>{k}</nav>")) for k in range(30)], "page_id long, url string, html string")
    assert {r.text for r in H.extract_pages(df).collect()} == {"Title 1\nWe sell all data\nOwn text 1 1"}


def test_table_against_articles(spark):
    """All pages of a table whose articles are known by their tags, as they are and without any telling name."""
    import html
    import re

    from pyspark.sql import functions as F

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    squeeze = lambda t: " ".join(t.split())
    want = {r.page_id: squeeze(html.unescape(re.sub(r"<[^>]*>", " ", re.search(r"<article>(.*)</article>", r.html, re.S)[1]))) for r in pages.collect()}
    got = {r.page_id: squeeze(r.text) for r in H.extract_pages(pages).collect()}
    assert {k for k in want if got[k] != want[k]} == set()
    for a, b in (("<nav>", "<div class=k2>"), ("<footer>", "<div class=k3>"), ('class="ad"', "class=k4"), ("<article>", "<div class=k1>"), ("</nav>", "</div>"), ("</footer>", "</div>"), ("</article>", "</div>"), ("<title>", "<!--"), ("</title>", "-->")):
        pages = pages.withColumn("html", F.replace("html", F.lit(a), F.lit(b)))
    pages = pages.withColumn("url", F.lit("http://one.example/"))  # one host of 250 pages
    got = {r.page_id: squeeze(r.text) for r in H.extract_pages(pages).collect()}
    assert {k for k in want if got[k] != want[k]} == set()


def test_long_page_and_empty_table(spark):
    long = "<article>" + "<p>some words here</p>" * 50_000 + "</article>"
    df = spark.createDataFrame([(1, "http://l.example/", long), (2, "http://l.example/", "<p>" + "x" * 2_000_000)], "page_id long, url string, html string")
    got = {r.page_id: r.n_chars for r in H.extract_pages(df).collect()}
    assert got == {1: 50_000 * 16 - 1, 2: 2_000_000}
    assert H.extract_pages(df.limit(0)).count() == 0
