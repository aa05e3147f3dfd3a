import numpy as np
import pytest

from tidegate.llm import html_text


def text(source):
    return html_text.extract([source], html_text.train())[0]


def page(*parts):
    return "<!DOCTYPE html><html><head><title>T</title></head><body>" + "".join(parts) + "</body></html>"


NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">More</a></li></ul></nav>'
FOOTER = "<footer>&copy; example.com &middot; All rights.</footer>"
ARTICLE = "<article><h1>A head line</h1><p>First   words,\n and &amp; more.</p><p>Second one of them.</p></article>"
WANTED = "A head line\nFirst words, and & more.\nSecond one of them."


@pytest.mark.parametrize(
    "source",
    [
        page(NAV, ARTICLE, FOOTER),
        page(NAV, '<div class="ad">Buy this now.</div>', ARTICLE, FOOTER),
        page(NAV, ARTICLE, '<div id="comments"><p>I liked it.</p><p>Me too.</p></div>', FOOTER),
        page('<div class="cookie-notice"><p>We use cookies.</p><button>Yes</button></div>', ARTICLE),
        page(NAV, "<aside><h3>Related</h3><ul><li><a href='x'>Other</a></li></ul></aside>", ARTICLE),
        page('<form class="search"><label>Find</label><input><button>Go</button></form>', ARTICLE),
        page(NAV, "<script>var a='<p>no</p>';</script><style>p{}</style>", ARTICLE, FOOTER),
        page(NAV, ARTICLE.replace("</article>", "<!-- <p>hidden</p> --></article>")),
        page(NAV, ARTICLE.replace("</p>", "")),
        page(NAV, ARTICLE)[: -len("</body></html>")],
    ],
)
def test_article_alone(source):
    assert text(source) == WANTED


def test_awkward_markup():
    cut = "<article><h1>x &amp</h1><p><b>bold text here.<br><p>a < b &lt;i&gt; &#65;&nbsp;&eacute;</article>"
    assert text(page(NAV, cut)) == "x &\nbold text here.\na < b <i> A é"
    for source in (None, "", " \n ", "<", "</p></div>", "<p", "<!--", "<script>", "<div " * 50, "&#xD800;"):
        assert isinstance(text(source), str)
    assert text(None) == text("") == text("<p></p>") == ""
    deep = "<div>" * 20_000 + "</section>" * 20_000
    assert text(deep) == ""


def test_long_page_is_read_whole():
    many = "".join(f"<p>Paragraph number {i} has some words.</p>" for i in range(5_000))
    found = text(page(NAV, f"<article><h1>Long</h1>{many}</article>", FOOTER)).split("\n")
    assert len(found) == 5_001 and found[-1] == "Paragraph number 4999 has some words."


def test_nothing_is_kept_below_what_is_dropped():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 9))
        parents = [-1] + [int(rng.integers(i)) for i in range(1, n)]
        odds = rng.normal(0, 2, n).tolist()
        chosen = html_text.decode(parents, odds)
        assert all(not chosen[i] or chosen[parents[i]] for i in range(1, n))
        best = max(
            sum(odds[i] for i in range(n) if mask >> i & 1)
            for mask in range(1, 1 << n, 2)
            if all(not mask >> i & 1 or mask >> parents[i] & 1 for i in range(1, n))
        )
        assert sum(o for o, c in zip(odds, chosen, strict=True) if c) == pytest.approx(best)


def test_new_pages_of_the_patterns():
    trees, wrong, total = html_text.train(), 0, 0
    for source in html_text.training_pages(120, seed=77):
        parsed = html_text.parse(source)
        rows, labels = html_text.labelled_nodes(source)
        chosen = html_text.decode(parsed.parents, trees.odds(np.array(rows)).tolist())
        wrong += sum(c != bool(x) for c, x in zip(chosen, labels, strict=True))
        total += len(labels)
    assert wrong / total < 0.02


def test_rows(spark):
    rows = [(1, page(NAV, ARTICLE)), (1, page(NAV, ARTICLE)), (2, None), (3, ""), (None, "<p>x</p>")]
    df = spark.createDataFrame([(*r, "u") for r in rows], "page_id long, html string, text string")
    found = html_text.with_main_text(df, "html")
    assert found.columns == ["page_id", "html", "text", "main_text", "n_chars"]
    got = found.collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["main_text"]) for r in got)
    assert [r["main_text"] for r in got if r["page_id"] == 1] == [WANTED] * 2
    assert {r["main_text"] for r in got if r["page_id"] in (2, 3)} == {""}
    assert html_text.with_main_text(df.where("1 = 0"), "html").count() == 0
    with pytest.raises(ValueError):
        html_text.with_main_text(df, "html", "text")


def test_pages(spark):
    """Pages of the tables: the heading and the paragraphs of their one article."""
    import html as library
    import re

    from tidegate.llm import queries

    got = {r["page_id"]: r["text"] for r in queries.main_text(spark, "/root/testdata/sf0.01").collect()}
    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        body = re.search("<article>(.*?)</article>", row["html"], re.S)[1]
        plain = [
            " ".join(library.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split())
            for b in re.split("</?(?:p|h1)>", body)
        ]
        assert got[row["page_id"]] == "\n".join(b for b in plain if b)


def test_deep_pages_in_linear_time():
    """A megabyte of elements that look for an enclosing one ends soon."""
    import time

    started = time.monotonic()
    found = html_text.parse("<div>" * 100_000 + "<li>x" * 100_000)
    assert len(found.tags) == 200_001 and time.monotonic() - started < 20
    for item in ("<td>y", "<dd>z", "<option>v", "</b><p>w"):
        html_text.parse("<ul>" * 20_000 + item * 20_000)
    assert time.monotonic() - started < 60


def test_items_end_at_their_own_list():
    page = html_text.parse("<ul><li>a<ul><li>b<li>c</ul><li>d</ul><table><tr><td>1<td><table><tr><td>2</table><td>3")
    parent = [page.tags[p] if p >= 0 else "" for p in page.parents]
    shown = [f"{p}>{t}" for p, t in zip(parent, page.tags, strict=True)]
    assert shown[1:] == ["html>ul", "ul>li", "li>ul", "ul>li", "ul>li", "ul>li", "html>table", "table>tr", "tr>td",
                         "tr>td", "td>table", "table>tr", "tr>td", "tr>td"]
