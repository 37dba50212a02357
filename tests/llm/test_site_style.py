from ledgerweave.llm import site_style
from ledgerweave.llm.site_style import Page
from llm_cases import shipped  # noqa: F401

CASES = {
    "": "",
    "plain  text": "plain text",
    "<p>a<b>b</b>c<p>d&amp;e &lt;x&gt; &#233;&eacute;&am": "abc d&e <x> éé&am",
    '<div class="content has-sidebar"><p>x</p><div class="sidebar">no</div></div>': "x",
    "<article><header><h1>T</h1></header><p>x<br>y</p><section class='comments'>c</section></article><aside>z</aside>": "T x y",
    '<header>h</header><p>x</p><script>if(a<b)"</p>"</script><style>p{}</style><!-- <p>no --> <p>y&nbsp;z</p>': "x y z",
    "a < b and <3": "a < b and <3",
    '<p title="a>b">q</p>': "q",
    "<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>": "a b 1 2",
    "<form>f</form>ok<footer>&copy;</footer>": "ok",
    '<main>m<div class="ad-slot">a</div><div id="cookie-notice">c</div></main>menu': "m",
    '<article class="comment">c</article><article>real</article>': "real",
    "<p>" + "long " * 50_000: ("long " * 50_000).strip(),
}


def test_text_rules():
    for html, text in CASES.items():
        assert Page(html, "h").text(frozenset()) == text, html[:60]


def site(n):
    """Pages without helpful names: one box repeats, one lists a few lines, one is the text."""
    pages = []
    for i in range(n):
        body = "".join(f"<p>Sentence {i} {j} of this page only.</p>" for j in range(4))
        pages.append((i, f"http://a.example/{i}",
                      f"<html><body><div id=x>Same words on every page</div><div id=y>{body}</div>"
                      f"<div id=z>line {i % 3}</div></body></html>"))
    return pages


def test_style_tree_removes_what_repeats(spark):
    rows = site(60) + [
        (100, "http://b.example/", "<div id=x>Same words on every page</div>"),  # one page of its host
        (101, None, None), (102, "not a url", ""), (103, "http://[bad", "<p>t</p>"), (None, None, "<p>n</p>"),
        (5, "http://a.example/5", site(60)[5][2]),
    ]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, text string")
    for limit in (site_style.SENT_NODES, -1):  # sent to all tasks, or joined page by page
        found = site_style.extract(frame, sent_nodes=limit)
        assert found.columns == ["page_id", "url", "text"]
        got = [(r["page_id"], r["text"]) for r in found.collect()]
        assert len(got) == len(rows)
        texts = {k: t for k, t in got if k is not None}
        assert texts[5] == " ".join(f"Sentence 5 {j} of this page only." for j in range(4))
        assert texts[100] == "Same words on every page" and texts[103] == "t"
        assert texts[101] == texts[102] == "" and (None, "n") in got
    assert site_style.extract(frame.limit(0)).count() == 0


def test_importance_by_hand(spark):
    rows = {r["node"]: r for r in site_style.importance(
        spark.createDataFrame(site(60), "page_id bigint, url string, html string")).collect()}
    page = Page(site(60)[0][2], "a.example")
    by_name = {n: rows[k]["importance"] for n, k in zip(page.name[1:], page.key[1:])}
    assert abs(by_name["div.x"]) < 1e-9 and by_name["div.y"] > 0.85
    # Twenty of sixty pages share each of the three lines.
    import math
    assert abs(by_name["div.z"] - 0.9 * (1 - math.log(20) / math.log(60))) < 1e-9


def test_a_page_keeps_its_text_if_entropies_would_take_all(spark):
    rows = [(i, "http://c.example/", "<div>copy of one text</div>") for i in range(30)]
    got = site_style.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {r["text"] for r in got.collect()} == {"copy of one text"}


def test_what_stands_around_an_article_is_kept(spark):
    """A host of copies: all that repeats has importance 0, also the article's wrapper."""
    for article in ("<article>the copied text</article>", "<div role=main>the copied text</div>"):
        rows = [(i, "http://d.example/", f"<div class=wrap><div>{article}</div></div><div class=meta>unique {i}</div>")
                for i in range(30)]
        got = site_style.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
        assert {r["text"] for r in got.collect()} == {"the copied text"}


def test_elements_of_any_depth_are_opened():
    for deep in ("<div>" * 100, "<b>" * 3000):
        assert Page(f"{deep}<nav>no</nav>yes", "h").text(frozenset()) == "yes"
        assert Page(f"menu{deep}<article>real<aside>z</aside></article>", "h").text(frozenset()) == "real"
        page = Page(f"{deep}x<i>y</i>", "h")
        rows = list(page.statistics())
        assert len(rows) == len(set(rows)) == 3 * (len(page.key) - 1) - 1  # styles, x, y; x is not in i


def articles(n, host="e.example", copies=False):
    """Pages with an article that holds, among its own text, a box of an unlisted class."""
    box = "<div class=zq><p>Same words on every page</p></div>"
    return [(i, f"http://{host}/{i}", f"<nav>n{i}</nav><article><h2>About</h2><p>Own words {0 if copies else i}.</p>{box}"
             f"<div class=body>More own words {0 if copies else i}.</div></article>") for i in range(n)]


def brute(rows):
    """The same rule by plain counting: a box is removed if all pages of its host have its words and
    the article differs; everything else of the article stays."""
    hosts = {}
    for _, url, html in rows:
        hosts.setdefault(site_style.host_of(url), []).append(html)
    out = {}
    for i, url, html in rows:
        pages = hosts[site_style.host_of(url)]
        text = Page(html, "h").text(frozenset())
        texts = {Page(other, "h").text(frozenset()) for other in pages}
        repeats = len(pages) >= site_style.MANY and len(texts) == len(pages)
        out[url] = text.replace("Same words on every page ", "") if repeats else text
    return out


def test_entropies_judge_boxes_inside_an_article(spark):
    rows = articles(30) + articles(4, "few.example") + articles(20, "copies.example", copies=True)
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    want = brute(rows)
    for limit in (site_style.SENT_NODES, -1):
        got = {r["url"]: r["text"] for r in site_style.extract(frame, sent_nodes=limit).collect()}
        assert got == want
    assert want["http://e.example/3"] == "About Own words 3. More own words 3."
    assert "Same words" in want["http://few.example/3"] and "Same words" in want["http://copies.example/3"]
    # Without the style tree the box stays, so it is the tree that decides.
    off = {r["url"]: r["text"] for r in site_style.extract(frame, threshold=-1.0).collect()}
    assert sum(off[u] != want[u] for u in want) == 30


def test_a_page_whose_article_is_only_the_repeated_box_keeps_it(spark):
    rows = [(i, f"http://f.example/{i}", f"<article><p>{'' if i else 'x'}</p><div class=zq>all there is</div></article>")
            for i in range(20)]
    got = site_style.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {r["page_id"]: r["text"] for r in got.collect()} == {0: "x", **{i: "all there is" for i in range(1, 20)}}
